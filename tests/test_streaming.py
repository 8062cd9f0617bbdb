"""Streaming: stream = batch, restart, replay, late data, progress metrics."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from matchstream.operators import fouls_tumbling, player_totals, scoreboard, yellow_cards_sliding
from matchstream.operators.cards import yellow_momentum
from matchstream.schema import CARD_GROUPS
from matchstream.sinks.keyed_table import KeyedTable
from matchstream.sources.testdata import load_match_events_from_testdata
from matchstream.streaming.catalog import event_stream
from matchstream.streaming.progress import ProgressLog, progress_summary
from matchstream.streaming.queries import (
    closed_yellow_cards_stream,
    fouls_stream,
    momentum_batch,
    open_windows,
    player_stats_stream,
    player_table_rows,
    scoreboard_stream,
    yellow_cards_stream,
)
from matchstream.streaming.runner import run_available, start_to_table
from tests.conftest import SF01

pytestmark = pytest.mark.skipif(not os.path.exists(SF01), reason="driver test data absent")


def split_events(src_dir: str, out_dir: str, n: int) -> list[str]:
    """Time-ordered split of events.parquet into n files (test input only)."""
    table = pq.read_table(os.path.join(src_dir, "events.parquet"))
    pdf = table.to_pandas().sort_values("ts", kind="stable")
    os.makedirs(out_dir, exist_ok=True)
    paths = []
    bounds = np.linspace(0, len(pdf), n + 1).astype(int)
    for i in range(n):
        chunk = pdf.iloc[bounds[i]:bounds[i + 1]]
        path = os.path.join(out_dir, f"part-{i:03d}.parquet")
        pq.write_table(pa.Table.from_pandas(chunk, schema=table.schema, preserve_index=False), path)
        paths.append(path)
    return paths


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _ntz(df, *cols):
    from matchstream.functions.casts import utc_wall_clock

    for c in cols:
        df = df.withColumn(c, utc_wall_clock(c))
    return df


@pytest.mark.parametrize("n_files", [1, 3, 7])
def test_stream_equals_batch(spark, tmp_dir, n_files):
    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, n_files)
    batch = load_match_events_from_testdata(spark, SF01)

    def stream(*types):
        return event_stream(spark, src, *types, max_files_per_trigger=1, glob="*.parquet")

    fouls = KeyedTable(spark, os.path.join(tmp_dir, "fouls"), ["team", "window_start"],
                       ("window_date", F.to_date("window_start")))
    q = run_available(fouls_stream(stream("foul")), fouls, os.path.join(tmp_dir, "ck-f"))
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == n_files
    assert _same(_ntz(fouls.read(), "window_start", "window_end"), fouls_tumbling(batch))

    cards = KeyedTable(spark, os.path.join(tmp_dir, "cards"), ["team", "player", "window_start"])
    run_available(yellow_cards_stream(stream("yellow_card")), cards, os.path.join(tmp_dir, "ck-c"))
    assert _same(_ntz(cards.read(), "window_start", "window_end"), yellow_cards_sliding(batch))

    players = KeyedTable(spark, os.path.join(tmp_dir, "players"), ["team", "player"])
    run_available(player_stats_stream(stream("goal", "assist", "shot")), players,
                  os.path.join(tmp_dir, "ck-p"), transform=player_table_rows)
    assert _same(players.read(), player_table_rows(player_totals(batch, performance_only=True)))

    board = KeyedTable(spark, os.path.join(tmp_dir, "board"), ["team"])
    run_available(scoreboard_stream(stream("goal")), board, os.path.join(tmp_dir, "ck-s"))
    assert _same(board.read(), scoreboard(batch))


@pytest.mark.parametrize("n_files", [1, 4])
def test_momentum_append_equals_closed_batch_windows(spark, tmp_dir, n_files):
    src, ck = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "ck")
    split_events(SF01, src, n_files)
    batch = load_match_events_from_testdata(spark, SF01)
    table = KeyedTable(spark, os.path.join(tmp_dir, "m"), ["team", "player", "window_start"])
    stream = closed_yellow_cards_stream(
        event_stream(spark, src, "yellow_card", max_files_per_trigger=1, glob="*.parquet"),
        "60 minutes", "10 minutes",
    )
    run_available(stream, table, ck, "append", transform=momentum_batch)
    last = batch.where("event_type = 'yellow_card'").agg(F.max("event_timestamp")).first()[0]
    expected = yellow_momentum(batch, "60 minutes", "10 minutes")
    closed = expected.where(F.col("window_end") <= F.lit(last - pd.Timedelta(minutes=2).to_pytimedelta()))
    got = _ntz(table.read(), "window_start", "window_end")
    assert got.count() == 9628
    assert _same(got, closed)
    rest = open_windows(spark, ck, "60 minutes", "10 minutes")
    assert rest.count() == 16
    table.merge(momentum_batch(rest))
    assert _same(_ntz(table.read(), "window_start", "window_end"), expected)


def test_state_of_closed_cards_is_one_row_a_pane(spark, tmp_dir):
    """The first state holds panes, not a copy of each event for each of its windows."""
    src, ck = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "ck")
    split_events(SF01, src, 1)
    stream = closed_yellow_cards_stream(event_stream(spark, src, "yellow_card", glob="*.parquet"), "60 minutes", "10 minutes")
    q = run_available(stream, KeyedTable(spark, os.path.join(tmp_dir, "m"), ["team", "player", "window_start"]), ck, "append")
    panes = load_match_events_from_testdata(spark, SF01, ("yellow_card",)).groupBy(F.window("event_timestamp", "10 minutes"), "team", "player")
    updated = [[o.numRowsUpdated for o in p.stateOperators] for p in q.recentProgress if p.numInputRows]
    assert updated[0][-1] == panes.count().count()


def test_no_open_windows_without_a_batch(spark, tmp_dir):
    assert open_windows(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_restart_on_same_checkpoint_replays_nothing(spark, tmp_dir):
    src_all = os.path.join(tmp_dir, "all")
    paths = split_events(SF01, src_all, 4)
    live = os.path.join(tmp_dir, "live")
    os.makedirs(live)
    for p in paths[:2]:
        os.link(p, os.path.join(live, os.path.basename(p)))
    table = KeyedTable(spark, os.path.join(tmp_dir, "fouls"), ["team", "window_start"])
    ck = os.path.join(tmp_dir, "ck")

    def run():
        s = event_stream(spark, live, "foul", max_files_per_trigger=1, glob="*.parquet")
        return run_available(fouls_stream(s), table, ck)

    run()
    files = sorted(table.read().inputFiles())
    q = run()  # nothing new: no new data batch, table unchanged
    assert sum(p.numInputRows for p in q.recentProgress) == 0
    assert sorted(table.read().inputFiles()) == files
    for p in paths[2:]:
        os.link(p, os.path.join(live, os.path.basename(p)))
    run()
    batch = load_match_events_from_testdata(spark, SF01)
    assert _same(_ntz(table.read(), "window_start", "window_end"), fouls_tumbling(batch))


def test_late_event_dropped_after_spacer_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    base = pd.Timestamp("2024-01-10 06:00:00")

    def write(name, minutes, event_id):
        pdf = pd.DataFrame(
            {
                "event_id": [event_id],
                "ts": [base + pd.Timedelta(minutes=minutes)],
                "user_id": [2],
                "event_type": ["view"],
                "value": [0.0],
                "props": ['{"k": 1}'],
            }
        )
        pdf["ts"] = pdf["ts"].astype("datetime64[us]")
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), os.path.join(src, name))

    write("a.parquet", 20, 1)   # advances the watermark to 06:18
    write("b.parquet", 21, 2)   # spacer batch
    write("c.parquet", 14.5, 3)  # 5.5 min behind: late
    table = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["team", "window_start"])
    stream = fouls_stream(event_stream(spark, src, "foul", max_files_per_trigger=1, glob="*.parquet"))
    q = run_available(stream, table, os.path.join(tmp_dir, "ck"))
    dropped = sum(
        sum(op.numRowsDroppedByWatermark for op in p.stateOperators) for p in q.recentProgress
    )
    assert dropped == 1
    assert table.read().agg(F.sum("fouls")).first()[0] == 2


def test_progress_summary(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, 2)
    table = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["team", "window_start"])
    with ProgressLog(spark, os.path.join(tmp_dir, "progress")) as log:
        q = start_to_table(
            fouls_stream(event_stream(spark, src, "foul", max_files_per_trigger=1, glob="*.parquet")),
            table, os.path.join(tmp_dir, "ck"), query_name="fouls_progress_test",
        )
        q.awaitTermination(600)
    summary = {r.query: r for r in progress_summary(log.rows()).collect()}
    assert summary["all"].input_rows == 10000
    assert summary["fouls_progress_test"].batches >= 2
    assert summary["all"].rows_per_s > 0


def test_router_stream_feeds_topic_pipeline(spark, tmp_dir):
    from matchstream.operators import route_topics
    from matchstream.streaming.pipeline import await_all, start_match_streams, start_router_stream
    from matchstream.streaming.queries import with_event_time

    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, 3)
    topics = os.path.join(tmp_dir, "topics")
    events = with_event_time(event_stream(spark, src, max_files_per_trigger=1, glob="*.parquet"))
    q = start_router_stream(events, os.path.join(tmp_dir, "ck-router"), topics_dir=topics)
    q.awaitTermination(600)
    assert q.exception() is None
    routed = spark.read.parquet(topics)
    batch = load_match_events_from_testdata(spark, SF01)
    assert _same(routed.select("topic", "value"), route_topics(batch, with_event_id=True).select("topic", "value"))
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics)
    await_all(started)
    assert _same(started["goals"][1].board(), scoreboard(batch))


def test_stream_windows_independent_of_session_time_zone(spark, tmp_dir):
    """A DST zone in the session must not move streamed window bounds."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        src = os.path.join(tmp_dir, "in")
        split_events(SF01, src, 1)
        table = KeyedTable(spark, os.path.join(tmp_dir, "y"), ["team", "player", "window_start"])
        stream = yellow_cards_stream(event_stream(spark, src, "yellow_card", glob="*.parquet"),
                                     "60 minutes", "10 minutes")
        run_available(stream, table, os.path.join(tmp_dir, "ck"))
        batch = load_match_events_from_testdata(spark, SF01)
        got = _ntz(table.read(), "window_start", "window_end")
        assert _same(got, yellow_cards_sliding(batch, "60 minutes", "10 minutes"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_out_of_order_within_watermark_equals_batch(spark, tmp_dir):
    """Rows near each file boundary arrive one file late (< 1 min behind)."""
    table_in = pq.read_table(os.path.join(SF01, "events.parquet"))
    pdf = table_in.to_pandas().sort_values("ts", kind="stable").reset_index(drop=True)
    bounds = np.linspace(0, len(pdf), 4).astype(int)
    chunks = [pdf.iloc[bounds[i]:bounds[i + 1]] for i in range(3)]
    moved = []
    for i in range(2):
        edge = chunks[i]["ts"].max()
        late = chunks[i]["ts"] > edge - pd.Timedelta(seconds=50)
        moved.append(chunks[i][late])
        chunks[i] = chunks[i][~late]
    chunks[1] = pd.concat([chunks[1], moved[0]])
    chunks[2] = pd.concat([chunks[2], moved[1]])
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i, c in enumerate(chunks):
        pq.write_table(pa.Table.from_pandas(c, schema=table_in.schema, preserve_index=False),
                       os.path.join(src, f"part-{i}.parquet"))
    assert sum(len(m) for m in moved) > 0
    batch = load_match_events_from_testdata(spark, SF01)
    cards = KeyedTable(spark, os.path.join(tmp_dir, "c"), ["team", "player", "window_start"])
    q = run_available(
        yellow_cards_stream(event_stream(spark, src, "yellow_card", max_files_per_trigger=1, glob="*.parquet")),
        cards, os.path.join(tmp_dir, "ck"),
    )
    dropped = sum(sum(op.numRowsDroppedByWatermark for op in p.stateOperators) for p in q.recentProgress)
    assert dropped == 0
    assert _same(_ntz(cards.read(), "window_start", "window_end"), yellow_cards_sliding(batch))


def test_exact_dedup_mode_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, 2)
    batch = load_match_events_from_testdata(spark, SF01)
    board = KeyedTable(spark, os.path.join(tmp_dir, "b"), ["team"])
    stream = event_stream(spark, src, "goal", max_files_per_trigger=1, glob="*.parquet")
    run_available(scoreboard_stream(stream), board, os.path.join(tmp_dir, "ck"))
    assert _same(board.read(), scoreboard(batch))


def test_stream_into_jdbc_table(spark, tmp_dir):
    from matchstream.sinks.jdbc_merge import JdbcKeyedTable

    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, 2)
    url = f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"
    table = JdbcKeyedTable(spark, url, "foul_stats", ["team", "window_start"],
                           driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
                           column_types="team VARCHAR(100)")
    stream = fouls_stream(event_stream(spark, src, "foul", max_files_per_trigger=1, glob="*.parquet"))
    q = (stream.writeStream.outputMode("update").foreachBatch(table.write_batch)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    batch = load_match_events_from_testdata(spark, SF01)
    got = _ntz(table.read(), "window_start", "window_end")
    assert _same(got, fouls_tumbling(batch))


def test_rocksdb_state_store(spark, tmp_dir):
    from matchstream.session import ROCKSDB_PROVIDER

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        src = os.path.join(tmp_dir, "in")
        split_events(SF01, src, 2)
        table = KeyedTable(spark, os.path.join(tmp_dir, "f"), ["team", "window_start"])
        q = run_available(
            fouls_stream(event_stream(spark, src, "foul", max_files_per_trigger=1, glob="*.parquet")),
            table, os.path.join(tmp_dir, "ck"),
        )
        metrics = [k for p in q.recentProgress for op in p.stateOperators for k in op.customMetrics]
        assert any(k.startswith("rocksdb") for k in metrics), metrics
    finally:
        spark.conf.set(key, old)
    batch = load_match_events_from_testdata(spark, SF01)
    assert _same(_ntz(table.read(), "window_start", "window_end"), fouls_tumbling(batch))


def test_live_team_flag_exact_after_every_batch(spark, tmp_dir):
    """Update mode over 7 files: flags of teammates whose own counts did not
    change in a micro-batch are still recomputed (the stale-flag trap)."""
    src = os.path.join(tmp_dir, "in")
    split_events(SF01, src, 7)
    table = KeyedTable(spark, os.path.join(tmp_dir, "live"), ["team", "player", "window_start"],
                       ("window_date", F.to_date("window_start")), momentum_batch, CARD_GROUPS)
    stream = yellow_cards_stream(
        event_stream(spark, src, "yellow_card", max_files_per_trigger=1, glob="*.parquet"),
        "60 minutes", "10 minutes",
    )
    run_available(stream, table, os.path.join(tmp_dir, "ck"), "update")
    batch = load_match_events_from_testdata(spark, SF01)
    got = _ntz(table.read(), "window_start", "window_end")
    assert _same(got, yellow_momentum(batch, "60 minutes", "10 minutes"))


def test_scoreboard_unchanged_when_whole_input_is_replayed(spark, tmp_dir):
    import shutil

    live = os.path.join(tmp_dir, "live")
    paths = split_events(SF01, live, 3)
    board = KeyedTable(spark, os.path.join(tmp_dir, "b"), ["team"])
    ck = os.path.join(tmp_dir, "ck")

    def run():
        s = event_stream(spark, live, "goal", max_files_per_trigger=1, glob="*.parquet")
        return run_available(scoreboard_stream(s), board, ck)

    run()
    before = sorted(tuple(r) for r in board.read().collect())
    for p in paths:  # the same events delivered again, as new files
        shutil.copy(p, p.replace("part-", "replay-"))
    q = run()
    assert sum(p.numInputRows for p in q.recentProgress) > 0
    assert sorted(tuple(r) for r in board.read().collect()) == before
    batch = load_match_events_from_testdata(spark, SF01)
    assert _same(board.read(), scoreboard(batch))


def test_hot_key_safe_scoreboard_stream(spark, tmp_dir):
    import shutil

    from matchstream.streaming.goals import GoalTables
    from matchstream.streaming.queries import goal_firsts_stream, scoreboard_from_firsts

    src = os.path.join(tmp_dir, "in")
    paths = split_events(SF01, src, 3)
    shutil.copy(paths[1], paths[1].replace("part-", "dup-"))  # a burst of repeated events
    table = GoalTables(spark, os.path.join(tmp_dir, "goals"), "hour")
    stream = goal_firsts_stream(event_stream(spark, src, "goal", max_files_per_trigger=1, glob="*.parquet"))
    run_available(stream, table, os.path.join(tmp_dir, "ck"), "update")
    batch = load_match_events_from_testdata(spark, SF01)
    assert _same(table.board(), scoreboard(batch))
    assert _same(scoreboard_from_firsts(table.read()), scoreboard(batch))
    assert table.read().count() == batch.where("event_type = 'goal'").select("event_timestamp").distinct().count()


def test_streamed_keys_on_input_without_rows(spark, tmp_dir):
    """An input with no events of the needed types gives empty, typed results."""
    import __spark_entry__ as entry_mod

    src = os.path.join(tmp_dir, "sf")
    os.makedirs(src)
    table_in = pq.read_table(os.path.join(SF01, "events.parquet"))
    pdf = table_in.to_pandas()
    only_views = pdf[pdf["event_type"] == "view"].head(50)   # fouls only
    pq.write_table(pa.Table.from_pandas(only_views, schema=table_in.schema, preserve_index=False),
                   os.path.join(src, "events.parquet"))
    q = entry_mod.queries()
    assert q["stream_yellow_cards"](spark, src).count() == 0
    assert "team_momentum_lost" in q["stream_yellow_momentum_live"](spark, src).columns
    assert q["stream_player_stats"](spark, src).count() == 0
    assert {r.team: r.goals for r in q["stream_scoreboard"](spark, src).collect()} == {
        "FC Python": 0, "AI United": 0}
    assert q["stream_fouls"](spark, src).agg(F.sum("fouls")).first()[0] == 50

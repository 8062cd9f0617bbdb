"""Combined batch runner, SQL-view route, and the topic-fed streaming pipeline."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from matchstream.operators import (
    fouls_tumbling,
    player_totals,
    route_topics,
    scoreboard,
    yellow_cards_sliding,
    yellow_momentum,
)
from matchstream.operators.cards import with_team_momentum_join
from matchstream.operators.routing import write_routed_files
from matchstream.plans.batch import register_views, run_match_report
from matchstream.sources.testdata import load_match_events_from_testdata
from matchstream.streaming.pipeline import await_all, finish_match_streams, start_match_streams
from matchstream.streaming.queries import player_table_rows
from tests.conftest import SF001, SF01

pytestmark = pytest.mark.skipif(not os.path.exists(SF01), reason="driver test data absent")


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _ntz(df, *cols):
    from matchstream.functions.casts import utc_wall_clock

    for c in cols:
        df = df.withColumn(c, utc_wall_clock(c))
    return df


@pytest.mark.parametrize("persist", [False, True])
def test_combined_report(spark, tmp_dir, persist):
    events = load_match_events_from_testdata(spark, SF001)
    paths = run_match_report(events, tmp_dir, persist=persist)
    assert set(paths) == {"family_counts", "yellow_card_stats", "player_performance_stats",
                          "foul_stats", "scoreboard", "report_progress"}
    progress = {r.family: r for r in spark.read.parquet(paths["report_progress"]).collect()}
    assert set(progress) == set(paths) - {"report_progress"}
    for family, r in progress.items():
        assert r.input_rows == events.count() and r.output_rows == spark.read.parquet(paths[family]).count()
        assert r.seconds > 0 and r.events_per_s > 0
    assert _same(spark.read.parquet(paths["foul_stats"]), fouls_tumbling(events))
    assert _same(spark.read.parquet(paths["yellow_card_stats"]), yellow_momentum(events))
    assert not events.is_cached


def test_sql_view_route_equals_join_form(spark):
    events = load_match_events_from_testdata(spark, SF001)
    register_views(spark, events, prefix="t_")
    totals = spark.sql("select window_start, window_end, team, sum(yellow_cards) as cards from t_yellow_stats group by all")
    cards = yellow_cards_sliding(events)
    via_sql = cards.join(totals, ["team", "window_start", "window_end"], "left").withColumn(
        "team_momentum_lost", F.col("cards") > 3
    ).drop("cards")
    assert _same(via_sql, with_team_momentum_join(cards))


def test_topic_pipeline_equals_batch(spark, tmp_dir):
    events = load_match_events_from_testdata(spark, SF01)
    topics = os.path.join(tmp_dir, "topics")
    write_routed_files(route_topics(events, with_event_id=True), topics)
    # two bad messages on the foul topic
    spark.createDataFrame([("{oops",), ('{"timestamp":"nope","event_type":"foul"}',)], "value string") \
        .write.mode("append").parquet(os.path.join(topics, "topic=team_stats_1min"))
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics)
    await_all(started)

    tables = {k: v[1] for k, v in started.items()}
    assert _same(_ntz(tables["foul_stats"].read(), "window_start", "window_end"), fouls_tumbling(events))
    assert _same(_ntz(tables["yellow_card_stats"].read(), "window_start", "window_end"),
                 yellow_momentum(events))
    assert _same(tables["player_performance_stats"].read(),
                 player_table_rows(player_totals(events, performance_only=True)))
    assert _same(tables["goals"].board(), scoreboard(events))
    last = events.where("event_type = 'yellow_card'").agg(F.max("event_timestamp")).first()[0]
    closed = yellow_momentum(events).where(F.col("window_end") <= F.lit(last - dt.timedelta(minutes=2)))
    assert _same(_ntz(tables["yellow_momentum_stats"].read(), "window_start", "window_end"), closed)
    bad = tables["parsed"].quarantine()
    assert sorted((r.reason, r.value[:2]) for r in bad.collect()) == [("bad_timestamp", '{"'), ("malformed_json", "{o")]
    finish_match_streams(started, spark, os.path.join(tmp_dir, "out"))
    assert _same(_ntz(tables["yellow_momentum_stats"].read(), "window_start", "window_end"), yellow_momentum(events))


def test_messages_are_parsed_once(spark, tmp_dir):
    """One query parses all topics and writes both outputs; the families read typed rows."""
    events = load_match_events_from_testdata(spark, SF001)
    topics = os.path.join(tmp_dir, "topics")
    write_routed_files(route_topics(events, with_event_id=True), topics)
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics)
    await_all(started)
    parsing = [n for n, (q, _) in started.items() if "JsonToStructs" in str(q._jsq.explainInternal(True)) or "from_json" in str(q._jsq.explainInternal(True))]
    assert parsing == ["parsed"]
    rows = started["parsed"][1].parsed(spark.read.schema("value string, topic string").parquet(topics))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_goals_only(spark, tmp_dir):
    """A match without a card or foul yet: the other queries run on empty topics."""
    events = load_match_events_from_testdata(spark, SF01, ["goal"])
    topics = os.path.join(tmp_dir, "topics")
    write_routed_files(route_topics(events, with_event_id=True).where("topic = 'live_score'"), topics)
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics)
    await_all(started)
    assert _same(started["goals"][1].board(), scoreboard(events))
    assert started["foul_stats"][1].read() is None


def test_no_topics_at_all(spark, tmp_dir):
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=os.path.join(tmp_dir, "none"))
    await_all(started)
    assert started["goals"][1].read() is None and started["parsed"][1].quarantine().count() == 0
    finish_match_streams(started, spark, os.path.join(tmp_dir, "out"))
    assert started["yellow_momentum_stats"][1].read() is None


def test_one_failure_stops_the_others(spark, tmp_dir):
    from matchstream.operators.routing import write_routed_files as write

    topics = os.path.join(tmp_dir, "topics")
    write(route_topics(load_match_events_from_testdata(spark, SF001), with_event_id=True), topics)
    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics,
                                  trigger={"processingTime": "1 second"})

    def fail(batch, batch_id):
        raise ValueError("broken sink")

    rate = spark.readStream.format("rate").load().writeStream.foreachBatch(fail)
    started["broken"] = (rate.option("checkpointLocation", os.path.join(tmp_dir, "ck")).start(), None)
    with pytest.raises(RuntimeError, match="broken"):
        await_all(started)
    assert not any(q.isActive for q, _ in started.values())


def test_database_sink(spark, tmp_dir):
    from matchstream.sinks.jdbc_merge import JdbcKeyedTable

    events = load_match_events_from_testdata(spark, SF001)
    topics = os.path.join(tmp_dir, "topics")
    write_routed_files(route_topics(events, with_event_id=True), topics)
    url = f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"

    def table(name, keys, flag=None):
        types = ", ".join(f"{k} VARCHAR(100)" for k in keys if k in ("team", "player")) or None
        return JdbcKeyedTable(spark, url, name, keys, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
                              column_types=types, query=name, flag=flag)

    started = start_match_streams(spark, os.path.join(tmp_dir, "out"), topics_dir=topics, jdbc=table, max_files_per_trigger=1)
    finish_match_streams(started, spark, os.path.join(tmp_dir, "out"))
    fouls = started["foul_stats"][1].read()
    assert _same(_ntz(fouls, "window_start", "window_end"), fouls_tumbling(events))
    for name in ("yellow_card_stats", "yellow_momentum_stats"):  # the flags too
        cards = started[name][1].read()
        assert _same(_ntz(cards, "window_start", "window_end"), yellow_momentum(events))

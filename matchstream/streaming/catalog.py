"""Streamed keys of the registry: each replays ``events.parquet`` as a file
stream with ``availableNow``, runs the streaming metric into a keyed table in
the shared work folder (fresh checkpoint and table per call), and returns the
table as it stands after the stream finished.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.functions.casts import utc_wall_clock
from matchstream.operators.serving import scoreboard_readout
from matchstream.plans.oracle import (
    CARDS_SELECT,
    MOMENTUM_SELECT,
    PERFORMANCE_WHERE,
    cards_cte,
    fouls_cte,
    players_cte,
    scoreboard_sql,
)
from matchstream.operators.routing import route_topics, write_routed_files
from matchstream.schema import CARD_GROUPS, CARD_KEYS, FOUL_KEYS, PLAYER_KEYS, SCOREBOARD_KEYS
from matchstream.session import scratch_path
from matchstream.sinks.keyed_table import KeyedTable
from matchstream.sources.testdata import ORACLE_PRELUDE, RAW_EVENTS, adapt_events, load_match_events_from_testdata
from matchstream.streaming.goals import GoalTables
from matchstream.streaming.pipeline import finish_match_streams, start_match_streams
from matchstream.streaming.progress import ProgressLog, progress_summary
from matchstream.streaming.queries import (
    closed_yellow_cards_stream,
    fouls_stream,
    goal_firsts_stream,
    momentum_batch,
    open_windows,
    player_stats_stream,
    player_table_rows,
    scoreboard_stream,
    yellow_cards_stream,
)
from matchstream.streaming.runner import run_available


def event_stream(
    spark: SparkSession, sf_dir: str, *types: str, max_files_per_trigger: int | None = None,
    glob: str = "events.parquet",
) -> DataFrame:
    reader = spark.readStream.schema(RAW_EVENTS).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return adapt_events(reader.parquet(sf_dir), types or None)


def _by_window_date() -> tuple[str, F.Column]:
    return ("window_date", F.to_date("window_start"))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Window bounds back to UTC wall-clock, as the batch metrics report them."""
    for c in cols:
        df = df.withColumn(c, utc_wall_clock(c))
    return df


def _rows(table: KeyedTable, stream: DataFrame, transform=None) -> DataFrame:
    """The table's rows; an empty, correctly typed result when nothing was written."""
    df = table.read()
    if df is not None:
        return df
    empty = stream.sparkSession.createDataFrame([], stream.schema)
    empty = transform(empty) if transform else empty
    if table.finalize is not None:
        empty = table.finalize(empty)
    return empty


def _table(spark: SparkSession, label: str, keys, partition_by=None) -> tuple[KeyedTable, str]:
    base = scratch_path(spark, label)
    return KeyedTable(spark, os.path.join(base, "table"), keys, partition_by), os.path.join(base, "checkpoint")


def q_stream_fouls(spark, sf_dir):
    table, ckpt = _table(spark, "stream-fouls", FOUL_KEYS, _by_window_date())
    stream = fouls_stream(event_stream(spark, sf_dir, "foul"))
    run_available(stream, table, ckpt, "update")
    return _ntz(_rows(table, stream), "window_start", "window_end")


def q_stream_yellow_cards(spark, sf_dir):
    table, ckpt = _table(spark, "stream-cards", CARD_KEYS, _by_window_date())
    stream = yellow_cards_stream(event_stream(spark, sf_dir, "yellow_card"))
    run_available(stream, table, ckpt, "update")
    return _ntz(_rows(table, stream), "window_start", "window_end")


def q_stream_yellow_momentum(spark, sf_dir):
    """Append mode from panes; what the end of the input leaves open comes from the query's state."""
    table, ckpt = _table(spark, "stream-momentum", CARD_KEYS, _by_window_date())
    stream = closed_yellow_cards_stream(event_stream(spark, sf_dir, "yellow_card"), "60 minutes", "10 minutes")
    run_available(stream, table, ckpt, "append", transform=momentum_batch)
    table.merge(momentum_batch(open_windows(spark, ckpt, "60 minutes", "10 minutes")))
    return _ntz(_rows(table, stream, momentum_batch), "window_start", "window_end")


def q_stream_yellow_momentum_live(spark, sf_dir):
    """Update mode; the team flag is recomputed over the (team, window) groups
    that a micro-batch touches, so it is exact after every one."""
    base = scratch_path(spark, "stream-momentum-live")
    table = KeyedTable(spark, os.path.join(base, "table"), CARD_KEYS, _by_window_date(), momentum_batch, CARD_GROUPS)
    stream = yellow_cards_stream(event_stream(spark, sf_dir, "yellow_card"), "60 minutes", "10 minutes")
    run_available(stream, table, os.path.join(base, "checkpoint"), "update")
    return _ntz(_rows(table, stream), "window_start", "window_end")


def q_stream_player_stats(spark, sf_dir):
    table, ckpt = _table(spark, "stream-players", PLAYER_KEYS)
    stream = player_stats_stream(event_stream(spark, sf_dir, "goal", "assist", "shot"))
    run_available(stream, table, ckpt, "update", transform=player_table_rows)
    return _rows(table, stream, player_table_rows)


def q_stream_scoreboard(spark, sf_dir):
    table, ckpt = _table(spark, "stream-scoreboard", SCOREBOARD_KEYS)
    stream = scoreboard_stream(event_stream(spark, sf_dir, "goal"))
    run_available(stream, table, ckpt, "update")
    return scoreboard_readout(_rows(table, stream))


def q_stream_scoreboard_firsts(spark, sf_dir):
    """Hot-key-safe form: per-timestamp firsts by streaming min(struct); the board adds up the days."""
    base = scratch_path(spark, "stream-goals")
    goals = GoalTables(spark, os.path.join(base, "table"))
    run_available(goal_firsts_stream(event_stream(spark, sf_dir, "goal")), goals, os.path.join(base, "checkpoint"))
    return goals.board()


def q_stream_scoreboard_collisions(spark, sf_dir):
    """Goal times cut to the hour, so that many goals share a time and only the first counts."""
    base = scratch_path(spark, "stream-goal-hours")
    goals = GoalTables(spark, os.path.join(base, "table"))
    events = event_stream(spark, sf_dir, "goal")
    hours = events.withColumn("event_timestamp", F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz"))
    run_available(goal_firsts_stream(hours), goals, os.path.join(base, "checkpoint"))
    return goals.board()


def q_stream_progress(spark, sf_dir):
    """The whole pipeline over the routed events; the rows that each query read, set aside and dropped as late."""
    base = scratch_path(spark, "stream-progress")
    events = load_match_events_from_testdata(spark, sf_dir)
    write_routed_files(route_topics(events, with_event_id=True), f"{base}/topics")
    with ProgressLog(spark, f"{base}/progress") as log:
        started = start_match_streams(spark, f"{base}/out", topics_dir=f"{base}/topics")
        finish_match_streams(started, spark, f"{base}/out")
    return progress_summary(log.rows()).where("query <> 'all'").select("query", "input_rows", "quarantined", "late_rows")


def q_stream_fouls_null_keys(spark, sf_dir):
    """Every third event without a team: NULL is a key of its own in the stored table."""
    table, ckpt = _table(spark, "stream-null-keys", FOUL_KEYS, _by_window_date())
    events = event_stream(spark, sf_dir, "foul")
    stream = fouls_stream(events.withColumn("team", F.when(F.col("event_id") % 3 != 0, F.col("team"))))
    run_available(stream, table, ckpt, "update")
    return _ntz(_rows(table, stream), "window_start", "window_end")


STREAM_QUERIES = {
    "stream_fouls": q_stream_fouls,
    "stream_yellow_cards": q_stream_yellow_cards,
    "stream_yellow_momentum": q_stream_yellow_momentum,
    "stream_yellow_momentum_live": q_stream_yellow_momentum_live,
    "stream_player_stats": q_stream_player_stats,
    "stream_scoreboard": q_stream_scoreboard,
    "stream_scoreboard_firsts": q_stream_scoreboard_firsts,
    "stream_scoreboard_collisions": q_stream_scoreboard_collisions,
    "stream_fouls_null_keys": q_stream_fouls_null_keys,
    "stream_progress": q_stream_progress,
}


def stream_oracles() -> dict[str, str]:
    p = ORACLE_PRELUDE
    return {
        "stream_fouls": p + fouls_cte("1 minute") + "\nSELECT * FROM fouls",
        "stream_yellow_cards": p + cards_cte("5 minutes", "1 minute", 5) + CARDS_SELECT,
        "stream_yellow_momentum": p + cards_cte("60 minutes", "10 minutes", 6) + MOMENTUM_SELECT,
        "stream_yellow_momentum_live": p + cards_cte("60 minutes", "10 minutes", 6) + MOMENTUM_SELECT,
        "stream_player_stats": p
        + players_cte(PERFORMANCE_WHERE)
        + "\nSELECT team, player, total_goals_scored AS goals, total_assists AS assists,"
        " total_shots_taken AS shots_taken, scoring_percentage FROM players",
        "stream_scoreboard": p + scoreboard_sql("event_timestamp", False),
        "stream_scoreboard_firsts": p + scoreboard_sql("event_timestamp", False),
        "stream_scoreboard_collisions": p + scoreboard_sql("date_trunc('hour', event_timestamp)", False),
        "stream_fouls_null_keys": p
        + "\nSELECT CASE WHEN event_id % 3 <> 0 THEN team END AS team, count(*) AS fouls,"
        " date_trunc('minute', event_timestamp) AS window_start,"
        " date_trunc('minute', event_timestamp) + INTERVAL '1 minute' AS window_end"
        " FROM match_events WHERE event_type = 'foul' GROUP BY ALL",
        "stream_progress": p
        + """, counts AS (
SELECT count(*) FILTER (event_type = 'foul') AS fouls, count(*) FILTER (event_type = 'yellow_card') AS cards,
       count(*) FILTER (event_type IN ('goal', 'assist', 'shot')) AS plays, count(*) FILTER (event_type = 'goal') AS goals
FROM match_events), queries AS (
SELECT 'parsed' AS query, fouls + cards + plays + goals AS input_rows FROM counts
UNION ALL SELECT 'foul_stats', fouls FROM counts
UNION ALL SELECT 'yellow_card_stats', cards FROM counts
UNION ALL SELECT 'yellow_momentum_stats', cards FROM counts
UNION ALL SELECT 'player_performance_stats', plays FROM counts
UNION ALL SELECT 'goals', goals FROM counts)
SELECT query, input_rows, CAST(0 AS BIGINT) AS quarantined, CAST(0 AS BIGINT) AS late_rows FROM queries""",
    }

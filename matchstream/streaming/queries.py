"""Streaming forms of the metrics.

The metric functions are the batch ones; this module only adds what a stream
needs: a TIMESTAMP event time (watermarks reject TIMESTAMP_NTZ), the
watermark, the output mode, and — for the team flag — the per-batch step.

* fouls / yellow cards: windowed counts, ``update`` mode; the watermark
  (2 minutes by default) bounds the state and drops late rows.
* player totals: unwindowed running sums, ``update`` mode — the state holds
  one row per (team, player), only changed players are emitted.
* scoreboard: the first goal of each event time, kept for ever (the exact
  form: no goal comes too late), then summed per team.
* yellow momentum: per-player window counts in ``append`` mode, from panes: one
  aggregation counts each row once into its slide-wide pane, a second one adds
  closed panes up to windows.  A window is
  emitted once, when the watermark passes its end, and *all* its rows leave
  the state in the same micro-batch; the team total is then an exact window
  sum over that micro-batch (:func:`momentum_batch`).  What is still open when
  bounded input ends is read from the query's state (:func:`open_windows`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstream.functions.casts import utc_instant
from matchstream.operators.cards import card_events, player_alert, with_team_momentum, yellow_cards_sliding
from matchstream.operators.fouls import fouls_tumbling
from matchstream.operators.players import player_totals
from matchstream.operators.scoreboard import goal_events
from matchstream.schema import CARD_SLIDE, CARD_WINDOW, FOUL_WINDOW, WATERMARK_DELAY
from matchstream.sinks import fs

EVENT_TIME = "event_timestamp"


def with_event_time(events: DataFrame, time_col: str = EVENT_TIME) -> DataFrame:
    """Make the event time a TIMESTAMP; wall-clock NTZ values are read as UTC,
    whatever the session time zone (see :func:`utc_instant`)."""
    if isinstance(events.schema[time_col].dataType, T.TimestampNTZType):
        return events.withColumn(time_col, utc_instant(time_col))
    return events


def watermarked(events: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return with_event_time(events).withWatermark(EVENT_TIME, delay)


def fouls_stream(events: DataFrame, duration: str = FOUL_WINDOW, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Output mode ``update``; rows ``team, fouls, window_start, window_end``."""
    fouls = with_event_time(events).where(F.col("event_type") == "foul")
    return fouls_tumbling(fouls.withWatermark(EVENT_TIME, delay), duration)


def yellow_cards_stream(
    events: DataFrame, duration: str = CARD_WINDOW, slide: str = CARD_SLIDE, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Output mode ``update`` (or ``append``); per-player sliding counts + alert."""
    cards = card_events(with_event_time(events)).withWatermark(EVENT_TIME, delay)
    return yellow_cards_sliding(cards, duration, slide, strategy="native")


def closed_yellow_cards_stream(
    events: DataFrame, duration: str = CARD_WINDOW, slide: str = CARD_SLIDE, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Output mode ``append``; the rows of :func:`yellow_cards_stream`, of closed windows only.

    Two chained time-window aggregations: the state holds one row for each pane
    and player that has cards, and one for each open window, instead of each
    event being copied ``duration / slide`` times on its way to the state.  A row
    is late when its pane is closed, ``delay`` after the pane's end.
    """
    cards = card_events(with_event_time(events)).withWatermark(EVENT_TIME, delay)
    panes = cards.groupBy(F.window(EVENT_TIME, slide).alias("pane"), "team", "player").agg(F.count(F.lit(1)).alias("cards"))
    panes = panes.select("team", "player", "cards", F.window_time("pane").alias("pane_time"))
    windows = panes.groupBy(F.window("pane_time", duration, slide).alias("window"), "team", "player")
    return _card_rows(windows.agg(F.sum("cards").alias("yellow_cards")))


def _card_rows(windows: DataFrame) -> DataFrame:
    bounds = (F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
    return windows.select("team", "player", "yellow_cards", *bounds).withColumn("player_alert", player_alert())


def open_windows(spark: SparkSession, checkpoint: str, duration: str = CARD_WINDOW, slide: str = CARD_SLIDE) -> DataFrame:
    """The rows of the windows that a stopped :func:`closed_yellow_cards_stream` has not closed.

    They are in the state at the query's checkpoint: sums of closed panes in the
    windows' state, and panes that are still open in the panes' state.  The input
    is not read again.  A query that has run no batch has no open windows.
    """
    parts = [spark.createDataFrame([], "window struct<start: timestamp, end: timestamp>, team string, player string, cards long")]
    if any(n.isdigit() for n in fs.list_names(spark, f"{checkpoint.rstrip('/')}/commits")):
        for operator in (0, 1):
            state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
            rows = state.select("key.*", "value.*")
            if "sum" in rows.columns:
                parts.append(rows.withColumnRenamed("sum", "cards"))
            else:  # panes: the last moment of each tells its windows
                moment = F.col("window.end") - F.expr("INTERVAL 1 MICROSECOND")
                panes = rows.select("team", "player", F.col("count").alias("cards"), moment.alias("at"))
                parts.append(panes.select("team", "player", "cards", F.window("at", duration, slide).alias("window")))
    rows = reduce(DataFrame.unionByName, parts)
    return _card_rows(rows.groupBy("window", "team", "player").agg(F.sum("cards").alias("yellow_cards")))


def momentum_batch(closed_windows: DataFrame) -> DataFrame:
    """Per micro-batch of closed windows (append mode): attach the team flag."""
    return with_team_momentum(closed_windows)


def player_stats_stream(events: DataFrame) -> DataFrame:
    """Output mode ``update``; running totals of performance events."""
    return player_totals(with_event_time(events), performance_only=True)


def player_table_rows(players: DataFrame) -> DataFrame:
    """Result-table shape of player totals: renamed, NULL sums written as 0."""
    renamed = players.select(
        "team",
        "player",
        F.col("total_goals_scored").alias("goals"),
        F.col("total_assists").alias("assists"),
        F.col("total_shots_taken").alias("shots_taken"),
        F.col("scoring_percentage"),
    )
    return renamed.fillna(0, subset=["goals", "assists", "shots_taken", "scoring_percentage"])


def scoreboard_stream(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Output mode ``update``; ``team, goals``.

    Goals are deduplicated on the event time.  Without a ``delay`` the state
    holds every event time for ever, as the original consumer did: no goal is
    dropped as late and none counts twice.  With a ``delay`` the state is
    bounded by a watermark, at the price that goals which come later than that
    are lost.  Of several goals of one time the one read first counts; see
    :func:`goal_firsts_stream` for the lowest event id.
    """
    goals = goal_events(with_event_time(events))
    if delay is None:
        firsts = goals.dropDuplicates([EVENT_TIME])
    else:
        firsts = goals.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark([EVENT_TIME])
    return firsts.groupBy("team").agg(
        F.sum(F.coalesce(F.col("goals_scored"), F.lit(0))).cast("bigint").alias("goals")
    )


def goal_firsts_stream(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Output mode ``update``; one row per goal timestamp: the lowest event id.

    Exact without a ``delay``: the state keeps every goal time, none is late.
    With one, goals later than that are dropped and the state is bounded.

    The hot-key-safe scoreboard form.  Deduplication is a streaming
    aggregation ``min(struct(event_id, team, goals))`` per timestamp, which
    Spark aggregates partially before the state shuffle, so a timestamp that
    carries a large share of a micro-batch is collapsed map-side (the
    ``dropDuplicates`` forms send every copy to one state partition).  It
    also gives the batch rule exactly (lowest ``event_id``).  Upsert the rows keyed by ``event_timestamp`` (partitioned by
    :func:`goal_firsts_partition`) and read the board with
    :func:`scoreboard_from_firsts`.
    """
    goals = goal_events(with_event_time(events))
    if delay is not None:
        goals = goals.withWatermark(EVENT_TIME, delay)
    first = F.min(F.struct("event_id", "team", F.coalesce(F.col("goals_scored"), F.lit(0)).alias("goals")))
    return goals.groupBy(EVENT_TIME).agg(first.alias("_f")).select(
        EVENT_TIME, F.col("_f.event_id").alias("event_id"), F.col("_f.team").alias("team"),
        F.col("_f.goals").cast("bigint").alias("goals"),
    )


def goal_firsts_partition(granularity: str = "day") -> tuple[str, F.Column]:
    """Partitions of the firsts table: a merge rewrites the touched ones.

    ``"day"`` suits backfills (few folders); ``"hour"`` keeps live merges to
    the goals of the current hour when goal rates are very high.
    """
    fmt = {"day": "yyyyMMdd", "hour": "yyyyMMddHH"}[granularity]
    return (f"goal_{granularity}", F.date_format(EVENT_TIME, fmt))


def scoreboard_from_firsts(firsts: DataFrame) -> DataFrame:
    """``team, goals`` summed over the first goal of every timestamp (known teams zero-filled)."""
    from matchstream.operators.serving import scoreboard_readout

    return scoreboard_readout(firsts.groupBy("team").agg(F.sum("goals").alias("goals")))

"""Scoreboard: goals per team from goal events, first event per key wins.

Deduplication is an aggregation, not a ranking window: for each key the
smallest ``(event_id, ...)`` struct is kept with ``min``, which Spark
aggregates partially on the map side.  A key that holds a large share of the
rows (a default timestamp, a replayed burst) is collapsed to one row per map
task before the shuffle instead of being sorted inside one reducer.

Zero-fill of known teams is a union with zero rows ahead of the per-team sum
— no join — and teams that are not in the list still appear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstream.schema import TEAMS


def first_per_key(
    events: DataFrame, keys: Sequence[str | Column], order_col: str = "event_id"
) -> DataFrame:
    """One row per key: the row with the lowest ``order_col`` (then the other columns).

    ``keys`` may be column names or expressions (e.g. ``date_trunc``); the
    output has the key columns followed by the kept row's remaining columns.
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"_k{i}" for i in range(len(key_cols))]
    rest = [c for c in events.columns]
    ordered = ([order_col] if order_col in rest else []) + [c for c in rest if c != order_col]
    kept = events.groupBy(*[c.alias(n) for c, n in zip(key_cols, key_names)]).agg(
        F.min(F.struct(*ordered)).alias("_first")
    )
    return kept.select(*[F.col(f"_first.{c}").alias(c) for c in rest])


def goal_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "goal")


def scoreboard(
    events: DataFrame,
    dedup_keys: Sequence[str | Column] = ("event_timestamp",),
    teams: Sequence[str] = TEAMS,
    with_event_counts: bool = False,
) -> DataFrame:
    """``team, goals`` (and ``goal_events`` when asked).

    Goals are ``goals_scored`` of goal rows (missing -> 0), counted once per
    dedup key (default: the event timestamp, as the live scoreboard did).
    """
    cols = ["team", "goals_scored"] + (["event_id"] if "event_id" in events.columns else [])
    firsts = first_per_key(goal_events(events).select("event_timestamp", *cols), dedup_keys)
    scored = firsts.select(
        "team", F.coalesce(F.col("goals_scored"), F.lit(0)).cast("bigint").alias("goals"), F.lit(1).alias("n")
    )
    spark = events.sparkSession
    zero = spark.createDataFrame([(t, 0, 0) for t in teams], "team string, goals bigint, n int")
    board = scored.unionByName(zero).groupBy("team").agg(
        F.sum("goals").alias("goals"), F.sum("n").cast("bigint").alias("goal_events")
    )
    return board if with_event_counts else board.select("team", "goals")

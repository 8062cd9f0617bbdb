"""Player performance: totals, scoring percentage, leaderboard, time ranges.

Two populations exist (both kept):
* all events — every player who appears, possibly with all-zero totals;
* performance events only (goal, assist, shot) — the topic-fed variant.
"Goals" here sum ``goals_scored`` over goal *and* shot rows (shots carry
goals too); the scoreboard counts goal rows only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstream.schema import PERFORMANCE_TYPES

PLAYER_COLUMNS = [
    "team",
    "player",
    "total_shots_taken",
    "total_goals_scored",
    "total_assists",
    "scoring_percentage",
]


def scoring_percentage(goals: str = "total_goals_scored", shots: str = "total_shots_taken"):
    """goals / shots * 100 when shots > 0, else 0 (NULL shots -> 0)."""
    return (
        F.when(F.col(shots) > 0, F.col(goals) / F.col(shots) * F.lit(100))
        .otherwise(F.lit(0.0))
        .cast("double")
    )


def player_totals(events: DataFrame, performance_only: bool = False) -> DataFrame:
    """``team, player, total_shots_taken, total_goals_scored, total_assists, scoring_percentage``.

    One hash aggregate with map-side partial sums: a hot player is collapsed
    to one row per map task before the shuffle.
    """
    src = events.where(F.col("event_type").isin(*PERFORMANCE_TYPES)) if performance_only else events
    totals = src.groupBy("team", "player").agg(
        F.sum("shots_taken").alias("total_shots_taken"),
        F.sum("goals_scored").alias("total_goals_scored"),
        F.sum(F.when(F.col("event_type") == "assist", F.lit(1)).otherwise(F.lit(0))).alias("total_assists"),
    )
    return totals.withColumn("scoring_percentage", scoring_percentage()).select(*PLAYER_COLUMNS)


def leaderboard(players: DataFrame) -> DataFrame:
    """Goals desc, scoring percentage desc, assists desc; team, player break ties."""
    return players.orderBy(
        F.col("total_goals_scored").desc(),
        F.col("scoring_percentage").desc(),
        F.col("total_assists").desc(),
        F.col("team").asc(),
        F.col("player").asc(),
    )


def time_range(
    events: DataFrame,
    start: str | dt.datetime,
    end: str | dt.datetime,
    time_col: str = "event_timestamp",
) -> DataFrame:
    """Rows with ``start <= time < end`` (half-time / post-match summaries).

    The bounds are typed like the column, so the comparison folds to a
    literal and reaches the Parquet scan as a pushed filter (and prunes
    ``event_date`` partitions on a partitioned table).
    """
    dtype = events.schema[time_col].dataType.simpleString()
    lo = F.lit(str(start)).cast(dtype)
    hi = F.lit(str(end)).cast(dtype)
    cond = (F.col(time_col) >= lo) & (F.col(time_col) < hi)
    if "event_date" in events.columns:
        # Partition column of the stored table: prune whole directories.
        cond = cond & F.col("event_date").between(F.to_date(lo), F.to_date(hi))
    return events.where(cond)

"""Serving queries over the stored result tables (latest-N, top-N, labels).

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps its
own top n and only those reach the final merge — no global sort.  Ties are
broken by team (and player) so that the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.functions.format import alert_label, percent_text
from matchstream.schema import TEAMS


def latest_fouls(fouls: DataFrame, n: int = 10) -> DataFrame:
    """Most recent foul windows: window_end desc, team."""
    return fouls.select("team", "fouls", "window_start", "window_end").orderBy(
        F.col("window_end").desc(), F.col("team").asc()
    ).limit(n)


def latest_yellow_cards(cards: DataFrame, n: int = 20) -> DataFrame:
    """Most recent card windows with the alert label (``🚨 OUT`` or empty)."""
    top = cards.orderBy(F.col("window_end").desc(), F.col("team").asc(), F.col("player").asc()).limit(n)
    return top.select(
        "team",
        "player",
        "yellow_cards",
        "window_start",
        "window_end",
        alert_label("player_alert").alias("player_alert"),
    )


def top_players(players: DataFrame, n: int = 20) -> DataFrame:
    """Top players by goals, then scoring percentage; percentage as text."""
    top = players.orderBy(
        F.col("total_goals_scored").desc(),
        F.col("scoring_percentage").desc(),
        F.col("team").asc(),
        F.col("player").asc(),
    ).limit(n)
    return top.select(
        "team",
        "player",
        F.col("total_goals_scored").alias("goals"),
        F.col("total_assists").alias("assists"),
        F.col("total_shots_taken").alias("shots_taken"),
        percent_text("scoring_percentage").alias("scoring_percentage"),
    )


def scoreboard_readout(board: DataFrame | None, spark: SparkSession | None = None, teams=TEAMS) -> DataFrame:
    """``team, goals`` with every known team present (0 when it has not scored).

    A union with zero rows and a per-team sum: no join, unknown teams kept.
    """
    spark = board.sparkSession if board is not None else (spark or SparkSession.getActiveSession())
    zero = spark.createDataFrame([(t, 0) for t in teams], "team string, goals bigint")
    rows = zero if board is None else board.select("team", F.col("goals").cast("bigint")).unionByName(zero)
    return rows.groupBy("team").agg(F.sum("goals").alias("goals"))

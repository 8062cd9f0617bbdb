"""Foul metrics: per team in tumbling event-time windows, and match totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstream.operators.windows import tumbling_counts
from matchstream.schema import FOUL_WINDOW


def foul_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "foul")


def fouls_tumbling(events: DataFrame, duration: str = FOUL_WINDOW) -> DataFrame:
    """``team, fouls, window_start, window_end`` — one row per team and window.

    Plans as partial count -> shuffle on (window, team) -> final count; the
    window start spreads a hot team over many reducers.
    """
    return tumbling_counts(foul_events(events), "event_timestamp", duration, ["team"], "fouls")


def fouls_by_team(events: DataFrame) -> DataFrame:
    """``team, fouls`` over the whole input (the per-team total)."""
    return foul_events(events).groupBy("team").agg(F.count(F.lit(1)).alias("fouls"))

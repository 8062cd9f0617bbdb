"""Run summaries: event counts per metric family and in total (one pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstream.schema import PERFORMANCE_TYPES


def metric_family(event_type):
    return (
        F.when(event_type == "yellow_card", F.lit("yellow_card"))
        .when(event_type.isin(*PERFORMANCE_TYPES), F.lit("player_performance"))
        .when(event_type == "foul", F.lit("foul"))
    )


def family_counts(events: DataFrame) -> DataFrame:
    """``family, events``: rows per family plus a ``total`` row.

    ROLLUP computes the families and their total in the same aggregation
    (one scan, one shuffle of a handful of partial rows).
    """
    fam = events.select(metric_family(F.col("event_type")).alias("family")).where(
        F.col("family").isNotNull()
    )
    rolled = fam.rollup("family").agg(F.count(F.lit(1)).alias("events"), F.grouping_id().alias("_g"))
    return rolled.select(
        F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col("family")).alias("family"), "events"
    )

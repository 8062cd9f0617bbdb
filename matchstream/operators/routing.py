"""Topic router: each event to the topics that consume it.

goal -> live_score and player_performance; assist, shot -> player_performance;
foul -> team_stats_1min; yellow_card -> live_card; anything else -> unrouted.
A narrow map (``explode`` of a topic array): no shuffle; the writer sends
each task's rows straight to Kafka or to ``topic=...`` directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstream.schema import (
    TOPIC_LIVE_CARD,
    TOPIC_LIVE_SCORE,
    TOPIC_PLAYER_PERFORMANCE,
    TOPIC_TEAM_STATS,
    TOPIC_UNROUTED,
)

WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def topics_for(event_type):
    one = lambda t: F.array(F.lit(t))
    return (
        F.when(event_type == "goal", F.array(F.lit(TOPIC_LIVE_SCORE), F.lit(TOPIC_PLAYER_PERFORMANCE)))
        .when(event_type.isin("assist", "shot"), one(TOPIC_PLAYER_PERFORMANCE))
        .when(event_type == "foul", one(TOPIC_TEAM_STATS))
        .when(event_type == "yellow_card", one(TOPIC_LIVE_CARD))
        .otherwise(one(TOPIC_UNROUTED))
    )


WIRE_FIELDS = ("event_type", "team", "player", "shots_taken", "goals_scored")


def wire_value(time_format: str = WIRE_TIME_FORMAT, extra_fields: tuple[str, ...] = ()):
    """The JSON message body: the six event fields, timestamp as ISO text."""
    parts = [F.lit("timestamp"), F.date_format("event_timestamp", time_format)]
    for name in WIRE_FIELDS + tuple(extra_fields):
        parts += [F.lit(name), F.col(name)]
    return F.to_json(F.named_struct(*parts))


def route_topics(events: DataFrame, with_event_id: bool = False) -> DataFrame:
    """``topic, event_id?, value`` — one row per (event, topic).

    ``with_event_id`` puts the id into the message too, for consumers that need
    the lowest one of several events.
    """
    extra = ["event_id"] if "event_id" in events.columns else []
    value = wire_value(extra_fields=tuple(extra) if with_event_id else ())
    return events.select(F.explode(topics_for(F.col("event_type"))).alias("topic"), *extra, value.alias("value"))


def write_routed_files(routed: DataFrame, path: str) -> None:
    """File replay of the topics: one ``topic=<name>`` directory per topic."""
    routed.select("topic", "value").write.mode("append").partitionBy("topic").parquet(path)

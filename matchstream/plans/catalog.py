"""The registered queries, each over the driver's tables at ``sf_dir``.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from
``events.parquet`` (through the test-data adapter) — no fixed input, no row
caps except where the cap *is* the feature (latest-N / top-N serving).
The event types each query needs are passed to the adapter so that the type
filter reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.functions.parse import parse_json_events
from matchstream.operators import (
    family_counts,
    fouls_by_team,
    fouls_tumbling,
    latest_fouls,
    latest_yellow_cards,
    leaderboard,
    player_totals,
    route_topics,
    scoreboard,
    time_range,
    top_players,
    with_team_momentum_join,
    yellow_cards_by_team_player,
    yellow_cards_sliding,
    yellow_momentum,
)
from matchstream.operators.routing import wire_value
from matchstream.schema import PERFORMANCE_TYPES
from matchstream.session import scratch_path
from matchstream.sources.files import append_match_events, read_events_csv, write_events_csv
from matchstream.sources.testdata import load_match_events_from_testdata

Query = Callable[[SparkSession, str], DataFrame]

HALF_TIME_RANGE = ("2024-01-01 00:00:00", "2024-01-16 00:00:00")
EVENT_COLUMNS = [
    "event_id",
    "event_timestamp",
    "event_type",
    "team",
    "player",
    "shots_taken",
    "goals_scored",
]


def _events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return load_match_events_from_testdata(spark, sf_dir, types or None)


def q_fouls_tumbling_1m(spark, sf_dir):
    return fouls_tumbling(_events(spark, sf_dir, "foul"), "1 minute")


def q_fouls_tumbling_10m(spark, sf_dir):
    return fouls_tumbling(_events(spark, sf_dir, "foul"), "10 minutes")


def q_fouls_by_team(spark, sf_dir):
    return fouls_by_team(_events(spark, sf_dir, "foul"))


def _yellow_cards_5m(spark, sf_dir):
    return yellow_cards_sliding(_events(spark, sf_dir, "yellow_card"), "5 minutes", "1 minute")


def q_yellow_cards_5m(spark, sf_dir):
    return _yellow_cards_5m(spark, sf_dir).orderBy("window_start", "team", "player")


def q_yellow_cards_60m(spark, sf_dir):
    return yellow_cards_sliding(_events(spark, sf_dir, "yellow_card"), "60 minutes", "10 minutes")


def q_yellow_momentum_5m(spark, sf_dir):
    return yellow_momentum(_events(spark, sf_dir, "yellow_card"), "5 minutes", "1 minute")


def q_yellow_momentum_60m(spark, sf_dir):
    return yellow_momentum(_events(spark, sf_dir, "yellow_card"), "60 minutes", "10 minutes")


def q_yellow_momentum_join(spark, sf_dir):
    counts = yellow_cards_sliding(
        _events(spark, sf_dir, "yellow_card"), "60 minutes", "10 minutes", strategy="native"
    )
    return with_team_momentum_join(counts)


def q_yellow_cards_by_team_player(spark, sf_dir):
    return yellow_cards_by_team_player(_events(spark, sf_dir, "yellow_card"))


def q_player_stats_all(spark, sf_dir):
    return player_totals(_events(spark, sf_dir), performance_only=False)


def q_player_stats_performance(spark, sf_dir):
    return player_totals(_events(spark, sf_dir, *PERFORMANCE_TYPES), performance_only=True)


def q_player_stats_half_time(spark, sf_dir):
    events = time_range(_events(spark, sf_dir, *PERFORMANCE_TYPES), *HALF_TIME_RANGE)
    return player_totals(events, performance_only=True)


def q_player_leaderboard(spark, sf_dir):
    return leaderboard(player_totals(_events(spark, sf_dir), performance_only=False))


def q_scoreboard(spark, sf_dir):
    return scoreboard(_events(spark, sf_dir, "goal"))


def q_scoreboard_collisions(spark, sf_dir):
    hour = F.date_trunc("hour", F.col("event_timestamp"))
    return scoreboard(_events(spark, sf_dir, "goal"), dedup_keys=[hour], with_event_counts=True)


def q_route_topics(spark, sf_dir):
    return route_topics(_events(spark, sf_dir))


def q_parse_events(spark, sf_dir):
    """Adapter rows -> JSON message bytes -> parsed, typed rows (quarantine empty)."""
    events = _events(spark, sf_dir)
    wire = events.select(F.encode(wire_value(extra_fields=("event_id",)), "UTF-8").alias("value"))
    parsed, _quarantine = parse_json_events(wire, "value", with_event_id=True, ntz=True)
    return parsed


def q_load_match_events(spark, sf_dir):
    """Adapter rows -> header CSV -> CSV source (S1) -> append into the
    ``match_events`` Parquet table partitioned by date (K1) -> read back."""
    base = scratch_path(spark, "csv-load")
    write_events_csv(_events(spark, sf_dir), f"{base}/csv", with_event_id=True)
    loaded = read_events_csv(spark, f"{base}/csv", ntz=True, with_event_id=True)
    append_match_events(loaded, f"{base}/match_events")
    return spark.read.parquet(f"{base}/match_events").select(*EVENT_COLUMNS)


def q_family_counts(spark, sf_dir):
    return family_counts(_events(spark, sf_dir))


def q_serve_fouls_latest(spark, sf_dir):
    return latest_fouls(q_fouls_tumbling_1m(spark, sf_dir), 10)


def q_serve_yellow_latest(spark, sf_dir):
    return latest_yellow_cards(_yellow_cards_5m(spark, sf_dir), 20)


def q_serve_player_top20(spark, sf_dir):
    return top_players(q_player_stats_performance(spark, sf_dir), 20)


BATCH_QUERIES: dict[str, Query] = {
    "fouls_tumbling_1m": q_fouls_tumbling_1m,
    "fouls_tumbling_10m": q_fouls_tumbling_10m,
    "fouls_by_team": q_fouls_by_team,
    "yellow_cards_5m": q_yellow_cards_5m,
    "yellow_cards_60m": q_yellow_cards_60m,
    "yellow_momentum_5m": q_yellow_momentum_5m,
    "yellow_momentum_60m": q_yellow_momentum_60m,
    "yellow_momentum_join": q_yellow_momentum_join,
    "yellow_cards_by_team_player": q_yellow_cards_by_team_player,
    "player_stats_all": q_player_stats_all,
    "player_stats_performance": q_player_stats_performance,
    "player_stats_half_time": q_player_stats_half_time,
    "player_leaderboard": q_player_leaderboard,
    "scoreboard": q_scoreboard,
    "scoreboard_collisions": q_scoreboard_collisions,
    "route_topics": q_route_topics,
    "parse_events": q_parse_events,
    "load_match_events": q_load_match_events,
    "family_counts": q_family_counts,
    "serve_fouls_latest": q_serve_fouls_latest,
    "serve_yellow_latest": q_serve_yellow_latest,
    "serve_player_top20": q_serve_player_top20,
}

__all__ = ["BATCH_QUERIES", "Query"]

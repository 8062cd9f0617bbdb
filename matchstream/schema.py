"""Schemas, event domain and the fixed parameters of the analytics."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the original application's) -------------------
# Event types counted in player performance.
PERFORMANCE_TYPES = ("goal", "assist", "shot")
# Teams known before any event arrives (scoreboard starts them at 0).
TEAMS = ("FC Python", "AI United")
# A player is flagged when their window count is at least this.
PLAYER_ALERT_MIN_CARDS = 2
# A team loses momentum when its window total is strictly above this.
TEAM_MOMENTUM_MAX_CARDS = 3
# Topic names of the router.
TOPIC_LIVE_SCORE = "live_score"
TOPIC_PLAYER_PERFORMANCE = "player_performance"
TOPIC_TEAM_STATS = "team_stats_1min"
TOPIC_LIVE_CARD = "live_card"
# Window sizes and watermark delay.
FOUL_WINDOW = "1 minute"
CARD_WINDOW = "5 minutes"
CARD_SLIDE = "1 minute"
WATERMARK_DELAY = "2 minutes"
# Label shown for an alerted player.
ALERT_LABEL = "🚨 OUT"
# --- end of fixed values ----------------------------------------------------

# Topic for events of an unknown type (never guessed from a previous row).
TOPIC_UNROUTED = "unrouted"

# The CSV files carry the same six fields under the wire name ``timestamp``;
# everything is read as text and typed with try-casts (ANSI-safe).
CSV_TEXT = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("team", T.StringType(), True),
        T.StructField("player", T.StringType(), True),
        T.StructField("shots_taken", T.StringType(), True),
        T.StructField("goals_scored", T.StringType(), True),
    ]
)

# JSON message value on the wire (one object per event).
WIRE_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("team", T.StringType(), True),
        T.StructField("player", T.StringType(), True),
        T.StructField("shots_taken", T.IntegerType(), True),
        T.StructField("goals_scored", T.IntegerType(), True),
    ]
)

# Result-table keys (values are everything else).
FOUL_KEYS = ("team", "window_start")
CARD_KEYS = ("team", "player", "window_start")
CARD_GROUPS = ("team", "window_start", "window_end")  # rows that share the team flag
PLAYER_KEYS = ("team", "player")
SCOREBOARD_KEYS = ("team",)
GOAL_FIRST_KEYS = ("event_timestamp",)

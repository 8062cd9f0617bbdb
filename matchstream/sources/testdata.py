"""Adapter: the driver's generic ``events`` table seen as ``match_events``.

``events`` (event_id, ts, user_id, event_type, value, props) is re-labelled
column by column with JVM-side expressions, so the whole table flows through
one narrow projection.  The caller may name the match event types it needs:
the filter is then stated on the *raw* column, which Parquet can push down
(a filter on the re-labelled column is a CASE expression the scan cannot use).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: raw event type -> match event type ------------------------
RAW_TO_MATCH_TYPE = {
    "purchase": "goal",
    "click": "shot",
    "signup": "assist",
    "view": "foul",
    "error": "yellow_card",
}
# Even user ids play for the first team below, odd ones for the second.
EVEN_TEAM = "AI United"
ODD_TEAM = "FC Python"
PLAYERS_PER_CLUB = 6          # player = "P" + (user_id % 6)
SHOTS_MODULUS = 16            # shots_taken = k % 16 on goal/shot rows
GOALS_MODULUS = 4             # goals_scored = k % 4 on goal/shot rows
SCORING_RAW_TYPES = ("purchase", "click")   # rows that carry shots and goals
# --- end of fixed values ----------------------------------------------------

MATCH_TO_RAW_TYPE = {v: k for k, v in RAW_TO_MATCH_TYPE.items()}

# Declared layout of the driver's ``events`` table (no footer inference).
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mapped_type_sql() -> str:
    arms = " ".join(f"WHEN {_sql_text(src)} THEN {_sql_text(dst)}" for src, dst in RAW_TO_MATCH_TYPE.items())
    return f"CASE event_type {arms} END"


def adapt_events(events: DataFrame, event_types: Iterable[str] | None = None) -> DataFrame:
    """Map a raw ``events`` DataFrame to ``match_events`` columns.

    The mapping is stated as SQL expressions (parsed once in the JVM); ``k``
    is extracted from ``props`` once per scoring row in its own projection,
    since it feeds two columns.
    """
    if event_types is not None:
        wanted = sorted({MATCH_TO_RAW_TYPE[t] for t in event_types if t in MATCH_TO_RAW_TYPE})
        events = events.where(F.col("event_type").isin(wanted))
    scoring = f"event_type IN ({_sql_text(SCORING_RAW_TYPES[0])}, {_sql_text(SCORING_RAW_TYPES[1])})"
    with_k = events.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        f"{scoring} AS _scoring",
        f"CASE WHEN {scoring} THEN try_cast(get_json_object(props, '$.k') AS INT) END AS _k",
    )
    return with_k.selectExpr(
        "event_id",
        "ts AS event_timestamp",
        f"{_mapped_type_sql()} AS event_type",
        f"CASE WHEN user_id % 2 = 0 THEN {_sql_text(EVEN_TEAM)} ELSE {_sql_text(ODD_TEAM)} END AS team",
        f"concat('P', CAST(user_id % {PLAYERS_PER_CLUB} AS STRING)) AS player",
        f"CAST(CASE WHEN _scoring THEN _k % {SHOTS_MODULUS} ELSE 0 END AS INT) AS shots_taken",
        f"CAST(CASE WHEN _scoring THEN _k % {GOALS_MODULUS} ELSE 0 END AS INT) AS goals_scored",
    )


def load_match_events_from_testdata(
    spark: SparkSession, sf_dir: str, event_types: Iterable[str] | None = None
) -> DataFrame:
    """Read ``{sf_dir}/events.parquet`` and adapt it (see module doc)."""
    events = spark.read.schema(RAW_EVENTS).parquet(os.path.join(sf_dir, "events.parquet"))
    return adapt_events(events, event_types)


ORACLE_PRELUDE = """WITH match_events AS (
SELECT event_id, ts AS event_timestamp,
 CASE event_type WHEN 'purchase' THEN 'goal' WHEN 'click' THEN 'shot'
   WHEN 'signup' THEN 'assist' WHEN 'view' THEN 'foul'
   WHEN 'error' THEN 'yellow_card' END AS event_type,
 CASE WHEN user_id % 2 = 0 THEN 'AI United' ELSE 'FC Python' END AS team,
 concat('P', CAST(user_id % 6 AS VARCHAR)) AS player,
 CASE WHEN event_type IN ('purchase','click')
   THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 ELSE 0 END AS shots_taken,
 CASE WHEN event_type IN ('purchase','click')
   THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 ELSE 0 END AS goals_scored
FROM events)"""

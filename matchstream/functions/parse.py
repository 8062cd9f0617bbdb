"""Wire decoding: message value -> typed event rows, bad messages quarantined.

``from_json`` in PERMISSIVE mode turns malformed text into a struct of NULLs
(not a NULL struct), so the schema carries a ``_corrupt_record`` field that
receives the raw text of any message that did not parse.  Rules:

* nothing usable parsed (malformed text, not an object) -> quarantine
  ``malformed_json``;
* event time missing or not a valid ISO time -> quarantine ``bad_timestamp``;
* a field of the wrong type (``"shots_taken": "abc"``) only nulls that field:
  the rest of the event is kept and counted, as a plain PERMISSIVE parse did.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstream.functions.casts import iso_timestamp
from matchstream.schema import WIRE_EVENT

CORRUPT = "_corrupt_record"


def _wire_schema(with_event_id: bool) -> T.StructType:
    fields = list(WIRE_EVENT.fields)
    if with_event_id:
        fields.append(T.StructField("event_id", T.LongType(), True))
    fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def decode_json_events(
    df: DataFrame, value_col: str = "value", with_event_id: bool = False, ntz: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Every message once: its text, the typed event columns and a ``reason`` (null if it is usable).

    ``keep`` names columns of ``df`` that stay.
    """
    text = F.col(value_col).cast("string")
    parsed = F.from_json(
        text,
        _wire_schema(with_event_id),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    # Parse once per row: the struct leaves through a generator, so the
    # quarantine predicates above cannot be pushed below it (pushing them
    # through a plain projection would re-run from_json inside the filter).
    out = df.select(F.inline(F.array(F.struct(*keep, text.alias("value"), parsed.alias("d")))))
    cols = [
        *keep,
        F.col("value"),
        iso_timestamp(F.col("d.timestamp"), ntz=ntz).alias("event_timestamp"),
        F.col("d.event_type").alias("event_type"),
        F.col("d.team").alias("team"),
        F.col("d.player").alias("player"),
        F.col("d.shots_taken").alias("shots_taken"),
        F.col("d.goals_scored").alias("goals_scored"),
        F.col(f"d.{CORRUPT}").alias(CORRUPT),
    ]
    if with_event_id:
        cols.insert(len(keep) + 1, F.col("d.event_id").alias("event_id"))
    nothing_parsed = reduce(lambda a, b: a & b, [F.col(f"d.{f.name}").isNull() for f in WIRE_EVENT.fields])
    typed = out.select(*cols, nothing_parsed.alias("_empty"))
    reason = (
        F.when(F.col("value").isNull() | (F.col(CORRUPT).isNotNull() & F.col("_empty")), F.lit("malformed_json"))
        .when(F.col("event_timestamp").isNull(), F.lit("bad_timestamp"))
    )
    return typed.select(*[c for c in typed.columns if c != "_empty"], reason.alias("reason"))


def parse_json_events(
    df: DataFrame,
    value_col: str = "value",
    with_event_id: bool = False,
    ntz: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Split a DataFrame of JSON messages into (events, quarantine).

    ``events`` has the ``match_events`` columns (plus ``event_id`` when asked);
    ``quarantine`` has ``value`` (the raw text) and ``reason``.  The value
    column may be binary (Kafka) or string.
    """
    decoded = decode_json_events(df, value_col, with_event_id, ntz)
    keep = ["event_timestamp", "event_type", "team", "player", "shots_taken", "goals_scored"]
    if with_event_id:
        keep = ["event_id"] + keep
    events = decoded.where(F.col("reason").isNull()).select(*keep)
    quarantine = decoded.where(F.col("reason").isNotNull()).select("value", "reason")
    return events, quarantine

"""File sources and the append load into ``match_events``.

CSV cells are read as text with a declared schema (no inference pass over the
data) and typed with ANSI-safe casts: ISO timestamps, blank integers -> 0.
Blank lines are skipped by the CSV reader.  Parquet is the engine's own table
format; when it is written partitioned by ``event_date`` a time-range filter
prunes whole directories before any file is opened.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstream.functions.casts import int_or_zero, iso_timestamp
from matchstream.schema import CSV_TEXT
from matchstream.sinks import fs


def csv_text_schema(with_event_id: bool = False) -> T.StructType:
    fields = list(CSV_TEXT.fields)
    if with_event_id:
        fields.append(T.StructField("event_id", T.StringType(), True))
    return T.StructType(fields)


def type_csv_events(text: DataFrame, ntz: bool = True, with_event_id: bool = False) -> DataFrame:
    """Typed ``match_events`` rows from the CSV text columns."""
    cols = [
        iso_timestamp("timestamp", ntz=ntz).alias("event_timestamp"),
        F.col("event_type"),
        F.col("team"),
        F.col("player"),
        int_or_zero("shots_taken").alias("shots_taken"),
        int_or_zero("goals_scored").alias("goals_scored"),
    ]
    if with_event_id:
        cols.insert(0, F.col("event_id").try_cast("bigint").alias("event_id"))
    return text.select(*cols)


def read_csv_text(spark: SparkSession, path: str, with_event_id: bool = False) -> DataFrame:
    """The text columns of header CSV files, taken by name and in any order.

    All files must have the same header.  A missing column raises; further
    columns are ignored.  Quotes within quoted cells are doubled.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
    header = reader.csv(path).columns  # reads a header, no data
    wanted = [f.name for f in csv_text_schema(with_event_id).fields]
    missing = [c for c in wanted if c not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    return reader.schema(schema).option("mode", "PERMISSIVE").csv(path).select(*wanted)


def read_events_csv(
    spark: SparkSession, path: str, ntz: bool = True, with_event_id: bool = False
) -> DataFrame:
    """Header CSV (``timestamp,event_type,team,player,shots_taken,goals_scored``), bad rows left out."""
    return read_events_csv_checked(spark, path, ntz, with_event_id)[0]


def read_events_csv_checked(
    spark: SparkSession, path: str, ntz: bool = True, with_event_id: bool = False, counted: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of header CSV files.

    Quarantined are rows with a missing or bad time (``bad_timestamp``) or a
    number that is neither blank nor an integer (``bad_integer``); they keep
    their text columns and get a ``reason``.  ``counted`` gets ``input_rows`` and
    ``quarantined`` when the first job over the events has run.
    """
    text = read_csv_text(spark, path, with_event_id)
    numbers = {"shots_taken": "int", "goals_scored": "int"} | ({"event_id": "bigint"} if with_event_id else {})
    bad_number = reduce(
        or_,
        [F.coalesce(F.trim(c) != "", F.lit(False)) & F.trim(c).try_cast(kind).isNull() for c, kind in numbers.items()],
    )
    reason = F.when(iso_timestamp("timestamp", ntz=ntz).isNull(), "bad_timestamp").when(bad_number, "bad_integer")
    seen = text
    if counted is not None:
        seen = text.observe(counted, F.count(F.lit(1)).alias("input_rows"), F.count_if(reason.isNotNull()).alias("quarantined"))
    good = type_csv_events(seen.where(reason.isNull()), ntz=ntz, with_event_id=with_event_id)
    return good, text.withColumn("reason", reason).where("reason is not null")


def events_to_csv_text(events: DataFrame, with_event_id: bool = False) -> DataFrame:
    """The inverse of :func:`type_csv_events` (full microsecond precision)."""
    cols = [
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type"),
        F.col("team"),
        F.col("player"),
        F.col("shots_taken").cast("string").alias("shots_taken"),
        F.col("goals_scored").cast("string").alias("goals_scored"),
    ]
    if with_event_id:
        cols.append(F.col("event_id").cast("string").alias("event_id"))
    return events.select(*cols)


def write_events_csv(events: DataFrame, path: str, with_event_id: bool = False) -> None:
    """Write events as header CSV, one file per task (no single-writer funnel)."""
    events_to_csv_text(events, with_event_id).write.mode("overwrite").option("header", True).csv(path)


def read_events_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_match_events(
    events: DataFrame, path: str, partition_by_date: bool = True, load_id: str | None = None
) -> None:
    """K1: append typed events to the ``match_events`` Parquet table.

    Partitioning by ``event_date`` lets time-range summaries prune directories;
    rows are rebalanced by date first, so that a date has about one file, and
    one that is too large for a task is split.  A ``load_id`` names the load: a
    retry with the same id replaces the rows of the earlier attempt.  Use it for
    all loads of a table or for none, since it is a partition column too.
    """
    out, parts = events, []
    if load_id is not None:
        out, parts = out.withColumn("load_id", F.lit(load_id)), ["load_id"]
    if partition_by_date:
        out = out.withColumn("event_date", F.to_date("event_timestamp")).hint("rebalance", "event_date")
        parts.append("event_date")
    if load_id is None:
        writer = out.write.mode("append")
        (writer.partitionBy(*parts) if parts else writer).parquet(path)
        return
    # The earlier attempt's folder goes as a whole: its dates may differ.
    fs.delete_tree(events.sparkSession, f"{path.rstrip('/')}/load_id={load_id}")
    out.write.mode("append").partitionBy(*parts).parquet(path)

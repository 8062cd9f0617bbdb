"""JDBC source and sinks.

The read is split into ``num_partitions`` range queries on a numeric or time
column, so a large table is pulled by many executors in parallel (the
original read everything through one connection).  Without bounds from the caller
the splits come from the data: quantiles of the column, so that a skewed column
makes splits of equal size.  Filters and projections above the read are pushed into
the generated SQL by Spark itself.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(spark: SparkSession, url: str, column: str) -> str:
    """A column's name in the quotes of the database, as Spark writes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def _literal(value) -> str:
    """A split point in SQL; times in the escapes that every JDBC driver takes."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, int | float | Decimal):
        return str(value)
    raise ValueError(f"a table can be split by a numeric or time column, not by {value!r}")


def range_predicates(column: str, points: list) -> list[str]:
    """Conditions that deal the values of ``column`` (quoted) to ranges between sorted ``points``; NULLs go to the first."""
    points = [_literal(p) for p in points]
    if not points:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:])]
    return [f"{column} < {points[0]} OR {column} IS NULL", *between, f"{column} >= {points[-1]}"]


def quantile_predicates(
    spark: SparkSession, url: str, table: str, column: str, splits: int, options: dict[str, str]
) -> list[str]:
    """Conditions for about equal splits by ``column``, from its approximate quantiles.

    Reads the smallest and largest value, then the column alone by as many even
    ranges, and takes the quantiles in Spark.  A value that many rows share can't be
    split; then there are fewer, larger splits.  An empty table has one.
    """
    name = _quoted(spark, url, column)
    ends = spark.read.format("jdbc").option("url", url).options(**options)
    low, high = ends.option("query", f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}").load().first()
    if low is None or low == high:
        return ["1 = 1"]
    even = range_predicates(name, _even_points(low, high, splits))
    values = spark.read.jdbc(url, table, predicates=even, properties=options).select(column)
    shares = [i / splits for i in range(1, splits)]
    found = values.select(F.percentile_approx(column, shares, 100 * splits)).first()[0]
    return range_predicates(name, sorted({p for p in found if p > low}))


def _even_points(low, high, splits: int) -> list:
    """Points that cut the range into even parts."""
    step = (high - low) / splits
    if isinstance(low, int):
        return sorted({low + int(step * i) for i in range(1, splits)} - {low})
    return [low + step * i for i in range(1, splits)]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """The rows of ``table``, read by ``num_partitions`` queries split by ``partition_column``.

    With both bounds the splits are even between them; without, they follow the
    data (:func:`quantile_predicates`).
    """
    options = {"driver": driver, "user": user, "password": password, "fetchsize": str(fetch_size)}
    options = {k: v for k, v in options.items() if v is not None}
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    if not num_partitions:
        raise ValueError("a partitioned JDBC read needs num_partitions")
    if (lower_bound is None) != (upper_bound is None):
        raise ValueError("a partitioned JDBC read needs both bounds or none")
    if lower_bound is None:
        predicates = quantile_predicates(spark, url, table, partition_column, num_partitions, options)
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    reader = (
        reader.option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower_bound))
        .option("upperBound", str(upper_bound))
        .option("numPartitions", str(num_partitions))
    )
    return reader.load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    column_types: str | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Set-based write: every task inserts its rows in JDBC batches."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size))
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            writer = writer.option(key, value)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.mode(mode).save()

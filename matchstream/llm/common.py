"""Shared helpers of the text operators: reading, shared storage, batches."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchstream.session import scratch_path

#: Bounds of one Arrow batch between the JVM and a Python worker.  Rows are
#: whole texts, so the default of 10,000 rows could be gigabytes.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
#: Bytes of text in a chunk of documents.
CHUNK_BYTES = 2 << 20

_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and by bytes, and let the
    Python workers find this library where the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in [_HOME, *paths] if p)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared work folder and read again.

    Cuts the lineage: a lost executor costs no recomputation before this
    point, and values that depend on the split of the input (row numbers made
    in a task) are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_row() -> int:
    """The number of the first row of this task's partition.

    Partitions are counted within the stage, so tables numbered by it must reach
    a shuffle or a write before they are united with others.
    """
    return TaskContext.get().partitionId() << 36


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` with a number for each row, by partition and the order in it.

    Over a table in storage a second run gives the same numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = first_row()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.arange(row, row + b.num_rows))], names=[*b.schema.names, name]
            )
            row += b.num_rows

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, LongType())]))


def in_chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """What ``chunked`` makes of the batches of a task."""
    row = chunk = first_row()
    held = 0
    for b in batches:
        chunks = []
        for n in pc.binary_length(b.column(text)).to_pylist():
            n = n or 0
            if held and held + n > CHUNK_BYTES:
                chunk, held = row, 0
            held += n
            chunks.append(chunk)
            row += 1
        rows = np.arange(row - b.num_rows, row)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(rows), pa.array(chunks, pa.int64())], names=[*b.schema.names, "_row", "_chunk"]
        )


def chunked(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the number of each row and of its chunk of about ``CHUNK_BYTES`` of text.

    The numbers are those of ``numbered``, and the same in each run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_chunks(batches, text)

    new = [StructField("_row", LongType()), StructField("_chunk", LongType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new]))


def reducers(spark: SparkSession) -> int:
    """The number of shuffle partitions that the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with neutral names for all columns that an operator doesn't need, and the columns that give the input's own back.

    So an operator can add columns of any name, and the input's own stay as they are.
    """
    neutral = {c: c if c in needed else f"column_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in neutral.items()])
    return inner, [F.col(n).alias(c) for c, n in neutral.items()]


def texts(column: pa.Array) -> list[str]:
    """An Arrow string column as Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``most``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from lists or arrays, in the order of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema
    )


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges ``starts[i] .. starts[i] + lengths[i] - 1``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix, element by element."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))

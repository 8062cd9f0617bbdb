"""Keyed result table: Parquet partitions that a micro-batch overwrites.

The table is a folder of Parquet files, partitioned by a bucket of the key (such
as the day of ``window_start``).  A merge reads the buckets that its update
touches, puts the new rows in the place of those with the same key, and writes
these buckets with Spark's dynamic partition overwrite; the others stay as
they are.

The rows are first written beside the table, as a whole.  A crash before that is
complete changes nothing, and the replayed batch starts anew; a crash while the
buckets are exchanged is made good from the complete copy by the next merge, and
until then readers take these buckets from the copy.  Rows carry absolute values, so
merging a batch twice changes nothing.  A table has one writer; a reader whose files
are exchanged while it runs fails and has to read again.  Keys are compared
null-safe: a NULL team or player is a key of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstream.sinks import fs

#: The bucket of rows without one, and of tables that are not partitioned.
NO_BUCKET = "none"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join with null-safe keys."""
    other = right.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return left.join(other, condition, how)


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        partition_by: tuple[str, Column] | None = None,
        finalize: Callable[[DataFrame], DataFrame] | None = None,
        groups: Sequence[str] = (),
    ) -> None:
        """``partition_by`` = (column name, expression over the row) or None.

        The expression gives the bucket as path-safe text, such as a date; it must be
        a function of the keys, so that a key never moves between buckets.

        ``finalize`` adds columns that depend on whole ``groups`` of rows, such as a
        per-(team, window) total.  A merge runs it over the groups that the update
        touches, stored rows included, and over no others.  A group must lie in one
        bucket.
        """
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.bucket, self.expression = partition_by or ("bucket", F.lit(NO_BUCKET))
        self.finalize = finalize
        self.groups = list(groups)

    # ---- reads ------------------------------------------------------------
    def _folders(self) -> dict[str, str]:
        """The folder of each stored bucket, in order of the buckets."""
        prefix = f"{self.bucket}="
        places = [self.path, self._copy()] if self._complete() else [self.path]
        found = {n[len(prefix):]: f"{p}/{n}" for p in places for n in fs.list_names(self.spark, p) if n.startswith(prefix)}
        return dict(sorted(found.items()))

    def read(self, only: Sequence[str] | None = None) -> DataFrame | None:
        """All rows, or those of ``only`` some buckets; None if there are none yet."""
        folders = self._folders()
        chosen = list(folders.values()) if only is None else [folders[b] for b in only if b in folders]
        return self.spark.read.parquet(*chosen) if chosen else None

    def read_newest(self, n: int) -> DataFrame | None:
        """Rows of the newest buckets that hold at least ``n`` rows together, all of them if there are fewer.

        With a time as bucket the latest rows are read without opening the history.
        """
        stored = list(self._folders())
        some = 1
        while some < len(stored):
            rows = self.read(stored[-some:])
            if rows.count() >= n:
                return rows
            some *= 2
        return self.read()

    # ---- writes -----------------------------------------------------------
    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.bucket, F.coalesce(self.expression.cast("string"), F.lit(NO_BUCKET)))

    def touched(self, update: DataFrame) -> list[str]:
        """The buckets of ``update``: a few days or hours of a micro-batch, whatever its rows."""
        return sorted(r[0] for r in self._with_bucket(update).select(self.bucket).distinct().collect())

    def merged(self, stored: DataFrame | None, update: DataFrame) -> DataFrame:
        """What the touched buckets hold after the merge."""
        columns = update.columns
        if self.finalize is None:
            return update if stored is None else _same(stored, update, self.keys, "left_anti").select(*columns).unionByName(update)
        if stored is None:
            return self.finalize(update)
        groups = update.select(*self.groups).distinct()
        mates = _same(stored, groups, self.groups, "left_semi").select(*columns)
        changed = self.finalize(_same(mates, update, self.keys, "left_anti").unionByName(update))
        return _same(stored, groups, self.groups, "left_anti").unionByName(changed)

    def merge(self, update: DataFrame) -> list[str]:
        """Upsert ``update`` (unique per key); the buckets that were rewritten, none for an empty update."""
        self._exchange()
        update = update.persist()
        try:
            touched = self.touched(update)
            if touched:
                self._write(self.merged(self.read(touched), update))
        finally:
            update.unpersist()
        return touched

    def overwrite(self, rows: DataFrame) -> None:
        """Put ``rows`` in the place of the buckets that they lie in."""
        self._exchange()
        self._write(rows)

    def _write(self, rows: DataFrame) -> None:
        # Rebalance by bucket: about one file each, large ones split by AQE.
        rows = self._with_bucket(rows).hint("rebalance", self.bucket)
        rows.write.mode("overwrite").partitionBy(self.bucket).parquet(self._copy())
        self._exchange()

    def _copy(self) -> str:
        return f"{self.path}.next"

    def _complete(self) -> bool:
        return fs.exists(self.spark, f"{self._copy()}/_SUCCESS")

    def _exchange(self) -> None:
        """Overwrite the table's buckets with those of a complete copy, if there is one."""
        copy = self._copy()
        if not self._complete():
            return
        rows = self.spark.read.parquet(copy)
        # The bucket is text, whatever Spark takes the folder names for.
        fields = [f for f in rows.schema.fields if f.name != self.bucket]
        rows = self.spark.read.schema(T.StructType([*fields, T.StructField(self.bucket, T.StringType())])).parquet(copy)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.bucket).parquet(self.path)
        fs.delete_tree(self.spark, copy)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``; replays change nothing, so the batch's number is not needed."""
        self.merge(batch)

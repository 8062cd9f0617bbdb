"""Progress metrics of streaming queries as DataFrames.

A listener writes each micro-batch's record to a table in shared storage, so
none is lost however long a query runs (``recentProgress`` holds the last
hundred only).  Its counts are measured on the way, as the queries run: the rows
read and those set aside by ``Dataset.observe``, the late ones by the stateful
operators.  The aggregates are Spark aggregations over that table: batch
duration mean / min / max per query, the overall mean, and input rows per
second.  Small records are put together when the log is closed.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from matchstream.sinks import fs

PROGRESS_SCHEMA = (
    "run string, moment string, query string, batch_id long, input_rows long, quarantined long, late_rows long, duration_ms long"
)
#: From so many records on they are put together in one file.
COMPACT_FROM = 50


def _record(p) -> dict:
    """The record of a micro-batch.

    Input rows are those that an observed metric counted, else the rows that the
    sources report.
    """
    observed = {k: v for row in (p.observedMetrics or {}).values() for k, v in row.asDict().items()}
    return {
        "run": str(p.runId),
        # A trigger without data reports the same batch again: the time tells them apart.
        "moment": "".join(c for c in p.timestamp if c.isdigit()),
        "query": p.name or str(p.id),
        "batch_id": int(p.batchId),
        "input_rows": int(observed.get("input_rows", p.numInputRows) or 0),
        "quarantined": int(observed.get("quarantined", 0) or 0),
        "late_rows": sum(int(o.numRowsDroppedByWatermark) for o in p.stateOperators),
        "duration_ms": int((p.durationMs or {}).get("triggerExecution", 0)),
    }


class ProgressLog(StreamingQueryListener):
    """Writes a record for each micro-batch of the session's queries under ``path``.

    One small file a record, named by run and batch: ``progress-<run>-<batch>``.
    Use it as a context manager; at its end it waits for the queries that have
    stopped to be recorded in full, and puts the small files together.
    """

    def __init__(self, spark: SparkSession, path: str, patience_s: float = 600) -> None:
        self.spark, self.path, self.patience_s = spark, path.rstrip("/"), patience_s
        self.ended = threading.Condition()
        self.open: set[str] = set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind, *_) -> None:
        running = {str(q.runId) for q in self.spark.streams.active}
        with self.ended:  # events come in order, a run's end last
            whole = self.ended.wait_for(lambda: self.open <= running, timeout=self.patience_s)
        self.spark.streams.removeListener(self)
        if kind is None and not whole:
            raise TimeoutError(f"records of {len(self.open - running)} stopped queries are missing after {self.patience_s} s")
        if kind is None and len(self._names("progress-")) >= COMPACT_FROM:
            self.compact()

    def onQueryStarted(self, event) -> None:
        with self.ended:
            self.open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        record = _record(event.progress)
        name = f"progress-{record['run']}-{record['batch_id']}-{record['moment']}.json"
        fs.write_new_text(self.spark, f"{self.path}/{name}", json.dumps(record))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.open.discard(str(event.runId))
            self.ended.notify_all()

    def _names(self, prefix: str) -> list[str]:
        return [n for n in fs.list_names(self.spark, self.path) if n.startswith(prefix)]

    def _rows(self, records: list[str], whole: list[str]) -> DataFrame:
        rows = self.spark.createDataFrame([], PROGRESS_SCHEMA)
        if records:
            rows = rows.unionByName(self.spark.read.schema(PROGRESS_SCHEMA).json([f"{self.path}/{n}" for n in records]))
        if whole:
            rows = rows.unionByName(self.spark.read.schema(PROGRESS_SCHEMA).parquet(*[f"{self.path}/{n}" for n in whole]))
        # A crash within compact() may leave a record in both forms.
        return rows.dropDuplicates(["run", "moment", "batch_id"])

    def _stored(self) -> tuple[list[str], list[str]]:
        whole = [n for n in self._names("records-") if fs.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return self._names("progress-"), whole

    def compact(self) -> None:
        """Put all records so far in one file; the small ones go once it is complete."""
        records, whole = self._stored()
        if not records:
            return
        self._rows(records, whole).coalesce(1).write.parquet(f"{self.path}/records-{uuid.uuid4().hex}")
        for name in [*records, *whole]:
            fs.delete_tree(self.spark, f"{self.path}/{name}")

    def rows(self) -> DataFrame:
        """All records so far."""
        return self._rows(*self._stored())


def progress_summary(progress: DataFrame) -> DataFrame:
    """Per query and overall (``query = 'all'``): batches, seconds, rows/s."""
    secs = F.col("duration_ms") / F.lit(1000.0)
    rolled = progress.rollup("query").agg(
        F.count(F.lit(1)).alias("batches"),
        F.avg(secs).alias("mean_batch_s"),
        F.min(secs).alias("min_batch_s"),
        F.max(secs).alias("max_batch_s"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("quarantined").alias("quarantined"),
        F.sum("late_rows").alias("late_rows"),
        (F.sum("input_rows") / F.greatest(F.sum(secs), F.lit(1e-9))).alias("rows_per_s"),
        F.grouping_id().alias("_g"),
    )
    return rolled.select(
        F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("query")).alias("query"),
        "batches",
        "mean_batch_s",
        "min_batch_s",
        "max_batch_s",
        "input_rows",
        "quarantined",
        "late_rows",
        "rows_per_s",
    )

"""Run streaming metrics into result tables.

Every query has a checkpoint (offsets + state) in the shared work folder and
writes through ``foreachBatch`` into a table that takes upserts, so a restart on the
same checkpoint resumes exactly where it stopped and a replayed micro-batch
leaves the same rows.  Several queries can run side by side in one session.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


class ResultTable(Protocol):
    """What a query writes to: a keyed file table, a database table or both goal tables."""

    def write_batch(self, batch: DataFrame, batch_id: int) -> None: ...


def start_to_table(
    stream: DataFrame,
    table: ResultTable,
    checkpoint: str,
    output_mode: str = "update",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start ``stream`` writing into ``table``; ``transform`` runs per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(transform(batch) if transform else batch, batch_id)

    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def run_available(
    stream: DataFrame,
    table: ResultTable,
    checkpoint: str,
    output_mode: str = "update",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Process everything available now, then stop; raise if the query failed.

    There is no time limit unless one is given.
    """
    query = start_to_table(stream, table, checkpoint, output_mode, transform)
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query

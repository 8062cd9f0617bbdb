"""Kafka source and sink (needs the spark-sql-kafka connector on the classpath).

Events travel as one JSON object per message value.  The connector is not
bundled with plain PySpark; these helpers only build the reader / writer and
fail at ``load()`` / ``start()`` when it is missing.  Tests drive the same
parse and routing code from file sources instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of raw messages (``key``, ``value`` binary, ...).

    ``startingOffsets`` is explicit (earliest by default); the checkpoint of
    the query that consumes this stream replaces a consumer group's offsets.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def write_kafka(routed: DataFrame, bootstrap_servers: str) -> None:
    """Batch-publish ``(topic, value)`` rows produced by the router."""
    (
        routed.select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .save()
    )

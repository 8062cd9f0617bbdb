"""Topic-fed streaming pipeline: messages are parsed once, then one query per metric family.

Events are fanned out to topics by the router.  The first query reads all topics,
parses each message once and appends it to ``out_dir/events``, a folder for each
topic and one for messages that can't be used (the quarantine); Spark's file sink
commits both outputs of a micro-batch together.  Each family's query reads the
typed events of its topic, runs the streaming metric and upserts a keyed result
table:

    team_stats_1min    -> foul_stats                (update, 1-min tumbling)
    live_card          -> yellow_card_stats          (update, 5/1-min sliding, both flags
                                                   recomputed per touched team and window)
    live_card          -> yellow_momentum_stats      (append: closed windows only)
    player_performance -> player_performance_stats   (update, running totals)
    live_score         -> goals                      (update, first goal of each time
                                                   and sums of each day)

Topics are read from the file replay's folder, by its commit log if a router
stream wrote it, or from Kafka when ``kafka_servers`` is given.  All queries run
concurrently in one session; each has its own checkpoint under
``out_dir/_checkpoints``.  The result tables are keyed file tables, or tables of
a database when ``jdbc`` is given.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchstream.functions.parse import decode_json_events
from matchstream.operators.routing import route_topics
from matchstream.schema import (
    CARD_GROUPS,
    CARD_KEYS,
    FOUL_KEYS,
    GOAL_FIRST_KEYS,
    PLAYER_KEYS,
    TEAM_MOMENTUM_MAX_CARDS,
    TOPIC_LIVE_CARD,
    TOPIC_LIVE_SCORE,
    TOPIC_PLAYER_PERFORMANCE,
    TOPIC_TEAM_STATS,
)
from matchstream.sinks import fs
from matchstream.sinks.jdbc_merge import GroupFlag, JdbcKeyedTable
from matchstream.sinks.keyed_table import KeyedTable
from matchstream.sources.kafka import read_kafka_stream
from matchstream.streaming.goals import GoalTables
from matchstream.streaming.queries import (
    closed_yellow_cards_stream,
    fouls_stream,
    goal_firsts_stream,
    momentum_batch,
    open_windows,
    player_stats_stream,
    player_table_rows,
    yellow_cards_stream,
)
from matchstream.streaming.runner import start_to_table

TOPICS = (TOPIC_TEAM_STATS, TOPIC_LIVE_CARD, TOPIC_PLAYER_PERFORMANCE, TOPIC_LIVE_SCORE)
#: The folder of messages that can't be used.
QUARANTINE = "quarantine"

_EVENT = (
    "value string, event_id long, event_timestamp timestamp_ntz, event_type string, team string, player string, "
    "shots_taken int, goals_scored int, reason string, part string"
)


def topic_messages(
    spark: SparkSession,
    topics: Sequence[str],
    topics_dir: str | None = None,
    kafka_servers: str | None = None,
    max_files_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Raw messages (``topic, value``) of some topics.

    The files of all topics are read from their common folder, so that the log
    of a router stream tells which files are committed, and filtered on the
    partition column; a topic without any message yet is simply empty.
    """
    if kafka_servers:
        stream = read_kafka_stream(spark, kafka_servers, ",".join(topics), starting_offsets, max_offsets_per_trigger)
        return stream.select("topic", "value")
    fs.make_directory(spark, topics_dir)
    reader = spark.readStream.schema("value string, topic string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(topics_dir).where(F.col("topic").isin(*topics)).select("topic", "value")


class ParsedEvents:
    """The typed events of all topics and the messages that can't be used, under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def parsed(self, messages: DataFrame) -> DataFrame:
        """What is stored of ``topic, value`` messages; counted on the way as metric ``parsed``."""
        rows = decode_json_events(messages, "value", with_event_id=True, ntz=True, keep=("topic",))
        bad = F.col("reason").isNotNull()
        rows = rows.withColumn("part", F.when(bad, F.lit(QUARANTINE)).otherwise(F.col("topic")))
        rows = rows.withColumn("value", F.when(bad, F.col("value")))
        names = [f.split(" ")[0] for f in _EVENT.split(", ")]
        return rows.select(*names).observe(
            "parsed", F.count(F.lit(1)).alias("input_rows"), F.count_if(bad).alias("quarantined")
        )

    def start(self, messages: DataFrame, checkpoint: str, trigger: dict, query_name: str) -> StreamingQuery:
        """Parse and store ``topic, value`` messages: one micro-batch, both outputs."""
        writer = self.parsed(messages).writeStream.format("parquet").partitionBy("part")
        writer = writer.option("path", self.path).option("checkpointLocation", checkpoint)
        return writer.queryName(query_name).trigger(**trigger).start()

    def events(self, topic: str) -> DataFrame:
        """The stream of a topic's typed events; counted on the way as metric ``read``."""
        fs.make_directory(self.spark, self.path)
        rows = self.spark.readStream.schema(_EVENT).parquet(self.path).where(F.col("part") == topic)
        return rows.drop("value", "reason", "part").observe("read", F.count(F.lit(1)).alias("input_rows"))

    def quarantine(self) -> DataFrame:
        """``value, reason`` of the messages that can't be used."""
        if not any(n.startswith("part=") for n in fs.list_names(self.spark, self.path)):
            return self.spark.createDataFrame([], "value string, reason string")
        rows = self.spark.read.schema(_EVENT).parquet(self.path)
        return rows.where(F.col("part") == QUARANTINE).select("value", "reason")


def start_router_stream(
    events: DataFrame,
    checkpoint: str,
    topics_dir: str | None = None,
    kafka_servers: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Route a stream of typed events to topic folders (or Kafka topics).

    A stateless, narrow query (append mode): each micro-batch's rows go
    straight from the tasks to ``topic=<name>`` folders or to Kafka.
    """
    routed = route_topics(events, with_event_id=True).select("topic", "value")
    writer = routed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if kafka_servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
    else:
        writer = writer.format("parquet").option("path", topics_dir).partitionBy("topic")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def by_window(bucket: str = "day"):
    """One partition for each day or hour of windows.

    A merge rewrites the partitions that its batch touches: days suit backfills
    (few folders), hours a live stream, whose batches touch the last windows only.
    """
    fmt = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}[bucket]
    return (f"window_{bucket}", F.date_format("window_start", fmt))


#: Partitions of tables whose keys have no time.
KEY_BUCKETS = 64


def by_key(keys: Sequence[str]):
    """Partitions by hash of the key, so that a merge rewrites what it touches only."""
    return ("key_bucket", F.format_string("%03d", F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")))


ResultTables = KeyedTable | JdbcKeyedTable | GoalTables | ParsedEvents


def start_match_streams(
    spark: SparkSession,
    out_dir: str,
    topics_dir: str | None = None,
    kafka_servers: str | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    jdbc: Callable[..., JdbcKeyedTable] | None = None,
    bucket: str = "day",
) -> dict[str, tuple[StreamingQuery, ResultTables]]:
    """Start the parsing and every family's query; returns name -> (query, result table).

    ``jdbc(name, keys, flag=None)`` makes the database table of a name and keys;
    without it the results are keyed file tables, with partitions by ``bucket``
    ("day" or "hour") of their windows.  With an ``availableNow`` trigger, the
    default, the messages are parsed first and the families then find all of
    them; else all run side by side.  If one query can't start, those that did are
    stopped.
    """
    started: dict[str, tuple[StreamingQuery, ResultTables]] = {}
    trigger = trigger or {"availableNow": True}
    out = out_dir.rstrip("/")
    messages = topic_messages(
        spark, TOPICS, topics_dir, kafka_servers, max_files_per_trigger, starting_offsets, max_offsets_per_trigger
    )
    parsed = ParsedEvents(spark, f"{out}/events")
    try:
        started["parsed"] = (parsed.start(messages, _checkpoint(out, "parsed"), trigger, "parsed"), parsed)
        if "availableNow" in trigger:
            await_all(started)
        _start_families(started, spark, out, trigger, jdbc, bucket, parsed)
    except BaseException:
        for query, _ in started.values():
            query.stop()
        raise
    return started


def _checkpoint(out: str, name: str) -> str:
    return f"{out}/_checkpoints/{name}"


def _start_families(started, spark, out, trigger, jdbc, bucket, parsed: ParsedEvents) -> None:
    def table(name: str, keys, part=None) -> KeyedTable | JdbcKeyedTable:
        return jdbc(name, keys) if jdbc else KeyedTable(spark, f"{out}/{name}", keys, part)

    def start(name: str, stream: DataFrame, target, mode: str, transform=None) -> None:
        query = start_to_table(stream, target, _checkpoint(out, name), mode, transform, trigger, name)
        started[name] = (query, target)

    start("foul_stats", fouls_stream(parsed.events(TOPIC_TEAM_STATS)), table("foul_stats", FOUL_KEYS, by_window(bucket)), "update")

    if jdbc:
        flag = GroupFlag(CARD_GROUPS, "team_momentum_lost", "yellow_cards", TEAM_MOMENTUM_MAX_CARDS)
        cards = jdbc("yellow_card_stats", CARD_KEYS, flag)
    else:
        cards = KeyedTable(spark, f"{out}/yellow_card_stats", CARD_KEYS, by_window(bucket), momentum_batch, CARD_GROUPS)
    start("yellow_card_stats", yellow_cards_stream(parsed.events(TOPIC_LIVE_CARD)), cards, "update")
    closed = table("yellow_momentum_stats", CARD_KEYS, by_window(bucket))
    stream = closed_yellow_cards_stream(parsed.events(TOPIC_LIVE_CARD))
    start("yellow_momentum_stats", stream, closed, "append", momentum_batch)

    players = table("player_performance_stats", PLAYER_KEYS, by_key(PLAYER_KEYS))
    stream = player_stats_stream(parsed.events(TOPIC_PLAYER_PERFORMANCE))
    start("player_performance_stats", stream, players, "update", player_table_rows)

    goals = jdbc("goal_firsts", GOAL_FIRST_KEYS) if jdbc else GoalTables(spark, f"{out}/goals", bucket)
    start("goals", goal_firsts_stream(parsed.events(TOPIC_LIVE_SCORE)), goals, "update")


def finish_match_streams(started: dict[str, tuple[StreamingQuery, ResultTables]], spark: SparkSession, out_dir: str) -> None:
    """Wait for bounded runs, then write the windows that their end left open.

    Append mode emits a window when the watermark passes its end, and the watermark
    stops with the input.  The rest is read from the stopped query's state.
    Should the input go on later, these windows are emitted again, with their
    final counts.
    """
    await_all(started)
    rest = open_windows(spark, _checkpoint(out_dir.rstrip("/"), "yellow_momentum_stats"))
    started["yellow_momentum_stats"][1].merge(momentum_batch(rest))


def await_all(started: dict[str, tuple[StreamingQuery, object]], timeout_s: float | None = None) -> None:
    """Wait for every query (availableNow runs end by themselves).

    All are watched at once: when one fails, the others are stopped and its
    error is raised.  There is no time limit unless one is given.
    """
    until = None if timeout_s is None else time.monotonic() + timeout_s
    running = dict(started)
    try:
        while running:
            for name, (query, _) in list(running.items()):
                if query.isActive and query.awaitTermination(0.2) is False:
                    continue
                if query.exception() is not None:
                    raise RuntimeError(f"{name}: {query.exception()}")
                del running[name]
            if running and until is not None and time.monotonic() > until:
                raise TimeoutError(f"{', '.join(running)} did not finish")
    except BaseException:
        for query, _ in running.values():
            query.stop()
        raise

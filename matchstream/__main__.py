"""Command line: ``python -m matchstream <command> ...``.

  load    CSV files -> ``match_events`` Parquet table (partitioned by date)
  batch   every metric over a Parquet table, a CSV path or a JDBC table
  route   events -> per-topic message folders (or Kafka)
  stream  topic folders (or Kafka) -> keyed result tables, one query per family
  serve   latest fouls / latest cards / top players / scoreboard from the tables
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

# String widths of the relational ``match_events`` table (fixed values).
MATCH_EVENTS_DDL = "event_type VARCHAR(50), team VARCHAR(100), player VARCHAR(100)"


def _session(args) -> SparkSession:
    from matchstream.session import build_session, cluster_conf

    conf = cluster_conf(args.total_cores) if args.total_cores else None
    return build_session(args.master, app_name=f"matchstream-{args.command}",
                         rocksdb_state=getattr(args, "rocksdb", False), extra_conf=conf)


class _Source:
    """The events of a command's source, and what a CSV source has of rows that can't be used."""

    def __init__(self, spark: SparkSession, args) -> None:
        from pyspark.sql import Observation

        from matchstream.sources.files import read_events_csv_checked
        from matchstream.sources.jdbc import read_jdbc

        self.quarantine, self.bad, self.counted = args.quarantine, None, None
        if args.csv:
            self.counted = Observation("csv")
            self.events, self.bad = read_events_csv_checked(spark, args.csv, counted=self.counted)
        elif args.jdbc_url:
            self.events = read_jdbc(
                spark, args.jdbc_url, args.jdbc_table, driver=args.jdbc_driver, user=args.jdbc_user, password=args.jdbc_password,
                partition_column=args.jdbc_partition_column or ("event_timestamp" if args.jdbc_partitions else None),
                lower_bound=args.jdbc_lower, upper_bound=args.jdbc_upper, num_partitions=args.jdbc_partitions,
            )
        else:
            self.events = spark.read.parquet(args.table)

    def report_bad(self) -> None:
        """Tell how many rows were left out, counted as the command ran, and keep them if asked to."""
        if self.counted is None:
            return
        rows, bad = (self.counted.get[k] for k in ("input_rows", "quarantined"))
        if bad and self.quarantine:
            self.bad.write.mode("overwrite").parquet(self.quarantine)
        place = f", kept in {self.quarantine}" if bad and self.quarantine else ""
        print(f"quarantined\t{bad} of {rows} rows{place}")


def cmd_load(spark, args) -> None:
    from pyspark.sql import Observation

    from matchstream.sinks.jdbc_merge import JdbcTable
    from matchstream.sources.files import append_match_events, read_events_csv_checked
    from matchstream.sources.jdbc import write_jdbc

    counted = Observation("csv")
    events, bad = read_events_csv_checked(spark, args.csv, counted=counted)
    if args.jdbc_url and args.load_id:
        table = JdbcTable(spark, args.jdbc_url, args.jdbc_table, args.jdbc_driver, args.jdbc_user, args.jdbc_password, MATCH_EVENTS_DDL)
        table.load(events, args.load_id)
    elif args.jdbc_url:
        write_jdbc(events, args.jdbc_url, args.jdbc_table, mode="append", driver=args.jdbc_driver,
                   user=args.jdbc_user, password=args.jdbc_password, column_types=MATCH_EVENTS_DDL)
    if args.table:
        append_match_events(events, args.table, load_id=args.load_id)
    if args.table or args.jdbc_url:
        print(f"quarantined\t{counted.get['quarantined']} of {counted.get['input_rows']} rows")
    if args.quarantine:
        bad.write.mode("overwrite").parquet(args.quarantine)


def cmd_batch(spark, args) -> None:
    from matchstream.plans.batch import run_match_report

    source = _Source(spark, args)
    # A database would be read once for each metric.
    paths = run_match_report(source.events, args.out, persist=args.persist or bool(args.jdbc_url),
                             foul_window=args.foul_window, card_window=args.card_window,
                             card_slide=args.card_slide)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    source.report_bad()


def cmd_route(spark, args) -> None:
    from matchstream.operators.routing import route_topics, write_routed_files
    from matchstream.sources.kafka import write_kafka

    source = _Source(spark, args)
    routed = route_topics(source.events, with_event_id=True)
    if args.kafka:
        write_kafka(routed, args.kafka)
    else:
        write_routed_files(routed, args.topics_dir)
    source.report_bad()


def cmd_stream(spark, args) -> None:
    from matchstream.streaming.pipeline import await_all, finish_match_streams, start_match_streams

    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.every}
    started = start_match_streams(spark, args.out, topics_dir=args.topics_dir,
                                  kafka_servers=args.kafka, trigger=trigger,
                                  max_files_per_trigger=args.max_files_per_trigger,
                                  starting_offsets=args.starting_offsets,
                                  max_offsets_per_trigger=args.max_offsets_per_trigger,
                                  jdbc=_jdbc_tables(spark, args) if args.jdbc_url else None,
                                  bucket=args.bucket)
    if args.available_now:
        finish_match_streams(started, spark, args.out)
    else:
        await_all(started)


def _jdbc_tables(spark: SparkSession, args):
    from matchstream.sinks.jdbc_merge import JdbcKeyedTable

    return lambda name, keys, flag=None: JdbcKeyedTable(
        spark, args.jdbc_url, name, keys, driver=args.jdbc_driver, user=args.jdbc_user,
        password=args.jdbc_password, query=name, connections=args.jdbc_connections, flag=flag,
        column_types=", ".join(f"{k} VARCHAR(100)" for k in keys if k in ("team", "player")) or None,
    )


def cmd_serve(spark, args) -> None:
    from pyspark.sql import functions as F

    from matchstream.functions.format import window_bound_text
    from matchstream.operators.serving import (
        latest_fouls,
        latest_yellow_cards,
        top_players,
    )
    from matchstream.schema import CARD_KEYS, FOUL_KEYS, PLAYER_KEYS
    from matchstream.sinks.keyed_table import KeyedTable
    from matchstream.streaming.goals import GoalTables
    from matchstream.streaming.pipeline import by_key, by_window

    def table(name, keys, part=None):
        return KeyedTable(spark, f"{args.out.rstrip('/')}/{name}", keys, part)

    def rows_or_none_yet(df, schema):
        return spark.createDataFrame([], schema) if df is None else df

    view = args.view
    if view == "scoreboard":
        df = GoalTables(spark, f"{args.out.rstrip('/')}/goals", args.bucket).board()
    elif view == "fouls":
        rows = table("foul_stats", FOUL_KEYS, by_window(args.bucket)).read_newest(args.n)
        df = latest_fouls(rows_or_none_yet(rows, "team string, fouls long, window_start timestamp, window_end timestamp"), args.n)
    elif view == "cards":
        rows = table("yellow_card_stats", CARD_KEYS, by_window(args.bucket)).read_newest(args.n)
        schema = "team string, player string, yellow_cards long, window_start timestamp, window_end timestamp, player_alert boolean"
        df = latest_yellow_cards(rows_or_none_yet(rows, schema), args.n)
    else:
        schema = "team string, player string, goals long, assists long, shots_taken long, scoring_percentage double"
        rows = rows_or_none_yet(table("player_performance_stats", PLAYER_KEYS, by_key(PLAYER_KEYS)).read(), schema)
        renamed = rows.select(
            "team", "player",
            F.col("goals").alias("total_goals_scored"),
            F.col("assists").alias("total_assists"),
            F.col("shots_taken").alias("total_shots_taken"),
            "scoring_percentage",
        )
        df = top_players(renamed, args.n)
    for name, kind in df.dtypes:
        if name.startswith("window_") and kind.startswith("timestamp"):
            df = df.withColumn(name, window_bound_text(name))
    # The latest and top views hold at most n rows; the scoreboard has no limit.
    df.show(max(args.n, df.count()) if view == "scoreboard" else args.n, truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="matchstream")
    p.add_argument("--master", default=None, help="Spark master (default: from the launcher)")
    p.add_argument("--total-cores", type=int, default=None, help="cores of the cluster: applies its sizes")
    sub = p.add_subparsers(dest="command", required=True)

    def source_args(sp):
        sp.add_argument("--table", help="match_events Parquet table")
        sp.add_argument("--csv", help="CSV file or folder")
        sp.add_argument("--jdbc-url")
        sp.add_argument("--jdbc-table", default="match_events")
        sp.add_argument("--jdbc-driver")
        sp.add_argument("--jdbc-user")
        sp.add_argument("--jdbc-password")
        sp.add_argument("--jdbc-partition-column", help="numeric or time column to split the read by")
        sp.add_argument("--jdbc-lower")
        sp.add_argument("--jdbc-upper")
        sp.add_argument("--jdbc-partitions", type=int, help="queries to read by; split by the data unless both bounds are given")
        sp.add_argument("--quarantine", help="folder for CSV rows with a bad time or number")

    sp = sub.add_parser("load")
    sp.add_argument("--quarantine", help="folder for rows with a bad time or number")
    sp.add_argument("--load-id", help="a retry with the same id replaces the earlier attempt's rows")
    sp.add_argument("--csv", required=True)
    sp.add_argument("--table", help="match_events Parquet table")
    sp.add_argument("--jdbc-url")
    sp.add_argument("--jdbc-table", default="match_events")
    sp.add_argument("--jdbc-driver")
    sp.add_argument("--jdbc-user")
    sp.add_argument("--jdbc-password")

    sp = sub.add_parser("batch")
    source_args(sp)
    sp.add_argument("--out", required=True)
    sp.add_argument("--persist", action="store_true", help="read the events once and keep them; always so for a database")
    sp.add_argument("--foul-window", default="1 minute")
    sp.add_argument("--card-window", default="5 minutes")
    sp.add_argument("--card-slide", default="1 minute")

    sp = sub.add_parser("route")
    source_args(sp)
    sp.add_argument("--topics-dir")
    sp.add_argument("--kafka")

    sp = sub.add_parser("stream")
    sp.add_argument("--out", required=True)
    sp.add_argument("--topics-dir")
    sp.add_argument("--kafka")
    sp.add_argument("--available-now", action="store_true")
    sp.add_argument("--every", default="5 seconds")
    sp.add_argument("--max-files-per-trigger", type=int, default=None)
    sp.add_argument("--rocksdb", action="store_true")
    sp.add_argument("--bucket", choices=["day", "hour"], default="day", help="partitions of the result tables")
    sp.add_argument("--starting-offsets", default="earliest")
    sp.add_argument("--max-offsets-per-trigger", type=int, default=None)
    sp.add_argument("--jdbc-url", help="write the result tables to a database")
    sp.add_argument("--jdbc-driver")
    sp.add_argument("--jdbc-user")
    sp.add_argument("--jdbc-password")
    sp.add_argument("--jdbc-connections", type=int, default=8)

    sp = sub.add_parser("serve")
    sp.add_argument("--out", required=True)
    sp.add_argument("--view", choices=["scoreboard", "fouls", "cards", "players"], default="scoreboard")
    sp.add_argument("-n", type=int, default=20)
    sp.add_argument("--bucket", choices=["day", "hour"], default="day", help="as the stream command's")
    return p


COMMANDS = {"load": cmd_load, "batch": cmd_batch, "route": cmd_route, "stream": cmd_stream, "serve": cmd_serve}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = _session(args)
    COMMANDS[args.command](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

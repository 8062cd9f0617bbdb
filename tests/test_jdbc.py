"""JDBC source/sink against an embedded, in-process Derby database (no server)."""

import os

import pytest
from pyspark.sql import functions as F

from matchstream.operators import fouls_tumbling
from matchstream.sinks.jdbc_merge import (
    GroupFlag,
    JdbcKeyedTable,
    JdbcTable,
    flag_statement,
    is_mysql,
    merge_statement,
    mysql_flag_statement,
    mysql_upsert_statement,
)
from matchstream.sources.jdbc import range_predicates, read_jdbc, write_jdbc
from matchstream.sources.testdata import load_match_events_from_testdata
from tests.conftest import SF001
from tests.plan_utils import plan_text

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture
def url(tmp_dir):
    return f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"


def test_merge_statement_shape():
    sql = merge_statement("t", "s", ["team"], ["team", "goals"])
    assert sql == (
        'MERGE INTO t t USING s s ON (t."team" = s."team" OR (t."team" IS NULL AND s."team" IS NULL)) WHEN MATCHED THEN UPDATE SET "goals" = s."goals"'
        ' WHEN NOT MATCHED THEN INSERT ("team", "goals") VALUES (s."team", s."goals")'
    )


def test_mysql_statement_shape():
    assert mysql_upsert_statement("t", "s", ["team"], ["team", "goals"]) == (
        "INSERT INTO t (`team`, `goals`) SELECT `team`, `goals` FROM s ON DUPLICATE KEY UPDATE `goals` = VALUES(`goals`)"
    )
    assert is_mysql("jdbc:mysql://h/db") and not is_mysql("jdbc:derby:db")


def test_null_keys_and_missing_target(spark, url):
    schema = "team string, window_start int, fouls long"
    table = JdbcKeyedTable(spark, url, "foul_stats", ["team", "window_start"], driver=DRIVER, column_types="team VARCHAR(100)")
    assert not table.exists()
    for n in (1, 2, 3):
        table.merge(spark.createDataFrame([("A", None, n), ("B", None, n), ("A", 1, n)], schema))
    assert table.exists()
    rows = {(r.team, r.window_start, r.fouls) for r in table.read().collect()}
    assert rows == {("A", None, 3), ("B", None, 3), ("A", 1, 3)} and table.read().count() == 3


def test_connection_errors_are_raised(spark):
    table = JdbcKeyedTable(spark, "jdbc:nonsense:x", "t", ["team"])
    with pytest.raises(Exception, match="driver|Driver"):
        table.merge(spark.createDataFrame([("A", 1)], "team string, n long"))


@pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data absent")
def test_partitioned_read_with_pushdown(spark, url):
    events = load_match_events_from_testdata(spark, SF001)
    write_jdbc(events.drop("event_timestamp").withColumn("ts_text", F.lit("x")), url, "match_events",
               driver=DRIVER, column_types="event_type VARCHAR(50), team VARCHAR(100), player VARCHAR(100)")
    df = read_jdbc(spark, url, "MATCH_EVENTS", driver=DRIVER, partition_column="event_id",
                   lower_bound=0, upper_bound=1000, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    fouls = df.where(F.col("event_type") == "foul").select("team")
    plan = plan_text(fouls)
    assert "EqualTo(event_type,foul)" in plan
    assert "ReadSchema: struct<team:string>" in plan
    assert fouls.count() == events.where("event_type = 'foul'").count()


@pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data absent")
def test_keyed_merge_is_idempotent(spark, url):
    fouls = fouls_tumbling(load_match_events_from_testdata(spark, SF001, ["foul"]))
    fouls = fouls.select("team", F.col("window_start").cast("timestamp").alias("window_start"),
                         "fouls", F.col("window_end").cast("timestamp").alias("window_end"))
    table = JdbcKeyedTable(spark, url, "foul_stats", ["team", "window_start"], driver=DRIVER,
                           column_types="team VARCHAR(100)")
    first, second = fouls.randomSplit([0.5, 0.5], seed=7)
    table.merge(first)
    table.merge(fouls)   # overlaps first: updates + inserts
    table.merge(fouls)   # replay: no change
    got = table.read()
    assert got.count() == fouls.count()
    cols = ["team", "window_start", "fouls"]
    assert got.select(*cols).exceptAll(fouls.select(*cols)).count() == 0


FLAG = GroupFlag(("team", "window_start"), "lost", "n", 3)


def test_flag_statements():
    assert flag_statement("t1", "s1", FLAG) == (
        'UPDATE t1 t SET "lost" = CASE WHEN (SELECT SUM(c."n") FROM t1 c WHERE (t."team" = c."team" OR (t."team" IS NULL AND c."team" IS NULL))'
        ' AND (t."window_start" = c."window_start" OR (t."window_start" IS NULL AND c."window_start" IS NULL))) > 3 THEN TRUE ELSE FALSE END'
        ' WHERE EXISTS (SELECT 1 FROM s1 s WHERE (t."team" = s."team" OR (t."team" IS NULL AND s."team" IS NULL))'
        ' AND (t."window_start" = s."window_start" OR (t."window_start" IS NULL AND s."window_start" IS NULL)))'
    )
    assert mysql_flag_statement("t1", "s1", FLAG) == (
        "UPDATE t1 t JOIN (SELECT c.`team`, c.`window_start`, SUM(c.`n`) AS group_total FROM t1 c"
        " JOIN (SELECT DISTINCT `team`, `window_start` FROM s1) s ON c.`team` <=> s.`team` AND c.`window_start` <=> s.`window_start`"
        " GROUP BY c.`team`, c.`window_start`) g ON t.`team` <=> g.`team` AND t.`window_start` <=> g.`window_start`"
        " SET t.`lost` = g.group_total > 3"
    )


def test_a_teammates_flag_flips(spark, url):
    table = JdbcKeyedTable(spark, url, "cards", ["team", "player", "window_start"], driver=DRIVER,
                           column_types="team VARCHAR(100), player VARCHAR(100)", flag=FLAG)
    schema = "team string, player string, window_start int, n long"

    def flags():
        return {(r.team, r.player, r.window_start): (r.n, r.lost) for r in table.read().collect()}

    table.merge(spark.createDataFrame([("A", "x", 1, 2), ("A", "y", 1, 1), ("A", "x", 2, 1), ("C", "q", None, 9), ("B", "w", 1, 3)], schema))
    assert flags() == {("A", "x", 1): (2, False), ("A", "y", 1): (1, False), ("A", "x", 2): (1, False), ("C", "q", None): (9, True), ("B", "w", 1): (3, False)}
    update = spark.createDataFrame([("A", "y", 1, 2), ("B", "z", 1, 1)], schema)
    for _ in range(2):  # and again, as a replay
        table.merge(update)
        got = flags()
        assert got[("A", "x", 1)] == (2, True) and got[("A", "y", 1)] == (2, True)  # x had no card of its own in this batch
        assert got[("B", "w", 1)] == (3, True) and got[("A", "x", 2)] == (1, False) and len(got) == 6


def test_a_failed_statement_changes_nothing(spark, url):
    table = JdbcKeyedTable(spark, url, "cards", ["team"], driver=DRIVER, column_types="team VARCHAR(100)",
                           flag=GroupFlag(("team",), "lost", "n", 3))
    table.merge(spark.createDataFrame([("A", 1)], "team string, n long"))
    broken = JdbcKeyedTable(spark, url, "cards", ["team"], driver=DRIVER, column_types="team VARCHAR(100)",
                            flag=GroupFlag(("nothing",), "lost", "n", 3))
    with pytest.raises(Exception, match="nothing"):
        broken.merge(spark.createDataFrame([("A", 5)], "team string, n long"))
    assert [(r.team, r.n, r.lost) for r in table.read().collect()] == [("A", 1, False)]


def test_qualified_names(spark, url):
    table = JdbcKeyedTable(spark, url, "app.goals", ["team"], driver=DRIVER, column_types="team VARCHAR(100)")
    assert not table.exists()
    for n in (1, 2):
        table.merge(spark.createDataFrame([("A", n)], "team string, n long"))
    assert table.exists() and [tuple(r) for r in table.read().collect()] == [("A", 2)]


def test_loading_twice_gives_the_rows_once(spark, url):
    table = JdbcTable(spark, url, "match_events", DRIVER, column_types="team VARCHAR(100)")
    schema = "team string, n long"
    table.load(spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], schema), "it's day/1")
    table.load(spark.createDataFrame([("C", 3)], schema), "day/2")
    table.load(spark.createDataFrame([("A", 1), ("A", 1), ("B", 7)], schema), "it's day/1")  # the retry
    got = sorted((r.team, r.n, r.load_id) for r in table.read().collect())
    assert got == [("A", 1, "it's day/1"), ("A", 1, "it's day/1"), ("B", 7, "it's day/1"), ("C", 3, "day/2")]


def test_load_into_a_table_of_plain_loads(spark, url):
    schema = "team string, n long"
    write_jdbc(spark.createDataFrame([("A", 1)], schema), url, "match_events", driver=DRIVER, column_types="team VARCHAR(100)")
    table = JdbcTable(spark, url, "match_events", DRIVER, column_types="team VARCHAR(100)")
    for _ in range(2):
        table.load(spark.createDataFrame([("B", 2)], schema), "l")
    assert sorted((r.team, r.load_id) for r in table.read().collect()) == [("A", None), ("B", "l")]


def _split_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("column", ["id", "at"])
def test_splits_follow_a_skewed_column(spark, url, column):
    """Nine rows in ten lie in a hundredth of the range."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, F.col("id")).otherwise(F.col("id") * 200).alias("id"), F.lit("x").alias("team"))
    rows = rows.withColumn("at", F.timestamp_seconds(F.col("id") + 1_700_000_000))
    write_jdbc(rows, url, "skewed", driver=DRIVER, column_types="team VARCHAR(10)")
    df = read_jdbc(spark, url, "skewed", driver=DRIVER, partition_column=column, num_partitions=8)
    sizes = _split_sizes(df)
    assert df.rdd.getNumPartitions() == 8 and sum(sizes) == 20_000
    assert max(sizes) <= 2 * 20_000 / 8
    even = read_jdbc(spark, url, "skewed", driver=DRIVER, partition_column="id", lower_bound=0, upper_bound=4_000_000, num_partitions=8)
    assert max(_split_sizes(even)) > 4 * 20_000 / 8


def test_splits_of_odd_tables(spark, url):
    schema = "k int, n long"
    for name, rows in (("empty", []), ("one_value", [(5, 1)] * 9), ("nulls", [(None, 1)] * 4 + [(i % 3, 2) for i in range(30)])):
        write_jdbc(spark.createDataFrame(rows, schema), url, name, driver=DRIVER)
        df = read_jdbc(spark, url, name, driver=DRIVER, partition_column="k", num_partitions=4)
        assert sorted(map(str, df.collect())) == sorted(map(str, spark.createDataFrame(rows, schema).collect()))
    assert range_predicates('"k"', []) == ["1 = 1"]
    with pytest.raises(ValueError, match="both bounds"):
        read_jdbc(spark, url, "nulls", driver=DRIVER, partition_column="k", lower_bound=1, num_partitions=2)

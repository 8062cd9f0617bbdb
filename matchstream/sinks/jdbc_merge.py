"""Keyed upsert into a relational table: distributed staging write + set-based statements.

Executors write the (key-unique) update rows into a staging table of the query
with the JDBC writer, in parallel batches over a bounded number of connections;
the driver then issues set-based statements in one transaction — control only,
no rows pass through the driver.  The upsert is ``MERGE`` with null-safe keys, or for
MySQL, which has no ``MERGE``, ``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE``;
there the target needs a unique key.  A flag over groups of rows is recomputed by
one ``UPDATE`` of the groups that were staged.  Values are absolute, so repeating a
micro-batch leaves the target unchanged.  The target is created empty, so that the
first load is merged like any other and can be repeated.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.sources.jdbc import write_jdbc


@dataclass(frozen=True)
class GroupFlag:
    """A boolean ``column``: whether the sum of ``total`` over the row's ``groups`` is above ``above``."""

    groups: Sequence[str]
    column: str
    total: str
    above: int


def _same(a: str, b: str, columns: Sequence[str], quote: str = '"') -> str:
    """Null-safe equality of some columns of two tables."""
    q = lambda t, c: f"{t}.{quote}{c}{quote}"
    return " AND ".join(f"({q(a, c)} = {q(b, c)} OR ({q(a, c)} IS NULL AND {q(b, c)} IS NULL))" for c in columns)


def merge_statement(
    target: str, staging: str, keys: Sequence[str], columns: Sequence[str], quote: str = '"'
) -> str:
    """ANSI ``MERGE`` (Derby, Oracle, SQL Server, PostgreSQL 15+, ...).

    Column names are quoted the way Spark's JDBC writer created them
    (``quote`` is the dialect's identifier quote).
    """
    q = lambda c: f"{quote}{c}{quote}"
    values = [c for c in columns if c not in keys]
    sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in values)
    cols = ", ".join(q(c) for c in columns)
    vals = ", ".join(f"s.{q(c)}" for c in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if values else ""
    return (
        f"MERGE INTO {target} t USING {staging} s ON {_same('t', 's', keys, quote)}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    )


def mysql_upsert_statement(target: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """MySQL's upsert of all staged rows; it goes by the target's unique key.

    MySQL takes NULLs in a unique key as different, so the key columns are
    written with :data:`MYSQL_NULL` in the place of NULL.
    """
    q = lambda c: f"`{c}`"
    cols = ", ".join(q(c) for c in columns)
    values = [c for c in columns if c not in keys] or [keys[0]]
    sets = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in values)
    return f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} ON DUPLICATE KEY UPDATE {sets}"


def flag_statement(target: str, staging: str, flag: GroupFlag, quote: str = '"') -> str:
    """Recompute a flag over the groups that are staged; all rows of such a group get it."""
    q = lambda c: f"{quote}{c}{quote}"
    total = f"SELECT SUM(c.{q(flag.total)}) FROM {target} c WHERE {_same('t', 'c', flag.groups, quote)}"
    return (
        f"UPDATE {target} t SET {q(flag.column)} = CASE WHEN ({total}) > {flag.above} THEN TRUE ELSE FALSE END"
        f" WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {_same('t', 's', flag.groups, quote)})"
    )


def mysql_flag_statement(target: str, staging: str, flag: GroupFlag) -> str:
    """The same for MySQL, which can't read the target of an update in a subquery but can join its totals."""
    cols = ", ".join(f"c.`{c}`" for c in flag.groups)
    staged = ", ".join(f"`{c}`" for c in flag.groups)
    same = lambda a, b: " AND ".join(f"{a}.`{c}` <=> {b}.`{c}`" for c in flag.groups)
    totals = (
        f"SELECT {cols}, SUM(c.`{flag.total}`) AS group_total FROM {target} c"
        f" JOIN (SELECT DISTINCT {staged} FROM {staging}) s ON {same('c', 's')} GROUP BY {cols}"
    )
    return f"UPDATE {target} t JOIN ({totals}) g ON {same('t', 'g')} SET t.`{flag.column}` = g.group_total > {flag.above}"


#: What stands for NULL in text keys of a MySQL table.
MYSQL_NULL = "\\N"


def is_mysql(url: str) -> bool:
    return url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))


class JdbcTable:
    """A database table; ``connections`` bounds the parallel writes."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str,
        driver: str | None = None,
        user: str | None = None,
        password: str | None = None,
        column_types: str | None = None,
        connections: int = 8,
    ) -> None:
        self.spark = spark
        self.url = url
        self.table = table
        self.mysql = is_mysql(url)
        self.quote = "`" if self.mysql else '"'
        self.driver = driver
        self.user = user
        self.password = password
        self.column_types = column_types
        self.connections = connections

    def _connect(self):
        jvm = self.spark.sparkContext._jvm
        if self.driver:
            jvm.java.lang.Class.forName(self.driver)
        if self.user is not None:
            return jvm.java.sql.DriverManager.getConnection(self.url, self.user, self.password)
        return jvm.java.sql.DriverManager.getConnection(self.url)

    def exists(self) -> bool:
        """Whether the table can be read by its name, qualified or not; errors of the connection are raised."""
        conn = self._connect()
        try:
            conn.createStatement().executeQuery(f"SELECT 1 FROM {self.table} WHERE 1 = 0")
            return True
        except Py4JJavaError:
            return False
        finally:
            conn.close()

    def transaction(self, *statements: str) -> None:
        """Run some statements; all of them count or none."""
        conn = self._connect()
        try:
            conn.setAutoCommit(False)
            for sql in statements:
                stmt = conn.createStatement()
                stmt.executeUpdate(sql)
                stmt.close()
            conn.commit()
        except BaseException:
            conn.rollback()
            raise
        finally:
            conn.close()

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        write_jdbc(
            df,
            self.url,
            table,
            mode=mode,
            driver=self.driver,
            user=self.user,
            password=self.password,
            column_types=self.column_types,
            num_partitions=self.connections,
        )

    def read(self) -> DataFrame:
        reader = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table)
        for key, value in (("driver", self.driver), ("user", self.user), ("password", self.password)):
            if value is not None:
                reader = reader.option(key, value)
        return reader.load()

    # ---- loads --------------------------------------------------------------
    def load(self, rows: DataFrame, load_id: str) -> None:
        """Append ``rows`` under the name of a load; a retry with the same name replaces the earlier attempt.

        The rows are staged in a table of their own, then one transaction deletes
        what the table has of this load and inserts the staged rows.  The table gets
        a column ``load_id``; rows of earlier plain loads have NULL there.
        """
        staging = f"{self.table}_load_{re.sub('[^A-Za-z0-9]', '_', load_id)[:40]}"
        rows = rows.withColumn("load_id", F.lit(load_id))
        types = [self.column_types] if self.column_types else []
        own = JdbcTable(self.spark, self.url, self.table, self.driver, self.user, self.password,
                        ", ".join([*types, "load_id VARCHAR(200)"]), self.connections)
        q = lambda c: f"{self.quote}{c}{self.quote}"
        if not self.exists():
            own.write(self.spark.createDataFrame([], rows.schema), self.table, "append")
        elif "load_id" not in self.read().columns:
            self.transaction(f"ALTER TABLE {self.table} ADD COLUMN {q('load_id')} VARCHAR(200)")
        own.write(rows, staging, "overwrite")
        columns = ", ".join(q(c) for c in rows.columns)
        name = load_id.replace("'", "''")
        if self.mysql:
            name = name.replace("\\", "\\\\")
        self.transaction(
            f"DELETE FROM {self.table} WHERE {q('load_id')} = '{name}'",
            f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {staging}",
            f"DROP TABLE {staging}",
        )


class JdbcKeyedTable(JdbcTable):
    """A database table with a key, upserted from micro-batches.

    ``query`` names the writer: it is part of the staging table's name, so that
    two queries don't share one.  ``flag`` is a column over groups of rows, which
    each merge recomputes for the groups that it touches.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str,
        keys: Sequence[str],
        driver: str | None = None,
        user: str | None = None,
        password: str | None = None,
        column_types: str | None = None,
        query: str = "batch",
        connections: int = 8,
        flag: GroupFlag | None = None,
    ) -> None:
        super().__init__(spark, url, table, driver, user, password, column_types, connections)
        self.staging = f"{table}_staging_{query}"
        self.keys = list(keys)
        self.flag = flag

    def _text_keys(self, df: DataFrame) -> list[str]:
        return [f.name for f in df.schema.fields if f.name in self.keys and f.dataType.simpleString() == "string"]

    def read(self) -> DataFrame:
        rows = super().read()
        if not self.mysql:
            return rows
        return rows.replace(MYSQL_NULL, None, subset=self._text_keys(rows))

    def merge(self, update: DataFrame) -> None:
        """Stage ``update`` (overwrite) and merge it into the target."""
        if self.mysql and self._text_keys(update):
            update = update.fillna(MYSQL_NULL, subset=self._text_keys(update))
        if not self.exists():
            empty = self.spark.createDataFrame([], update.schema)
            if self.flag:  # rows are inserted without it and get it in the same transaction
                empty = empty.withColumn(self.flag.column, F.lit(None).cast("boolean"))
            self.write(empty, self.table, "append")
            if self.mysql:
                self.transaction(f"ALTER TABLE {self.table} ADD UNIQUE KEY ({', '.join(f'`{k}`' for k in self.keys)})")
        self.write(update, self.staging, "overwrite")
        upsert, reflag = (mysql_upsert_statement, mysql_flag_statement) if self.mysql else (merge_statement, flag_statement)
        statements = [upsert(self.table, self.staging, self.keys, update.columns)]
        if self.flag:
            statements.append(reflag(self.table, self.staging, self.flag))
        self.transaction(*statements)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``; merges are idempotent, so the batch's number is not needed."""
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                self.merge(batch)
        finally:
            batch.unpersist()

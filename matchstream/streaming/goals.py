"""The streamed scoreboard: first goals by time, and the goals of each day and team.

The first goal of each time is kept for ever, so that none counts twice however
late it comes.  Reading the board does not open them: each merge also writes the
sums of the days (or hours) that it touched, and the board adds up those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.operators.serving import scoreboard_readout
from matchstream.schema import GOAL_FIRST_KEYS
from matchstream.sinks.keyed_table import KeyedTable
from matchstream.streaming.queries import goal_firsts_partition


class GoalTables:
    def __init__(self, spark: SparkSession, path: str, granularity: str = "day") -> None:
        self.spark = spark
        part, expression = goal_firsts_partition(granularity)
        self.firsts = KeyedTable(spark, f"{path.rstrip('/')}/firsts", GOAL_FIRST_KEYS, (part, expression))
        self.totals = KeyedTable(spark, f"{path.rstrip('/')}/totals", ["team"], (part, F.col(part)))
        self.part = (part, expression)

    def merge(self, update: DataFrame) -> None:
        """Upsert first goals, then sum up the touched days anew.

        A crash between the two is made good by the replay of the batch, which
        touches the same days.
        """
        touched = self.firsts.merge(update)
        if touched:
            name, expression = self.part
            rows = self.firsts.read(touched).groupBy(expression.alias(name), "team")
            self.totals.overwrite(rows.agg(F.sum("goals").alias("goals")))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        self.merge(batch)

    def read(self) -> DataFrame | None:
        """The first goals; None if there are none yet."""
        return self.firsts.read()

    def board(self) -> DataFrame:
        """``team, goals`` (known teams zero-filled), from the sums of the days."""
        return scoreboard_readout(self.totals.read(), self.spark)

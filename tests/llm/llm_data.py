"""Schema and prose for the tests of the text operators."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)

SF = "/root/testdata/sf0.001"


def words(n: int, seed: int) -> str:
    """Prose of n words from a small vocabulary."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeinrstlo") for _ in range(draw.randint(2, 9))) for _ in range(n))

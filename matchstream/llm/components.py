"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstream.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _mark(links: DataFrame) -> tuple:
    """Count and digest of a link table, to see that nothing changes any more."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node of ``links``; the component is its smallest node.

    Alternates the large-star and small-star steps: each links the neighbours
    of a node to the smallest of them, which takes a number of rounds that is
    logarithmic in practice.  Each round is written to the shared folder.  Nodes
    are long integers; links with a null or to itself are ignored.
    """
    links = links.where(f"{a} != {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = stored(links, "links")
    before = _mark(links)
    while before[0]:
        both = _both_ways(links)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        links = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component")).distinct()

"""URL filters: rules first, then trust and distrust over the graph of links.

Hosts are nodes, links between pages of different hosts are edges.  Trust is a
PageRank whose walks restart at hosts with pages that a rule allows; distrust is
one over reversed edges that restarts at hosts with pages that a rule blocks, so
that a host is distrusted for linking to distrusted ones.  A host is blocked
when its distrust exceeds its trust by the threshold's factor.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstream.llm.common import prepare, stored, table

#: (verdict, host, path) of the rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Share of the rank that follows the links; the rest restarts at the seeds.
DAMPING = 0.85
#: The walk ends when the ranks move by less than this in sum.  A step moves
#: them by at most the damping times the step before, so it does end.
TOLERANCE = 1e-4
#: A host is blocked when distrust > FACTOR * trust.
FACTOR = 1.0

_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:https?:)?//([^/"'?#\s<>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fitting(rules: list[tuple[str, str, str]], value) -> Column:
    """``value(rule)`` of the longest rule that fits ``host`` and ``path``, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, value(rule)).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: how many pages' links lead from one host to another.

    Only absolute links say which host they lead to, by the rule of ``host_of``, port
    and user name included; links within a host, and pages without a host, add nothing.
    """
    found = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))))
    links = pages.select(F.col("host").alias("src"), found.alias("dst"))
    links = links.select("src", _ascii_lower(F.rtrim(F.col("dst"))).alias("dst")).where("src != '' and dst != '' and src != dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("links"))


def personalised_rank(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, rank`` of walks over ``src, dst, links`` that restart at ``seeds`` (host, weight).

    Hosts that no walk reaches have no row.  A walk that meets a host without
    links restarts.  Each step is written to the shared folder.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    schema = "host string, rank double"
    if not total:
        return seeds.sparkSession.createDataFrame([], schema)
    restart = stored(seeds.select("host", (F.col("weight") / F.lit(float(total))).alias("restart")), "seeds")
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    steps = stored(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("out")).alias("share")), "steps")
    rank = restart.select("host", F.col("restart").alias("rank"))
    if steps.isEmpty():
        return rank
    while True:
        moved = rank.join(steps, rank["host"] == steps["src"]).groupBy(F.col("dst").alias("host"))
        moved = moved.agg(F.sum(F.col("rank") * F.col("share")).alias("inflow"))
        followed = moved.agg(F.sum("inflow")).first()[0] or 0.0
        back = 1.0 - DAMPING * followed
        new = moved.join(restart, "host", "full").select(
            "host",
            (F.coalesce("inflow", F.lit(0.0)) * DAMPING + F.coalesce("restart", F.lit(0.0)) * back).alias("rank"),
        )
        new = stored(new, "rank")
        before = rank.select("host", F.col("rank").alias("before"))
        change = new.join(before, "host", "full").agg(
            F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("before", F.lit(0.0))))
        )
        rank = new
        if (change.first()[0] or 0.0) < TOLERANCE:
            return rank


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without its html, with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``.

    The verdict is that of the longest rule that fits; else ``block`` for hosts
    whose distrust exceeds ``FACTOR`` times their trust, and ``allow`` for all
    others, among them hosts without links and urls that are null or have no
    ``://``.  Columns of ``pages`` that have one of the new names are replaced.
    """
    spark = pages.sparkSession
    prepare(spark)
    new = ["host", "path", "rule", "verdict", "trust", "distrust"]
    others = [c for c in pages.columns if c not in [*new, html]]
    placed = pages.select(*others, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    placed = placed.select(
        *others, "host", "path",
        _fitting(rules, lambda r: F.lit(r[1] + r[2])).alias("rule"),
        _fitting(rules, lambda r: F.lit(r[0])).alias("ruled"),
    )
    edges = stored(host_edges(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))), "host-edges")
    hosts = stored(
        placed.where("host != ''").groupBy("host").agg(F.count_if(F.expr("ruled = 'allow'")).alias("allowed"), F.count_if(F.expr("ruled = 'block'")).alias("blocked")),
        "hosts",
    )
    trust = personalised_rank(edges, hosts.where("allowed > 0").select("host", F.col("allowed").alias("weight")))
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = personalised_rank(reverse, hosts.where("blocked > 0").select("host", F.col("blocked").alias("weight")))
    ranks = trust.select("host", F.col("rank").alias("trust")).join(distrust.select("host", F.col("rank").alias("distrust")), "host", "full")
    judged = placed.join(ranks, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_graph = F.when(distrust > FACTOR * trust, "block").otherwise("allow")
    return judged.select(
        *others, "host", "path", "rule", F.coalesce("ruled", by_graph).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")

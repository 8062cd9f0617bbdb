"""Event-time window counts (tumbling and sliding).

Sliding windows: Spark's ``window(ts, duration, slide)`` replicates every input
row ``duration / slide`` times *before* the partial aggregation, so the map
side hashes n× the rows and shuffles up to n× the partial groups.  When the
slide divides the duration the same answer comes from *panes*: count each row
once into its slide-wide tumbling pane (partial aggregation collapses the raw
rows before the first shuffle), then fan each pane out to the n windows that
contain it and add.  The fan-out touches aggregated panes only, so its cost is
bounded by the number of distinct (pane, key) groups, not by the input size.

Windows are half-open ``[start, end)``, aligned to the epoch; rows with a NULL
event time belong to no window.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """``"5 minutes"`` -> 300000000 (fixed-length units only, as windows need)."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not an interval: {text!r}")
    for number, unit in parts:
        unit = unit.lower().rstrip("s")
        if unit not in _UNIT_MICROS:
            raise ValueError(f"unsupported interval unit in {text!r}")
        total += int(number) * _UNIT_MICROS[unit]
    return total


def _flatten(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.select(
        *keys,
        F.col(name),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def tumbling_counts(
    df: DataFrame, time_col: str, duration: str, keys: Sequence[str], name: str
) -> DataFrame:
    """Rows per (tumbling window, keys): ``keys..., name, window_start, window_end``."""
    grouped = df.groupBy(F.window(time_col, duration).alias("window"), *keys)
    return _flatten(grouped.agg(F.count(F.lit(1)).alias(name)), keys, name)


def _shift(ts: Column, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, ts)


def sliding_counts(
    df: DataFrame,
    time_col: str,
    duration: str,
    slide: str,
    keys: Sequence[str],
    name: str,
    strategy: str = "auto",
    cluster_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows per (sliding window, keys): ``keys..., name, window_start, window_end``.

    ``strategy``: ``"native"`` uses ``window(ts, duration, slide)``;
    ``"panes"`` pre-aggregates slide-wide panes (needs slide | duration);
    ``"auto"`` picks panes wherever they apply.  ``cluster_by`` (panes only) names
    columns among ``["window_start", *keys]`` to hash-partition the fanned-out
    panes by, so that a following per-window computation on those columns
    reuses the partitioning instead of shuffling again.
    """
    d, s = interval_micros(duration), interval_micros(slide)
    if strategy == "auto" and d % s == 0 and d > s:
        strategy = "panes"
    use_panes = strategy == "panes"
    if use_panes and d % s != 0:
        raise ValueError("pane strategy needs the slide to divide the duration")
    if not use_panes:
        grouped = df.groupBy(F.window(time_col, duration, slide).alias("window"), *keys)
        return _flatten(grouped.agg(F.count(F.lit(1)).alias(name)), keys, name)

    n = d // s
    panes = df.groupBy(F.window(time_col, slide).start.alias("pane_start"), *keys).agg(
        F.count(F.lit(1)).alias("_pane_rows")
    )
    fanned = panes.select(
        *keys, "_pane_rows", "pane_start", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i")
    ).select(
        *keys,
        "_pane_rows",
        _shift(F.col("pane_start"), F.col("_i").cast("bigint") * F.lit(-s)).alias("window_start"),
    )
    if cluster_by:
        fanned = fanned.repartition(*cluster_by)
    counted = fanned.groupBy("window_start", *keys).agg(F.sum("_pane_rows").alias(name))
    return counted.select(
        *keys,
        F.col(name),
        F.col("window_start"),
        _shift(F.col("window_start"), F.lit(d)).alias("window_end"),
    )

"""Combined batch run: every metric family over one event table.

Each metric states its own event-type filter and columns, so on a Parquet
table each one reads only its slice (pushed filter + pruned columns).
``persist=True`` instead materialises the input once and feeds every metric
from executor storage; that pays off only for sources without pushdown (a
JDBC table) and for inputs that fit the executors' memory and disk — at
scale the pushed-down scans are cheaper than caching the whole input.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchstream.operators import (
    family_counts,
    fouls_tumbling,
    leaderboard,
    player_totals,
    scoreboard,
    yellow_momentum,
)
from matchstream.schema import CARD_SLIDE, CARD_WINDOW, FOUL_WINDOW


PROGRESS = "family string, input_rows long, output_rows long, seconds double, events_per_s double"


def match_report(
    events: DataFrame,
    foul_window: str = FOUL_WINDOW,
    card_window: str = CARD_WINDOW,
    card_slide: str = CARD_SLIDE,
) -> dict[str, DataFrame]:
    return {
        "family_counts": family_counts(events),
        "yellow_card_stats": yellow_momentum(events, card_window, card_slide).orderBy("window_start", "team", "player"),
        "player_performance_stats": leaderboard(player_totals(events, performance_only=True)),
        "foul_stats": fouls_tumbling(events, foul_window),
        "scoreboard": scoreboard(events),
    }


def run_match_report(
    events: DataFrame, out_dir: str, persist: bool = False, **windows: str
) -> dict[str, str]:
    """Write every metric of :func:`match_report` under ``out_dir``; return the paths.

    ``report_progress`` holds, for each family, the events of the input, the rows
    written, the seconds taken and input events per second.  The counts are
    measured as the metrics are written, without jobs of their own.
    """
    source = events.persist(StorageLevel.MEMORY_AND_DISK) if persist else events
    paths, written = {}, []
    read = Observation("events")
    try:
        metrics = match_report(source, **windows)
        # The summary reads every event; the other metrics skip what they don't need.
        metrics["family_counts"] = family_counts(source.observe(read, F.count(F.lit(1)).alias("rows")))
        for name, df in metrics.items():
            path, rows, start = f"{out_dir.rstrip('/')}/{name}", Observation(name), time.perf_counter()
            df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            written.append((name, rows.get["rows"], time.perf_counter() - start))
            paths[name] = path
    finally:
        if persist:
            source.unpersist()
    total = read.get["rows"]
    progress = [(name, total, rows, seconds, total / max(seconds, 1e-9)) for name, rows, seconds in written]
    paths["report_progress"] = f"{out_dir.rstrip('/')}/report_progress"
    progress = events.sparkSession.createDataFrame(progress, PROGRESS)
    progress.coalesce(1).write.mode("overwrite").parquet(paths["report_progress"])
    return paths


def register_views(spark: SparkSession, events: DataFrame, prefix: str = "") -> None:
    """Expose the event table and the per-player card windows to SQL."""
    events.createOrReplaceTempView(f"{prefix}match_events")
    from matchstream.operators.cards import yellow_cards_sliding

    yellow_cards_sliding(events).createOrReplaceTempView(f"{prefix}yellow_stats")

"""Yellow-card metrics: sliding-window counts with player and team flags.

``player_alert``: the player's count in the window is >= 2.
``team_momentum_lost``: the team's total over the window is > 3; every player
row of that team and window carries it.  The team total is a windowed
``sum`` over the (team, window) partition of the already aggregated player
rows, so there is no second scan and no join; the join form is kept as a
cross-check (:func:`with_team_momentum_join`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstream.operators.windows import sliding_counts
from matchstream.schema import (
    CARD_SLIDE,
    CARD_WINDOW,
    PLAYER_ALERT_MIN_CARDS,
    TEAM_MOMENTUM_MAX_CARDS,
)

CARD_COLUMNS = ["team", "player", "yellow_cards", "window_start", "window_end", "player_alert"]


def card_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "yellow_card")


def player_alert(count_col: str = "yellow_cards"):
    return F.col(count_col) >= F.lit(PLAYER_ALERT_MIN_CARDS)


def yellow_cards_sliding(
    events: DataFrame,
    duration: str = CARD_WINDOW,
    slide: str = CARD_SLIDE,
    strategy: str = "auto",
    cluster_by_team_window: bool = False,
) -> DataFrame:
    """``team, player, yellow_cards, window_start, window_end, player_alert``."""
    counts = sliding_counts(
        card_events(events),
        "event_timestamp",
        duration,
        slide,
        ["team", "player"],
        "yellow_cards",
        strategy=strategy,
        cluster_by=["team", "window_start"] if cluster_by_team_window else None,
    )
    return counts.withColumn("player_alert", player_alert()).select(*CARD_COLUMNS)


def with_team_momentum(cards: DataFrame) -> DataFrame:
    """Attach ``team_momentum_lost`` with a window sum over (team, window)."""
    team_window = Window.partitionBy("team", "window_start", "window_end")
    total = F.sum("yellow_cards").over(team_window)
    return cards.withColumn("team_momentum_lost", total > F.lit(TEAM_MOMENTUM_MAX_CARDS))


def with_team_momentum_join(cards: DataFrame) -> DataFrame:
    """Same as :func:`with_team_momentum`, as aggregate + left equi-join."""
    keys = ["team", "window_start", "window_end"]
    totals = cards.groupBy(*keys).agg(F.sum("yellow_cards").alias("_team_cards"))
    joined = cards.join(totals, on=keys, how="left")
    return joined.select(
        *CARD_COLUMNS, (F.col("_team_cards") > F.lit(TEAM_MOMENTUM_MAX_CARDS)).alias("team_momentum_lost")
    )


def yellow_momentum(
    events: DataFrame,
    duration: str = CARD_WINDOW,
    slide: str = CARD_SLIDE,
    strategy: str = "auto",
    method: str = "window",
) -> DataFrame:
    """Sliding counts with both flags.

    ``method="window"`` (default): with panes, the fanned-out panes are
    hash-partitioned by (team, window_start) once; the per-player count and
    the team-window sum both reuse that partitioning, so the whole metric
    costs two shuffles.  A (team, window) partition holds one pre-aggregated
    row per player of that team (times the panes per window), so its size is
    bounded by the roster, not by the number of events.

    ``method="join"``: team totals are aggregated separately and joined back.
    Use it when the "player" column has very high cardinality: AQE then
    broadcasts the totals when they are measured small, and otherwise splits
    a skewed (team, window) in the sort-merge join.
    """
    if method == "join":
        return with_team_momentum_join(yellow_cards_sliding(events, duration, slide, strategy=strategy))
    cards = yellow_cards_sliding(
        events, duration, slide, strategy=strategy, cluster_by_team_window=True
    )
    return with_team_momentum(cards)


def yellow_cards_by_team_player(events: DataFrame) -> DataFrame:
    """Card totals per player, per team and overall in one pass (ROLLUP).

    ``level`` tells the rows apart (``player`` / ``team`` / ``all``) so that a
    NULL team or player in the data is not mistaken for a subtotal.
    """
    rolled = card_events(events).rollup("team", "player").agg(
        F.count(F.lit(1)).alias("yellow_cards"),
        F.grouping_id().alias("_gid"),
    )
    level = (
        F.when(F.col("_gid") == 0, F.lit("player"))
        .when(F.col("_gid") == 1, F.lit("team"))
        .otherwise(F.lit("all"))
    )
    return rolled.select("team", "player", "yellow_cards", level.alias("level"))

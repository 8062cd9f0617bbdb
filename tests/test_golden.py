"""Golden values from the original application's two event files (read as data).

Skipped when the files are not available.
"""

import os

import pytest
from pyspark.sql import functions as F

from matchstream.operators import (
    fouls_tumbling,
    player_totals,
    scoreboard,
    yellow_momentum,
)
from matchstream.operators.cards import with_team_momentum_join, yellow_cards_sliding
from matchstream.sources.files import read_events_csv
from tests.conftest import REFERENCE

SMALL = os.path.join(REFERENCE, "events.csv")
LARGE = os.path.join(REFERENCE, "events_large.csv")

pytestmark = pytest.mark.skipif(not os.path.exists(LARGE), reason="reference data files absent")


@pytest.fixture(scope="module")
def large(spark):
    return read_events_csv(spark, LARGE).cache()


@pytest.fixture(scope="module")
def small(spark):
    return read_events_csv(spark, SMALL).cache()


def _by_type(df):
    return {r["event_type"]: r["count"] for r in df.groupBy("event_type").count().collect()}


def test_counts(large, small):
    assert large.count() == 500
    assert small.count() == 116  # trailing blank line skipped
    assert _by_type(large) == {"goal": 115, "shot": 84, "assist": 103, "foul": 101, "yellow_card": 97}
    assert _by_type(small) == {"goal": 34, "shot": 14, "assist": 36, "foul": 27, "yellow_card": 5}


def test_scoreboard(large, small):
    assert {r.team: r.goals for r in scoreboard(large).collect()} == {"AI United": 122, "FC Python": 113}
    assert {r.team: r.goals for r in scoreboard(small).collect()} == {"AI United": 33, "FC Python": 43}


def test_fouls(large, small):
    fl = fouls_tumbling(large)
    assert fl.count() == 18
    totals = {r.team: r.t for r in fl.groupBy("team").agg(F.sum("fouls").alias("t")).collect()}
    assert totals == {"AI United": 49, "FC Python": 52}
    by_minute = {
        (r.window_start.strftime("%H:%M"), r.team): r.fouls for r in fl.collect()
    }
    assert by_minute[("06:13", "AI United")] == 11 and by_minute[("06:13", "FC Python")] == 1
    assert by_minute[("06:20", "AI United")] == 3 and by_minute[("06:20", "FC Python")] == 2
    fs = fouls_tumbling(small)
    assert fs.count() == 4
    assert {r.team: r.t for r in fs.groupBy("team").agg(F.sum("fouls").alias("t")).collect()} == {
        "AI United": 21,
        "FC Python": 6,
    }


@pytest.mark.parametrize("strategy", ["native", "panes"])
def test_yellow_cards(large, small, strategy):
    for df, rows, total, alerts, momentum in ((large, 73, 485, 70, 71), (small, 20, 25, 5, 12)):
        ym = yellow_momentum(df, strategy=strategy).cache()
        assert ym.count() == rows
        assert ym.agg(F.sum("yellow_cards")).first()[0] == total
        assert ym.where("player_alert").count() == alerts
        assert ym.where("team_momentum_lost").count() == momentum
        joined = with_team_momentum_join(yellow_cards_sliding(df, strategy=strategy))
        assert joined.exceptAll(ym.select(*joined.columns)).count() == 0
        by_join = yellow_momentum(df, strategy=strategy, method="join")
        assert by_join.exceptAll(ym.select(*by_join.columns)).count() == 0
        ym.unpersist()


def test_yellow_windows_range(large):
    ym = yellow_momentum(large)
    lo, hi = ym.agg(F.min("window_start"), F.max("window_start")).first()
    assert lo.strftime("%H:%M") == "06:08" and hi.strftime("%H:%M") == "06:20"
    groups = ym.select("team", "window_start").distinct()
    assert groups.count() == 25


def test_player_table(large, small):
    expected = {
        ("FC Python", "Bob"): (468, 82, 14, 17.52136752136752),
        ("AI United", "Zara"): (404, 79, 23, 19.554455445544555),
        ("FC Python", "Alice"): (374, 69, 16, 18.449197860962567),
        ("AI United", "Yuki"): (385, 69, 18, 17.92207792207792),
        ("AI United", "Xander"): (355, 60, 21, 16.901408450704224),
        ("FC Python", "Charlie"): (314, 52, 11, 16.560509554140125),
    }
    for performance_only in (False, True):
        got = {
            (r.team, r.player): (r.total_shots_taken, r.total_goals_scored, r.total_assists, r.scoring_percentage)
            for r in player_totals(large, performance_only).collect()
        }
        assert got == expected
    small_pct = {r.player: r.scoring_percentage for r in player_totals(small).collect()}
    assert small_pct["Bob"] == 29.896907216494846
    assert small_pct["Charlie"] == 36.734693877551024

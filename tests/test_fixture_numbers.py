"""The expected sf0.01 numbers listed for the driver's test data."""

import os

import pytest
from pyspark.sql import functions as F

from matchstream.operators import (
    fouls_tumbling,
    player_totals,
    route_topics,
    scoreboard,
    yellow_momentum,
)
from matchstream.sources.testdata import load_match_events_from_testdata
from tests.conftest import SF01

pytestmark = pytest.mark.skipif(not os.path.exists(SF01), reason="driver test data absent")


@pytest.fixture(scope="module")
def events(spark):
    return load_match_events_from_testdata(spark, SF01).cache()


def test_type_counts(events):
    got = {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert got == {"goal": 1981, "shot": 2006, "assist": 2017, "foul": 1982, "yellow_card": 2014}


def test_window_rows_and_flags(events):
    assert fouls_tumbling(events).count() == 1962
    for (d, s), (rows, alerts, momentum) in {
        ("5 minutes", "1 minute"): (9823, 243, 6),
        ("60 minutes", "10 minutes"): (9644, 2050, 1174),
    }.items():
        ym = yellow_momentum(events, d, s)
        got = ym.agg(
            F.count(F.lit(1)),
            F.sum(F.col("player_alert").cast("int")),
            F.sum(F.col("team_momentum_lost").cast("int")),
        ).first()
        assert tuple(got) == (rows, alerts, momentum)


def test_players_and_scoreboard(events):
    assert player_totals(events).count() == 6
    assert {r.team: r.goals for r in scoreboard(events).collect()} == {"AI United": 1439, "FC Python": 1559}
    hourly = scoreboard(events, dedup_keys=[F.date_trunc("hour", "event_timestamp")], with_event_counts=True)
    assert hourly.agg(F.sum("goal_events")).first()[0] == 673


def test_routed_counts(events):
    got = {r.topic: r["count"] for r in route_topics(events).groupBy("topic").count().collect()}
    assert got == {"live_card": 2014, "live_score": 1981, "player_performance": 6004, "team_stats_1min": 1982}

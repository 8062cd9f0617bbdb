"""Property tests: random events against brute-force Python definitions."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchstream.operators import fouls_tumbling, scoreboard, yellow_cards_sliding
from matchstream.operators.cards import yellow_momentum

BASE = dt.datetime(2025, 4, 15, 6, 0, 0)
SCHEMA = (
    "event_id long, event_timestamp timestamp_ntz, event_type string, team string, player string, "
    "shots_taken int, goals_scored int"
)

event = st.tuples(
    st.integers(min_value=0, max_value=3 * 3600),          # seconds after BASE
    st.sampled_from(["foul", "yellow_card", "goal"]),
    st.sampled_from(["A", "B"]),
    st.sampled_from(["p1", "p2", "p3"]),
    st.integers(min_value=0, max_value=3),
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, evs):
    rows = [
        (i, BASE + dt.timedelta(seconds=s), typ, team, player, 0, goals)
        for i, (s, typ, team, player, goals) in enumerate(evs)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def brute_sliding(evs, duration_s, slide_s):
    out = Counter()
    for s, typ, team, player, _ in evs:
        if typ != "yellow_card":
            continue
        t = (BASE - dt.datetime(1970, 1, 1)).total_seconds() + s
        last = (t // slide_s) * slide_s
        start = last
        while start > t - duration_s:
            out[(team, player, start)] += 1
            start -= slide_s
    return out


@SETTINGS
@given(evs=st.lists(event, max_size=40), shape=st.sampled_from([(300, 60), (3600, 600), (600, 600), (3600, 60)]))
def test_sliding_counts_match_brute_force(spark, evs, shape):
    duration_s, slide_s = shape
    df = frame(spark, evs)
    expected = brute_sliding(evs, duration_s, slide_s)
    epoch = dt.datetime(1970, 1, 1)
    for strategy in ("native", "panes"):
        if strategy != "native" and duration_s == slide_s:
            strategy = "auto"
        got = yellow_cards_sliding(df, f"{duration_s} seconds", f"{slide_s} seconds", strategy=strategy)
        counted = Counter()
        for r in got.collect():
            assert r.window_end - r.window_start == dt.timedelta(seconds=duration_s)
            assert r.player_alert == (r.yellow_cards >= 2)
            counted[(r.team, r.player, (r.window_start - epoch).total_seconds())] = r.yellow_cards
        assert counted == expected


@SETTINGS
@given(evs=st.lists(event, max_size=40))
def test_window_sums_and_team_flag(spark, evs):
    df = frame(spark, evs)
    cards = sum(1 for e in evs if e[1] == "yellow_card")
    fouls = sum(1 for e in evs if e[1] == "foul")
    ym = yellow_momentum(df).collect()
    assert sum(r.yellow_cards for r in ym) == 5 * cards
    team_totals = Counter()
    for r in ym:
        team_totals[(r.team, r.window_start)] += r.yellow_cards
    for r in ym:
        assert r.team_momentum_lost == (team_totals[(r.team, r.window_start)] > 3)
    total = fouls_tumbling(df).agg(F.sum("fouls")).first()[0]
    assert (total or 0) == fouls


@SETTINGS
@given(evs=st.lists(event, max_size=40))
def test_scoreboard_first_per_timestamp_and_replay(spark, evs):
    df = frame(spark, evs)
    first = {}
    for i, (s, typ, team, _, goals) in enumerate(evs):
        if typ == "goal" and s not in first:
            first[s] = (team, goals)
    expected = Counter({"A": 0, "B": 0, "FC Python": 0, "AI United": 0})
    for team, goals in first.values():
        expected[team] += goals
    got = {r.team: r.goals for r in scoreboard(df).collect()}
    for team in set(got) | set(k for k, v in expected.items()):
        assert got.get(team, 0) == expected.get(team, 0)
    replay = {r.team: r.goals for r in scoreboard(df.unionByName(df)).collect()}
    assert replay == got


def test_strategies_agree_on_driver_data(spark):
    import os

    from matchstream.sources.testdata import load_match_events_from_testdata
    from tests.conftest import SF01

    if not os.path.exists(SF01):
        return
    ev = load_match_events_from_testdata(spark, SF01, ["yellow_card"])
    results = [
        yellow_cards_sliding(ev, "60 minutes", "1 minute", strategy=s) for s in ("native", "panes")
    ]
    for other in results[1:]:
        assert results[0].exceptAll(other).count() == 0 and other.exceptAll(results[0]).count() == 0
    ym = yellow_momentum(ev, "60 minutes", "1 minute")  # 60 windows a row
    joined = yellow_momentum(ev, "60 minutes", "1 minute", strategy="native", method="join")
    assert ym.exceptAll(joined.select(*ym.columns)).count() == 0
    assert joined.exceptAll(ym.select(*joined.columns)).count() == 0

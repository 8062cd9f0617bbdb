"""The rules of all metrics on a few rows that can be counted by hand."""

import pytest
from pyspark.sql import functions as F

from matchstream.operators import family_counts, fouls_tumbling, player_totals, scoreboard
from matchstream.operators.cards import yellow_momentum
from matchstream.sources.files import read_events_csv

ROWS = """timestamp,event_type,team,player,shots_taken,goals_scored
2024-05-01T10:00:05,goal,FC Python,Ann,0,2
2024-05-01T10:00:05,goal,AI United,Zoe,0,3
2024-05-01T10:00:30,shot,FC Python,Ann,4,1
2024-05-01T10:00:59,foul,AI United,Zoe,,
2024-05-01T10:01:00,foul,AI United,Yan,0,0
2024-05-01T10:01:10,foul,FC Python,Bea,0,0
2024-05-01T10:01:20,foul,AI United,Zoe,0,0
2024-05-01T10:02:00,yellow_card,AI United,Zoe,0,0
2024-05-01T10:02:30,yellow_card,AI United,Zoe,0,0
2024-05-01T10:03:00,yellow_card,AI United,Yan,0,0
2024-05-01T10:04:59,yellow_card,AI United,Yan,0,0
2024-05-01T10:05:00,assist,FC Python,Bea,0,0
2024-05-01T10:06:00,goal,FC Python,Bea,0,1
2024-05-01T10:06:30,shot,AI United,Zoe,5,0

"""


@pytest.fixture
def events(spark, tmp_path):
    (tmp_path / "events.csv").write_text(ROWS)
    return read_events_csv(spark, str(tmp_path / "events.csv"))


def test_counts(events):
    assert events.count() == 14  # the blank line is none
    by_type = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert by_type == {"goal": 3, "shot": 2, "foul": 4, "yellow_card": 4, "assist": 1}
    assert family_counts(events).count() > 0


def test_one_goal_a_time(events):
    first = events.withColumn("event_id", F.when(F.col("team") == "FC Python", 1).otherwise(2).cast("long"))
    assert {r.team: r.goals for r in scoreboard(first).collect()} == {"FC Python": 3, "AI United": 0}


def test_fouls_by_minute(events):
    got = {(r.team, r.window_start.minute): r.fouls for r in fouls_tumbling(events).collect()}
    assert got == {("AI United", 0): 1, ("AI United", 1): 2, ("FC Python", 1): 1}


@pytest.mark.parametrize("strategy", ["native", "panes"])
def test_cards_in_sliding_windows(events, strategy):
    got = {(r.player, r.window_start.strftime("%H:%M")): (r.yellow_cards, r.player_alert, r.team_momentum_lost) for r in yellow_momentum(events, strategy=strategy).collect()}
    assert got[("Zoe", "09:58")] == (2, True, False) and ("Yan", "09:58") not in got
    for start in ("10:00", "10:01", "10:02"):  # the windows that hold all four cards
        assert got[("Zoe", start)] == got[("Yan", start)] == (2, True, True)
    assert got[("Yan", "10:03")] == (2, True, False) and got[("Yan", "10:04")] == (1, False, False)
    assert len(got) == 11  # five windows of Zoe, six of Yan


def test_players(events):
    got = {r.player: (r.total_shots_taken, r.total_goals_scored, r.total_assists, r.scoring_percentage) for r in player_totals(events, performance_only=True).collect()}
    assert got == {"Ann": (4, 3, 0, 75.0), "Bea": (0, 1, 1, 0.0), "Zoe": (5, 3, 0, 60.0)}
    every = {r.player: r.total_goals_scored for r in player_totals(events, performance_only=False).collect()}
    assert every == {"Ann": 3, "Bea": 1, "Zoe": 3, "Yan": 0}

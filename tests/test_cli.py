"""The command line, driven in-process (it reuses the test session)."""

import os

import pytest

from matchstream.__main__ import main
from matchstream.sources.files import write_events_csv
from matchstream.sources.testdata import load_match_events_from_testdata
from tests.conftest import SF001

pytestmark = pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data absent")


def test_load_batch_route_stream_serve(spark, tmp_dir, capsys):
    csv = os.path.join(tmp_dir, "csv")
    write_events_csv(load_match_events_from_testdata(spark, SF001), csv)
    table = os.path.join(tmp_dir, "match_events")
    assert main(["load", "--csv", csv, "--table", table]) == 0
    assert spark.read.parquet(table).count() == 1000

    report = os.path.join(tmp_dir, "report")
    main(["batch", "--table", table, "--out", report])
    assert "foul_stats" in capsys.readouterr().out
    assert spark.read.parquet(os.path.join(report, "scoreboard")).count() == 2

    topics = os.path.join(tmp_dir, "topics")
    main(["route", "--table", table, "--topics-dir", topics])
    out = os.path.join(tmp_dir, "out")
    main(["stream", "--topics-dir", topics, "--out", out, "--available-now"])
    from matchstream.operators import yellow_momentum
    from matchstream.sinks.keyed_table import KeyedTable
    from matchstream.schema import CARD_KEYS
    from matchstream.streaming.pipeline import by_window

    closed = KeyedTable(spark, os.path.join(out, "yellow_momentum_stats"), CARD_KEYS, by_window()).read()
    assert closed.count() == yellow_momentum(load_match_events_from_testdata(spark, SF001)).count()  # no window is left out
    board = {r.team: r.goals for r in spark.read.parquet(os.path.join(report, "scoreboard")).collect()}
    main(["serve", "--out", out, "--view", "scoreboard"])
    shown = capsys.readouterr().out
    for team, goals in board.items():
        assert team in shown and str(goals) in shown
    for view, header in (("fouls", "fouls"), ("cards", "yellow_cards"), ("players", "scoring_percentage")):
        main(["serve", "--out", out, "--view", view, "-n", "5"])
        assert header in capsys.readouterr().out


def test_load_into_jdbc_and_batch_from_it(spark, tmp_dir, capsys):
    csv = os.path.join(tmp_dir, "csv")
    events = load_match_events_from_testdata(spark, SF001)
    write_events_csv(events, csv)
    url = f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    for _ in range(2):  # a retry of the load changes nothing
        main(["load", "--csv", csv, "--jdbc-url", url, "--jdbc-driver", driver, "--load-id", "day 1"])
    report = os.path.join(tmp_dir, "report")
    main(["batch", "--jdbc-url", url, "--jdbc-table", "MATCH_EVENTS", "--jdbc-driver", driver,
          "--jdbc-partitions", "3", "--out", report])
    from matchstream.operators import scoreboard

    got = {r.team: r.goals for r in spark.read.parquet(os.path.join(report, "scoreboard")).collect()}
    assert got == {r.team: r.goals for r in scoreboard(events).collect()}


def test_bad_csv_rows_are_counted_and_kept(spark, tmp_dir, capsys):
    csv, bad = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "bad")
    os.makedirs(csv)
    with open(os.path.join(csv, "a.csv"), "w") as f:
        f.write("timestamp,event_type,team,player,shots_taken,goals_scored\n2024-01-01T10:00:00,foul,A,x,0,0\nnope,foul,A,x,0,0\n"
                "2024-01-01T10:00:30,goal,A,x,many,1\n2024-01-01T10:01:00,foul,B,,0,0\n")
    for command in (["batch", "--out", os.path.join(tmp_dir, "out")], ["route", "--topics-dir", os.path.join(tmp_dir, "topics")],
                    ["load", "--table", os.path.join(tmp_dir, "table")]):
        main([command[0], "--csv", csv, *command[1:], "--quarantine", bad])
        assert "quarantined\t2 of 4 rows" in capsys.readouterr().out
        assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["bad_integer", "bad_timestamp"]

"""Inline edge rows: the rules, independent of any data file."""

import datetime as dt
import os

from pyspark.sql import functions as F

from matchstream.functions.format import percent_text
from matchstream.functions.parse import parse_json_events
from matchstream.operators import (
    family_counts,
    fouls_tumbling,
    latest_fouls,
    player_totals,
    route_topics,
    scoreboard,
    yellow_momentum,
)
from matchstream.operators.cards import yellow_cards_sliding
from matchstream.operators.scoreboard import first_per_key
from matchstream.operators.serving import scoreboard_readout
from matchstream.sources.files import read_events_csv

SCHEMA = (
    "event_id long, event_timestamp timestamp_ntz, event_type string, team string, player string, "
    "shots_taken int, goals_scored int"
)


def t(hms: str) -> dt.datetime:
    h, m, s = (int(x) for x in hms.split(":"))
    return dt.datetime(2025, 4, 15, h, m, s)


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_zero_and_null_shots(spark):
    df = events(
        spark,
        [
            (1, t("06:12:00"), "assist", "A", "p1", 0, 0),
            (2, t("06:12:01"), "assist", "A", "p1", 0, 0),
            (3, t("06:12:02"), "assist", "B", "p2", None, None),
        ],
    )
    got = {r.player: r for r in player_totals(df).collect()}
    assert got["p1"].scoring_percentage == 0.0 and got["p1"].total_assists == 2
    assert got["p2"].scoring_percentage == 0.0 and got["p2"].total_shots_taken is None


def test_blank_ints_in_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "e.csv")
    with open(path, "w") as f:
        f.write("timestamp,event_type,team,player,shots_taken,goals_scored\n")
        f.write("2025-04-15T06:12:00,assist,A,p1,,\n")
        f.write("2025-04-15T06:12:01,shot,A,p1, 7 ,2\n")
        f.write("\n")
    rows = read_events_csv(spark, path).orderBy("event_timestamp").collect()
    assert [(r.shots_taken, r.goals_scored) for r in rows] == [(0, 0), (7, 2)]
    assert rows[0].event_timestamp == t("06:12:00")


def test_bad_json_and_bad_timestamp_quarantined(spark):
    msgs = spark.createDataFrame(
        [
            ('{"timestamp":"2025-04-15T06:12:00","event_type":"foul","team":"A","player":"p",'
             '"shots_taken":0,"goals_scored":0}',),
            ("{oops",),
            ('{"timestamp":"nope","event_type":"foul","team":"A","player":"p"}',),
            ('{"timestamp":"2025-04-15T06:12:05","event_type":"goal","team":"A","player":"p"}',),
        ],
        "value string",
    )
    good, bad = parse_json_events(msgs)
    assert good.count() == 2
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad_timestamp", "malformed_json"]
    assert fouls_tumbling(good).agg(F.sum("fouls")).first()[0] == 1
    # missing goals_scored on a goal -> counts as 0
    assert {r.team: r.goals for r in scoreboard(good).collect()}["A"] == 0


def test_binary_value_like_kafka(spark):
    msgs = spark.createDataFrame(
        [(bytearray(b'{"timestamp":"2025-04-15T06:12:00","event_type":"foul","team":"A","player":"p"}'),)],
        "value binary",
    )
    good, bad = parse_json_events(msgs)
    assert good.count() == 1 and bad.count() == 0


def test_router_unknown_type_and_fanout(spark):
    df = events(
        spark,
        [
            (1, t("06:12:00"), "goal", "A", "p", 3, 1),
            (2, t("06:12:01"), "red_card", "A", "p", 0, 0),
            (3, t("06:12:02"), "yellow_card", "B", "q", 0, 0),
            (4, t("06:12:03"), "assist", "B", "q", 0, 0),
            (5, t("06:12:04"), "foul", "B", "q", 0, 0),
        ],
    )
    routed = sorted((r.event_id, r.topic) for r in route_topics(df).collect())
    assert routed == [
        (1, "live_score"),
        (1, "player_performance"),
        (2, "unrouted"),
        (3, "live_card"),
        (4, "player_performance"),
        (5, "team_stats_1min"),
    ]
    fam = {r.family: r.events for r in family_counts(df).collect()}
    assert fam == {"player_performance": 2, "yellow_card": 1, "foul": 1, "total": 4}


def test_unknown_team_and_team_without_goals(spark):
    df = events(spark, [(1, t("06:12:00"), "goal", "Guests", "g", 1, 2)])
    board = {r.team: r.goals for r in scoreboard(df).collect()}
    assert board == {"Guests": 2, "FC Python": 0, "AI United": 0}
    assert {r.team: r.goals for r in scoreboard_readout(None, spark).collect()} == {
        "FC Python": 0,
        "AI United": 0,
    }


def test_equal_timestamps_lowest_event_id_wins(spark):
    df = events(
        spark,
        [
            (7, t("06:12:00"), "goal", "FC Python", "a", 1, 1),
            (3, t("06:12:00"), "goal", "AI United", "b", 1, 2),
        ],
    )
    assert {r.team: r.goals for r in scoreboard(df).collect()} == {"AI United": 2, "FC Python": 0}
    # replaying the whole input adds nothing
    assert {r.team: r.goals for r in scoreboard(df.unionByName(df)).collect()} == {
        "AI United": 2,
        "FC Python": 0,
    }
    kept = first_per_key(df, ["event_timestamp"]).collect()
    assert [r.event_id for r in kept] == [3]


def test_window_edge_and_sliding_cover(spark):
    df = events(
        spark,
        [
            (1, t("06:13:00"), "foul", "A", "p", 0, 0),
            (2, t("06:12:05"), "yellow_card", "A", "p", 0, 0),
        ],
    )
    f = fouls_tumbling(df).collect()
    assert [(r.window_start, r.window_end) for r in f] == [(t("06:13:00"), t("06:14:00"))]
    for strategy in ("native", "panes"):
        starts = sorted(r.window_start for r in yellow_cards_sliding(df, strategy=strategy).collect())
        assert starts == [t("06:08:00"), t("06:09:00"), t("06:10:00"), t("06:11:00"), t("06:12:00")]


def test_null_event_time_in_no_window(spark):
    df = events(spark, [(1, None, "foul", "A", "p", 0, 0), (2, None, "yellow_card", "A", "p", 0, 0)])
    assert fouls_tumbling(df).count() == 0
    for strategy in ("native", "panes"):
        assert yellow_cards_sliding(df, strategy=strategy).count() == 0


def test_alert_and_momentum_thresholds(spark):
    rows = [
        (1, t("06:12:10"), "yellow_card", "A", "p1", 0, 0),
        (2, t("06:12:20"), "yellow_card", "A", "p1", 0, 0),  # p1: 2 cards -> alert
        (3, t("06:12:30"), "yellow_card", "A", "p2", 0, 0),  # team A: 3 -> no momentum loss
        (4, t("06:12:10"), "yellow_card", "B", "q1", 0, 0),
        (5, t("06:12:20"), "yellow_card", "B", "q2", 0, 0),
        (6, t("06:12:30"), "yellow_card", "B", "q3", 0, 0),
        (7, t("06:12:40"), "yellow_card", "B", "q4", 0, 0),  # team B: 4 -> lost, all players
    ]
    ym = yellow_momentum(events(spark, rows)).where(F.col("window_start") == F.lit(t("06:12:00")))
    got = {(r.team, r.player): (r.yellow_cards, r.player_alert, r.team_momentum_lost) for r in ym.collect()}
    assert got[("A", "p1")] == (2, True, False)
    assert got[("A", "p2")] == (1, False, False)
    assert all(v[2] for k, v in got.items() if k[0] == "B")
    assert not any(v[1] for k, v in got.items() if k[0] == "B")


def test_top_n_tie_ordered_by_team(spark):
    rows = [
        (1, t("06:12:10"), "foul", "B", "p", 0, 0),
        (2, t("06:12:20"), "foul", "A", "p", 0, 0),
        (3, t("06:11:20"), "foul", "C", "p", 0, 0),
    ]
    top = latest_fouls(fouls_tumbling(events(spark, rows)), 2).collect()
    assert [r.team for r in top] == ["A", "B"]


def test_percent_text_rounding(spark):
    vals = [2.675, 17.52136752136752, 0.0, 1234.5, 100.0, 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.p for r in df.select(percent_text("x").alias("p")).collect()]
    assert got == [f"{v:.2f}%" for v in vals]


def test_window_bound_text(spark):
    from matchstream.functions.format import window_bound_text

    df = spark.createDataFrame([(t("06:13:00"),)], "w timestamp_ntz")
    assert df.select(window_bound_text("w").alias("s")).first().s == "2025-04-15 06:13:00"


def test_cluster_conf_sizes():
    from matchstream.session import ROCKSDB_PROVIDER, cluster_conf

    conf = cluster_conf(8000, input_bytes=100 * 1024**4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    assert conf["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB_PROVIDER
    assert int(cluster_conf(10)["spark.sql.shuffle.partitions"]) == 200


def test_wrong_typed_field_keeps_the_event(spark):
    msgs = spark.createDataFrame(
        [
            ('{"timestamp":"2025-04-15T06:12:00","event_type":"shot","team":"A","player":"p",'
             '"shots_taken":"abc","goals_scored":2}',),
            ("",),
            ("{}",),
            ("[]",),
        ],
        "value string",
    )
    good, bad = parse_json_events(msgs)
    rows = good.collect()
    assert len(rows) == 1 and rows[0].shots_taken is None and rows[0].goals_scored == 2
    assert sorted(r.reason for r in bad.collect()) == ["bad_timestamp", "bad_timestamp", "malformed_json"]


def test_fs_helpers_without_jvm(tmp_dir):
    """The commit-record helpers also work for a client without JVM access."""
    from matchstream.sinks import fs

    class NoContext:
        @property
        def sparkContext(self):
            raise RuntimeError("remote session")

    s = NoContext()
    path = f"file:{tmp_dir}/log/00000000.json"
    assert fs.write_new_text(s, path, "{}")
    assert not fs.write_new_text(s, path, "{}")
    assert fs.read_text(s, path) == "{}"
    assert fs.list_names(s, f"{tmp_dir}/log") == ["00000000.json"]
    fs.delete_tree(s, f"{tmp_dir}/log")
    assert not fs.exists(s, f"{tmp_dir}/log")


def test_null_team_and_player_form_their_own_groups(spark):
    df = events(
        spark,
        [
            (1, t("06:12:00"), "foul", None, None, 0, 0),
            (2, t("06:12:10"), "foul", None, "p", 0, 0),
            (3, t("06:12:20"), "shot", None, None, 4, 1),
            (4, t("06:12:30"), "shot", "A", "p", 2, 1),
        ],
    )
    fouls = {(r.team, r.fouls) for r in fouls_tumbling(df).collect()}
    assert fouls == {(None, 2)}
    players = {(r.team, r.player): r.total_shots_taken for r in player_totals(df).collect()}
    assert players == {(None, None): 4, (None, "p"): 0, ("A", "p"): 2}

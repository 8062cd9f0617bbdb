"""CSV by header name, the quarantine, and loads that can be repeated."""

import os

import pytest
from pyspark.sql import functions as F

from matchstream.session import work_root
from matchstream.sources.files import append_match_events, read_events_csv, read_events_csv_checked

HEADER = "timestamp,event_type,team,player,shots_taken,goals_scored"


def csv(folder, text, name="a.csv"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_columns_go_by_name(spark, tmp_dir):
    path = csv(tmp_dir, "team,timestamp,goals_scored,event_type,extra,player,shots_taken\nA,2024-01-01T10:00:00,2,goal,x,p,\n")
    row = read_events_csv(spark, path).first()
    assert (row.team, row.event_type, row.player, row.shots_taken, row.goals_scored) == ("A", "goal", "p", 0, 2)


def test_missing_column_raises(spark, tmp_dir):
    with pytest.raises(ValueError, match="player"):
        read_events_csv(spark, csv(tmp_dir, "timestamp,event_type,team,shots_taken,goals_scored\n"))


def test_quotes_are_doubled(spark, tmp_dir):
    path = csv(tmp_dir, HEADER + '\n2024-01-01T10:00:00,goal,"A ""x"", B",p,1,1\n')
    assert read_events_csv(spark, path).first().team == 'A "x", B'


def test_bad_rows_go_to_quarantine(spark, tmp_dir):
    lines = ["2024-01-01T10:00:00,goal,A,p,1,1", "nope,goal,A,p,1,1", ",goal,A,p,1,1", "2024-01-01T10:00:00,shot,A,p,x,1", "2024-01-01T10:00:00,foul,A,p, ,"]
    good, bad = read_events_csv_checked(spark, csv(tmp_dir, "\n".join([HEADER, *lines]) + "\n"))
    assert sorted((r.event_type, r.shots_taken) for r in good.collect()) == [("foul", 0), ("goal", 1)]
    assert sorted(r.reason for r in bad.collect()) == ["bad_integer", "bad_timestamp", "bad_timestamp"]


def test_load_is_repeatable_and_makes_few_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    events = spark.range(3000).select(
        F.timestamp_add("HOUR", (F.col("id") % 240).cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("event_timestamp"),
        F.lit("goal").alias("event_type"), "id",
    ).repartition(16)
    for _ in range(2):
        append_match_events(events, path, load_id="monday")
    append_match_events(events.limit(10), path, load_id="tuesday")
    got = spark.read.parquet(path)
    assert got.where("load_id = 'monday'").count() == 3000 and got.count() == 3010
    files = [f for _, _, fs in os.walk(os.path.join(path, "load_id=monday")) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2 * 11


def test_work_folder_must_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(Session())

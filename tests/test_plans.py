"""Physical-plan properties the scale design relies on."""

import os

import pytest

import __spark_entry__ as entry_mod
from matchstream.plans.registry import all_queries
from matchstream.operators import player_totals, time_range
from matchstream.sources.files import append_match_events
from matchstream.sources.testdata import load_match_events_from_testdata
from tests.conftest import SF001, SF01
from tests.plan_utils import plan_text

pytestmark = pytest.mark.skipif(not os.path.exists(SF01), reason="driver test data absent")

SCAN_FILTERS = {
    "fouls_tumbling_1m": "EqualTo(event_type,view)",
    "yellow_cards_5m": "EqualTo(event_type,error)",
    "yellow_momentum_60m": "EqualTo(event_type,error)",
    "scoreboard": "EqualTo(event_type,purchase)",
    "player_stats_performance": "In(event_type, [click,purchase,signup])",
}


# Queries that never need shots/goals must not read the ``props`` column.
NO_PROPS = {"fouls_tumbling_1m", "yellow_cards_5m", "yellow_momentum_60m"}


@pytest.mark.parametrize("key,pushed", sorted(SCAN_FILTERS.items()))
def test_type_filter_reaches_the_scan(spark, key, pushed):
    plan = plan_text(entry_mod.queries()[key](spark, SF01))
    assert pushed in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert ("props" in read_schema) == (key not in NO_PROPS)


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for key, fn in all_queries().items():
        if key.startswith("stream_") or key == "load_match_events":
            continue
        plan = plan_text(fn(spark, SF01))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_momentum_window_reuses_the_team_window_partitioning(spark):
    plan = plan_text(entry_mod.queries()["yellow_momentum_5m"](spark, SF01))
    top = plan.split("\n\n")[0]
    assert top.count("Exchange") == 2
    assert "Window" in top and "Join" not in top


def test_time_range_prunes_date_partitions(spark, tmp_dir):
    table = os.path.join(tmp_dir, "match_events")
    append_match_events(load_match_events_from_testdata(spark, SF001), table)
    events = spark.read.parquet(table)
    df = player_totals(time_range(events, "2024-01-03 00:00:00", "2024-01-05 00:00:00"))
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "GreaterThanOrEqual(event_timestamp" in plan


def test_dedup_is_partially_aggregated(spark):
    plan = plan_text(entry_mod.queries()["scoreboard"](spark, SF01))
    assert "partial_min" in plan
    assert "row_number" not in plan

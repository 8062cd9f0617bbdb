"""Every registered query equals its DuckDB oracle (the driver's gate) at sf0.01."""

import os

import pytest

import __spark_entry__ as entry_mod
from matchstream.plans.registry import all_oracles, all_queries
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck

KEYS = sorted(all_queries())


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(KEYS)
    assert set(KEYS) <= set(entry_mod.queries()) and set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.skipif(not os.path.exists(SF01), reason="driver test data absent")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    info = compare(spark, key, SF01, con)
    assert info["ok"], info
    assert info["spark_rows"] > 0


@pytest.mark.skipif(not os.path.exists(SF001), reason="driver test data absent")
def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == [
        "team",
        "player",
        "yellow_cards",
        "window_start",
        "window_end",
        "player_alert",
        "team_momentum_lost",
    ]
    assert df.count() > 0

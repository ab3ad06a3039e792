"""Every registered query against its SQL oracle on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")

# the queries for training data have tests of their own
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry_module.queries().items() if not OWN.match(n)}
SQL = {n: q for n, q in entry_module.oracle_sql().items() if not OWN.match(n)}
# too few matches per champion, item or patch on the smallest tables
MAY_BE_EMPTY = {"patches", "patches_in_order", "latest_patch_shift", "patch_shift", "patch_shift_extremes", "champion_anomalies", "champion_strongest", "champion_ranking",
                "player_profiles", "player_labels", "top_players", "champion_ranking_top", "scaling", "scaling_extremes",
                "top_champion", "best_scaler", "favourite_champion", "champion_filtered", "item_popularity", "top_item", "best_item"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in SQL:
        assert df.count() > 0
        return
    problem = compare(name, df, con, SQL[name])
    if name in MAY_BE_EMPTY and problem == "empty result":
        problem = None
    assert problem is None


def test_only_the_sketched_query_has_no_oracle():
    assert set(QUERIES) - set(SQL) == {"source_overview_approx"}


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "wilson_low" in df.columns and df.count() >= 0

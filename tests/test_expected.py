"""Every registered query against its expected SQL, and the rules its plan must keep."""

import re

import pytest
from compare import connect, difference, duck_result, plan_of, spark_result

from tidemark.plans.catalog import ORACLES, QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")

# Reports over a fixed number of rows number them in one task; scans over a whole
# table order one row per part there.
FEW_ROWS = {
    "publish_list", "top_performers", "largest_results", "lenient_tokens", "screened_tokens", "latest_rows", "whale_trades", "hot_tokens",
    "trader_activity", "meme_trends", "venue_ranking", "unknown_pairs", "unknown_tokens",
    "check_sequential", "check_sequential_days", "check_exclusive_ranges_overall", "validate_gold_traders", "asof_events_within",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    assert not [operator for operator in FORBIDDEN if operator in plan]
    if name not in FEW_ROWS:
        windows = re.findall(r"\) Window\n(?:.*\n)*?\n", plan)
        assert not [w for w in windows if "Arguments: [], [" in w]
    got = spark_result(df)
    if name in ORACLES:
        assert difference(got, duck_result(con, ORACLES[name])) is None
    else:
        assert got[1]


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()

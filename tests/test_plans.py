"""Shapes of physical plans that must hold at any size."""

from compare import plan_of
from pyspark.sql import functions as F

from tidemark.plans import adapters as A
from tidemark.plans.catalog import QUERIES


def test_running_cost_meets_rows_with_one_line_per_bucket_only(spark, sf_dir):
    """Rows are windowed by (pair, bucket) and joined with one row per bucket; no window spans a whole pair of rows."""
    plan = plan_of(QUERIES["running_cost_by_token"](spark, sf_dir))
    body = plan.split("\n\n")[0]
    assert body.count("SortMergeJoin") + body.count("BroadcastHashJoin") + body.count("ShuffledHashJoin") == 1
    # The joined trades were written once; rows and bucket totals are read from there.
    assert body.count("Scan parquet") == 2
    assert plan.count("/cut-") == 2 and "lineitem" not in plan


def test_input_of_a_scan_is_computed_once(spark, sf_dir):
    """No given table is read by the plans of running results; each was joined and written before."""
    for name in ("position_pnl", "running_positions", "running_cost_portfolio", "running_cost_of_orders", "fifo_matches"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "lineitem" not in plan and "orders.parquet" not in plan, name


def test_dedup_is_cut_before_the_shuffle(spark, sf_dir):
    body = plan_of(QUERIES["keep_latest_line"](spark, sf_dir)).split("\n\n")[0]
    assert body.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = A.table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") > 40).select("l_orderkey")
    plan = plan_of(rows)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_order_trades_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(A.order_trades(spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan


def test_payloads_are_parsed_once(spark, sf_dir):
    """One parse per payload; ``payload_kinds`` has one in each branch of its union, details parse what events kept."""
    for name, parses in {"silver_events": 1, "payload_kinds": 2, "transaction_details": 2, "trade_list_rows": 1}.items():
        body = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        found = body.count("parse_json(") + body.count("parseJson") + body.count("from_json(") + body.count("jsontostructs(")
        assert 1 <= found <= parses, (name, found)
        assert "get_json_object(payload" not in body

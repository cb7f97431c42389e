"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "running_cost_portfolio", "running_cost_of_orders", "whole_period_portfolio", "net_flow_portfolio", "position_pnl", "fifo_matches",
    "gold_traders", "top_performers", "ranked_positions", "wallet_summary",
    "momentum_tokens", "tracked_tokens", "tracked_holders",
    "silver_events", "quality_by_date", "enriched_alerts", "payload_profile", "hot_tokens", "trader_activity", "meme_trends",
    "keep_latest_line", "pivot_counts", "unpivot_orders", "date_spine_orders", "surrogate_keys", "url_parts",
    "check_unique_combination", "check_exclusive_ranges", "check_relationships_where", "null_profile", "upsert", "stream_landing",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='bench-')}", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[names[0]](spark, sf_dir).count()  # start the engine

    timings = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()

"""Queries that run a whole flow and return its last table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.scalars import moment
from tidemark.plans import adapters as A
from tidemark.plans.flows import EventFlow, TraderFlow
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_events import _QUALITY
from tidemark.plans.query_pnl import _GOLD_COLUMNS
from tidemark.plans.registry import query
from tidemark.session import fresh_path


@query(using("portfolios") + _GOLD_COLUMNS + """
  SELECT wallet_address, performance_tier, smart_trader_score, total_pnl, win_rate, trade_count,
         row_number() OVER (ORDER BY smart_trader_score DESC, total_pnl DESC, wallet_address) AS overall_rank FROM qualified""")
def trader_flow(spark, sf_dir):
    root, sources = fresh_path(spark, "trader-flow"), [f(spark, sf_dir) for f in (A.tokens, A.holders, A.swaps)]
    gold = TraderFlow(spark, root, datetime(2024, 2, 1, 6), "run-1").run(*sources)
    return gold.select(
        "wallet_address", "performance_tier", "smart_trader_score", "total_pnl", "win_rate", "trade_count", "overall_rank"
    )


@query(using("silver_events") + _QUALITY)
def event_flow(spark, sf_dir):
    root, messages = fresh_path(spark, "event-flow"), A.messages(spark, sf_dir)
    half = F.col("processed_at") < moment(datetime(2024, 1, 15, 12))
    EventFlow(spark, root, datetime(2024, 2, 1), "first").run(messages.filter(half))
    return EventFlow(spark, root, datetime(2024, 2, 2), "second").run(messages)

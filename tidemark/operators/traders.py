"""Gold tables: qualified traders with tiers, scores and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import market as M
from tidemark.operators.ordered import global_position, top_n
from tidemark.session import cut_lineage


def gold_traders(portfolios: DataFrame) -> DataFrame:
    """Wallets in profit or with wins: tier, score, behaviour and both ranks."""
    qualified = portfolios.filter(
        ((F.col("win_rate") > 0) | (F.col("total_pnl") > 0))
        & (F.col("trade_count") >= 1)
        & (F.col("total_bought") > 0)
        & F.col("wallet_address").isNotNull()
    )
    traded = F.col("total_bought") + F.col("total_sold")
    scored = qualified.withColumns(
        {
            "performance_tier": M.gold_tier(),
            "smart_trader_score": M.gold_score(),
            "trading_experience_days": M.days_between(F.col("first_transaction"), F.col("last_transaction")) + 1,
            "avg_trade_size_usd": F.round(F.try_divide(traded, F.col("trade_count")), 2),
            "sell_ratio_percent": F.round(M.percent(F.col("total_sold"), F.col("total_bought")), 2),
        }
    )
    best_first = [F.desc("smart_trader_score"), F.desc("total_pnl"), F.asc("wallet_address")]
    return global_position(scored, best_first, "overall_rank", within={"tier_rank": ["performance_tier"]})


def simple_traders(portfolios: DataFrame) -> DataFrame:
    """Portfolio rows with profit or wins and the simple tier."""
    rows = portfolios.filter(
        (F.col("token_address") == S.PORTFOLIO_TOKEN) & ((F.col("total_pnl") > 0) | (F.col("win_rate") > 0))
    )
    return rows.withColumn("performance_tier", M.simple_tier())


def publish_list(traders: DataFrame, keep: int = 100) -> DataFrame:
    """The best traders, best tier first, then by profit."""
    rated = traders.withColumn("tier_place", M.tier_priority(F.col("performance_tier")))
    return top_n(rated, [F.asc("tier_place"), F.desc("total_pnl"), F.asc("wallet_address")], keep, "place")


def top_performers(portfolios: DataFrame, keep: int = S.TOP_TRADERS_KEPT) -> DataFrame:
    """Wallets above the base gate with scores and tier, the most profitable ones."""
    gated = portfolios.filter(M.at_least(S.TOP_GATE) & (F.col("total_pnl") > 0))
    scored = gated.withColumns(
        {
            "days_active": M.days_between(F.col("first_transaction"), F.col("last_transaction")),
            "consistency_score": M.consistency_score(),
            "risk_score": M.risk_score(),
            "profit_factor": M.profit_factor(),
            "performance_tier": M.top_tier(),
        }
    )
    return top_n(scored, [F.desc("total_pnl"), F.asc("wallet_address")], keep, "trader_rank")


def scored_positions(positions: DataFrame) -> DataFrame:
    """Wallet-token results worth ranking, with score and the three tiers."""
    kept = positions.filter(
        (F.col("total_pnl") >= 0)
        & (F.col("total_trades") >= 1)
        & (F.col("pnl_quality_score") >= 0.5)
        & (F.col("avg_trade_efficiency") >= 0.7)
        & F.col("token_address").isNotNull()
        & F.col("wallet_address").isNotNull()
    )
    return kept.withColumns(
        {
            "enhanced_smart_trader_score": M.token_trader_score(),
            "performance_tier": M.token_trader_tier(),
            "execution_quality_tier": M.execution_tier(),
            "portfolio_size_tier": M.portfolio_size_tier(F.col("current_position_value_usd")),
        }
    )


def ranked_positions(scored: DataFrame) -> DataFrame:
    """Four ranks and three percentiles over all positions, none of them in a single task.

    Each order is sorted with its own columns and a row number only; the rows meet
    their ranks again in one shuffle by that number.
    """
    tie = [F.asc("wallet_address"), F.asc("token_address")]
    orders = {
        "overall_rank": [F.desc("enhanced_smart_trader_score"), F.desc("total_pnl"), *tie],
        "profitability_rank": [F.desc("total_pnl"), *tie],
        "execution_rank": [F.desc("avg_trade_efficiency"), F.desc("avg_timing_score"), *tie],
        "roi_rank": [F.desc("roi"), *tie],
    }
    sorted_by = {
        "overall_rank": ["enhanced_smart_trader_score", "total_pnl"],
        "profitability_rank": ["total_pnl"],
        "execution_rank": ["avg_trade_efficiency", "avg_timing_score"],
        "roi_rank": ["roi"],
    }
    percentiles = {
        "overall_rank": {"score_percentile": "enhanced_smart_trader_score"},
        "profitability_rank": {"pnl_percentile": "total_pnl"},
        "execution_rank": {"efficiency_percentile": "avg_trade_efficiency"},
    }
    rows = cut_lineage(scored.withColumn("__row", F.monotonically_increasing_id()))
    ranked = rows
    for name, order in orders.items():
        narrow = rows.select("__row", "wallet_address", "token_address", *sorted_by[name])
        placed = global_position(narrow, order, name, percent=percentiles.get(name))
        ranked = ranked.join(placed.select("__row", name, *percentiles.get(name, {})), "__row")
    new = [*orders, *[share for shares in percentiles.values() for share in shares]]
    return ranked.select(*scored.columns, *new)


def wallet_summary(scored: DataFrame) -> DataFrame:
    """Figures per wallet over its ranked positions."""
    return scored.groupBy("wallet_address").agg(
        F.count(F.lit(1)).alias("tokens_traded"),
        F.sum("total_pnl").alias("total_portfolio_pnl"),
        F.avg("enhanced_smart_trader_score").alias("avg_smart_trader_score"),
        F.max("enhanced_smart_trader_score").alias("best_token_score"),
        F.count_if(F.col("total_pnl") > 0).alias("profitable_tokens"),
        F.count_if(F.col("total_pnl") < 0).alias("losing_tokens"),
        F.avg("pnl_quality_score").alias("avg_portfolio_quality"),
        F.avg("avg_trade_efficiency").alias("avg_portfolio_efficiency"),
        F.avg("avg_timing_score").alias("avg_portfolio_timing"),
        F.max_by("token_address", F.struct("total_pnl", "token_address")).alias("best_performing_token"),
        F.max("total_pnl").alias("best_token_pnl"),
    )


def enhanced_traders(positions: DataFrame) -> DataFrame:
    """Ranked positions with the summary of their wallet."""
    scored = cut_lineage(scored_positions(positions))
    summary = wallet_summary(scored)
    return ranked_positions(scored).join(cut_lineage(summary), "wallet_address", "left")


def qualification_counts(portfolios: DataFrame) -> DataFrame:
    return portfolios.groupBy(M.qualification_bucket().alias("qualification_tier")).agg(
        F.count(F.lit(1)).alias("wallet_count"),
        F.avg("total_pnl").alias("avg_pnl"),
        F.avg("roi").alias("avg_roi"),
        F.avg("win_rate").alias("avg_win_rate"),
        F.avg("trade_count").alias("avg_trades"),
    )


def pnl_profile(portfolios: DataFrame) -> DataFrame:
    """Overall figures of a wallet result table, with the share of zero results."""
    zero = F.col("total_pnl") == 0
    return portfolios.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("wallet_address").alias("wallets"),
        F.count_if(zero).alias("zero_pnl"),
        F.round(F.try_divide(F.count_if(zero) * 100.0, F.count(F.lit(1))), 2).alias("zero_pnl_pct"),
        F.count_if(F.col("total_pnl") > 0).alias("profitable"),
        F.min("total_pnl").alias("min_pnl"),
        F.max("total_pnl").alias("max_pnl"),
        F.avg("total_pnl").alias("avg_pnl"),
        F.count_if(F.col("total_pnl").isNull()).alias("null_pnl"),
    )

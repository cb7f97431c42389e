"""Column expressions of the trading domain: values, sides, tiers and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import settings as S


# --- building blocks -----------------------------------------------------------


def at_least(floors: Mapping[str, float]) -> Column:
    """All named columns reach their floor."""
    return reduce(lambda a, b: a & b, [F.col(name) >= floor for name, floor in floors.items()])


def first_label(rules: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """Label of the first rule that holds."""
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rules, F)
    return chain.otherwise(F.lit(otherwise))


def band(value: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the highest band whose lower bound ``value`` reaches."""
    return first_label([(value >= bound, label) for bound, label in bands], rest)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``; null unless ``bottom`` is positive."""
    return F.when(bottom > 0, F.try_divide(top, bottom))


def percent(top: Column, bottom: Column) -> Column:
    """``top / bottom * 100``; 0 unless ``bottom`` is positive."""
    return F.coalesce(ratio(top, bottom) * 100, F.lit(0.0))


# --- trades --------------------------------------------------------------------


def usd_value(base_amount: Column, base_price: Column, quote_amount: Column, quote_price: Column) -> Column:
    """Value by the base leg, by the quote leg where the base has no price, else null."""
    legs = [
        F.when(price > 0, F.abs(amount) * price)
        for amount, price in ((base_amount, base_price), (quote_amount, quote_price))
    ]
    return F.coalesce(*legs)


def leg_value(amount: Column, price: Column) -> Column:
    """Value of one leg, 0 without a price."""
    return F.abs(amount) * F.coalesce(price, F.lit(0.0))


def side_by_direction(direction: Column) -> Column:
    return first_label([(direction == "to", "BUY"), (direction == "from", "SELL")], "SWAP")


def side_by_reference(from_token: Column, to_token: Column, reference: str = S.REFERENCE_MINT) -> Column:
    return first_label([(from_token == reference, "BUY"), (to_token == reference, "SELL")], "SWAP")


def side_by_sign(amount: Column) -> Column:
    return first_label([(amount > 0, "BUY_BASE"), (amount < 0, "SELL_BASE")], "NEUTRAL")


def trade_event_type(arbitrage: Column, size_tier: Column, side: Column) -> Column:
    """Event name for a trade; special conditions come before the trade side."""
    rules = [
        (arbitrage, "ARBITRAGE_ALERT"),
        (size_tier == "WHALE", "WHALE_ALERT"),
        (side == "BUY", "TOKEN_PURCHASE"),
        (side == "SELL", "TOKEN_SALE"),
    ]
    return first_label(rules, "ACCOUNT_UPDATE")


# --- tokens and holders ----------------------------------------------------------


def liquidity_tier(liquidity: Column) -> Column:
    return band(liquidity, S.LIQUIDITY_BANDS, S.LIQUIDITY_REST)


def holder_tier(amount: Column) -> Column:
    return band(amount, S.HOLDER_BANDS, S.HOLDER_REST)


def rank_tier(rank: Column) -> Column:
    return first_label([(rank <= bound, label) for bound, label in S.RANK_BANDS], S.RANK_REST)


def token_quality_score(change_24h: Column, volume_share: Column, liquidity: Column) -> Column:
    """Weighted momentum, activity and depth, each capped at 1.

    ``least`` skips nulls, so a token without market cap gets the full activity part.
    """
    parts = ((change_24h / 100, 0.4), (volume_share * 10, 0.3), (liquidity / 100_000, 0.3))
    return F.round(sum((F.least(x, F.lit(1.0)) * weight for x, weight in parts), F.lit(0.0)), 3)


def fetch_state(fetched: Column, status: Column) -> Column:
    return first_label([(fetched, "completed"), (status == "pending", "pending")], "ready")


# --- traders ---------------------------------------------------------------------


def gold_tier() -> Column:
    """Tier by profit, return and win rate together."""
    rules = [(at_least(floors), label) for label, floors in S.GOLD_TIER_FLOORS]
    rules.append(((F.col("total_pnl") > 0) | (F.col("win_rate") > 0), "QUALIFIED"))
    return first_label(rules, "UNQUALIFIED")


def simple_tier() -> Column:
    """Tier by profit and win rate, strict bounds."""
    pnl, wins = F.col("total_pnl"), F.col("win_rate")
    rules = [
        ((pnl > 1000) & (wins > 50), "ELITE"),
        ((pnl > 100) & (wins > 30), "STRONG"),
        ((pnl > 0) | (wins > 0), "QUALIFIED"),
    ]
    return first_label(rules, "UNQUALIFIED")


def top_tier() -> Column:
    """Tier of traders that passed the base gate."""
    return first_label([(at_least(floors), label) for label, floors in S.TOP_TIER_FLOORS], "promising")


def token_trader_tier() -> Column:
    """Tier of one wallet-token position."""
    winning = (F.col("total_pnl") > 0) & (F.col("roi") > 0)
    wins, trades = F.col("win_rate"), F.col("total_trades")
    steady = (F.col("total_pnl") >= 0) & (F.col("avg_trade_efficiency") >= 0.8) & (trades >= 1)
    rules = [
        (winning & (wins > 0.5) & (trades >= 5), "ELITE"),
        (winning & (wins > 0.3) & (trades >= 3), "STRONG"),
        (steady, "PROMISING"),
    ]
    return first_label(rules, "DEVELOPING")


def execution_tier() -> Column:
    return first_label([(at_least(f), label) for label, f in S.EXECUTION_FLOORS], "IMPROVING_EXECUTION")


def portfolio_size_tier(value: Column) -> Column:
    return band(value, S.PORTFOLIO_BANDS, S.PORTFOLIO_REST)


def qualification_bucket() -> Column:
    rules = [(at_least(floors), label) for label, floors in S.QUALIFICATION_FLOORS]
    rules.append((F.col("total_pnl") > 0, "positive_only"))
    return first_label(rules, "negative_pnl")


def _gain(value: Column, cap: float | None = None) -> Column:
    """Positive part of ``value``, optionally capped."""
    capped = value if cap is None else F.least(value, F.lit(float(cap)))
    return F.when(value > 0, capped).otherwise(0.0)


def gold_score() -> Column:
    """Weighted profit, return, win rate and activity; activity is not floored at 0."""
    score = (
        _gain(F.col("total_pnl") / 1000, 100) * 0.4
        + _gain(F.col("portfolio_roi"), 100) * 0.3
        + _gain(F.col("win_rate")) * 0.2
        + F.least(F.col("trade_count"), F.lit(10)) * 0.1
    )
    return F.round(score, 2)


def token_trader_score() -> Column:
    """Profit share up to 1, execution, timing and a step for the number of trades."""
    trades = F.col("total_trades")
    activity = F.when(trades >= 10, 0.1).when(trades >= 5, 0.07).when(trades >= 3, 0.05).otherwise(0.02)
    score = (
        F.least(F.col("total_pnl") / 1000, F.lit(1.0)) * 0.4
        + F.coalesce(F.col("avg_trade_efficiency"), F.lit(0.5)) * 0.3
        + F.coalesce(F.col("avg_timing_score"), F.lit(0.5)) * 0.2
        + activity
    )
    return F.round(score, 3)


def consistency_score() -> Column:
    return F.round(F.col("roi") * F.col("win_rate") / 10_000, 2)


def risk_score() -> Column:
    calm = F.round(F.try_divide(F.lit(100.0), F.col("trade_frequency_daily") + 1), 2)
    return F.when(F.col("avg_holding_time_hours") > 0, calm).otherwise(50.0)


def profit_factor() -> Column:
    return F.round(percent(F.col("total_pnl"), F.col("total_bought")), 2)


def days_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first)


def pnl_quality_score() -> Column:
    trades, skill, roi = F.col("total_trades"), F.col("avg_trade_efficiency"), F.col("roi")
    return (
        F.when((trades >= 10) & (skill >= 0.8) & (roi > 0.1), 0.95)
        .when((trades >= 5) & (skill >= 0.7) & (roi > 0.05), 0.85)
        .when((trades >= 3) & (roi > 0), 0.75)
        .otherwise(0.60)
    )


def tier_priority(tier: Column) -> Column:
    """Sort key that puts the best tier first."""
    return first_label([(tier == label, place) for place, label in enumerate(S.TIER_ORDER)], len(S.TIER_ORDER))

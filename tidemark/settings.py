"""Thresholds and labels.  All numbers and names here are fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass

# --- bands: (lower bound, label), highest first ---------------------------------
LIQUIDITY_BANDS = ((1_000_000, "HIGH"), (500_000, "MEDIUM"), (100_000, "LOW"))
LIQUIDITY_REST = "MINIMAL"
HOLDER_BANDS = ((1_000_000, "MEGA"), (100_000, "LARGE"), (10_000, "MEDIUM"), (1_000, "SMALL"))
HOLDER_REST = "MINIMAL"
RANK_BANDS = ((3, "TOP_3"), (10, "TOP_10"), (50, "TOP_50"))
RANK_REST = "OTHER"
PORTFOLIO_BANDS = ((100_000, "LARGE_PORTFOLIO"), (10_000, "MEDIUM_PORTFOLIO"), (1_000, "SMALL_PORTFOLIO"))
PORTFOLIO_REST = "MICRO_PORTFOLIO"
EVENT_SIZE_BANDS = ((100_000, "WHALE_EVENT"), (10_000, "LARGE_EVENT"), (1_000, "MEDIUM_EVENT"))

# --- trader tiers: label -> inclusive floors ------------------------------------
GOLD_TIER_FLOORS = (
    ("ELITE", {"total_pnl": 10_000, "portfolio_roi": 50, "win_rate": 30}),
    ("STRONG", {"total_pnl": 1_000, "portfolio_roi": 20, "win_rate": 20}),
    ("PROMISING", {"total_pnl": 100, "portfolio_roi": 10, "win_rate": 10}),
)
TOP_TIER_FLOORS = (
    ("elite", {"total_pnl": 1_000, "roi": 30, "win_rate": 60, "trade_count": 10}),
    ("strong", {"total_pnl": 100, "roi": 15, "win_rate": 40, "trade_count": 5}),
)
TOP_GATE = {"total_pnl": 10.0, "roi": 1.0, "win_rate": 40.0, "trade_count": 10}
TOP_TRADERS_KEPT = 100
QUALIFICATION_FLOORS = (
    ("current_criteria", {"total_pnl": 1_000, "roi": 20, "win_rate": 60, "trade_count": 10}),
    ("relaxed_criteria", {"total_pnl": 500, "roi": 15, "win_rate": 55, "trade_count": 5}),
)
EXECUTION_FLOORS = (
    ("EXCELLENT_EXECUTION", {"avg_trade_efficiency": 0.9, "avg_timing_score": 0.8}),
    ("GOOD_EXECUTION", {"avg_trade_efficiency": 0.8, "avg_timing_score": 0.7}),
    ("AVERAGE_EXECUTION", {"avg_trade_efficiency": 0.7, "avg_timing_score": 0.6}),
)
TIER_ORDER = ("ELITE", "STRONG", "QUALIFIED")

# --- portfolio, lookback and selection ------------------------------------------
PORTFOLIO_TOKEN = "ALL_TOKENS"
LOOKBACK_DAYS = {"week": 7, "month": 30, "quarter": 90}
RECENT_DAYS = 7
RECENT_TOPUP_ROWS = 100
TOKEN_REFETCH_DAYS = 3
TRADE_REFETCH_DAYS = 30
RESULT_REFETCH_DAYS = 30
# Status column, time of the last run and days between runs of each stage.
REFETCH_STAGES = {
    "holders": ("whale_fetch_status", "whale_fetched_at", TOKEN_REFETCH_DAYS),
    "trades": ("txns_fetch_status", "txns_last_fetched_at", TRADE_REFETCH_DAYS),
    "results": ("pnl_processing_status", "pnl_last_processed_at", RESULT_REFETCH_DAYS),
}

# --- swap payloads ----------------------------------------------------------------
REFERENCE_MINT = "So11111111111111111111111111111111111111112"
STABLE_MINTS = (
    "EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v",
    "Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB",
)
KNOWN_SYMBOLS = {
    "So11111111111111111111111111111111111111112": "SOL",
    "EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v": "USDC",
    "Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB": "USDT",
    "HnNLd1tG4XgH9YkahSkud68ew6vrryh7eZFkusyzcHgN": "WIF",
    "BGywaqWmaTbRitLmNVsGXGY2sd5XEP6oqrUD9nA8MYet": "bonk",
    "4vBiGz4ymPXkhvRBQopSB87zwTA76sUsSAo9JpqkJG1y": "TREMP",
}
MEME_SUFFIX = "pump"
MEME_SOURCES = ("PUMP_AMM", "PUMP_FUN")
LARGE_SWAP_UNITS = 10
WHALE_TRADER_UNITS = 50

# --- event categories and limits ----------------------------------------------------
EVENT_KEYWORDS = (
    ("swap", ("swap", "exchange", "trade", "dex")),
    ("transfer", ("transfer", "send", "receive")),
    ("defi", ("stake", "unstake", "lend", "borrow", "liquidity")),
)
SUPPORTED_TYPES = ("SWAP", "TRANSFER", "UNKNOWN")
SIGNATURE_LENGTH = 88
MIN_SIGNATURE_LENGTH = 64
MIN_ADDRESS_LENGTH = 32
AMOUNT_LIMITS = (0.000001, 1_000_000_000)
MIN_SUCCESS_RATE = 0.95
VENUES = ("Raydium", "Orca", "Jupiter", "Serum", "Saber")
VENUE_MIN_DAILY_VOLUME = 1_000_000
TRENDING = {"min_volume": 100_000, "min_trades": 100, "top": 50}
WHALE_TRADE_FLOOR = 10_000
WHALE_TRADES_KEPT = 100
ALERTS = {"volume_multiple": 3.0, "price_change_percent": 20.0, "whale_trade": 50_000}

# --- text of keys -------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

# --- storage age --------------------------------------------------------------------
AGE_BANDS = ((7, "up_to_7_days"), (30, "up_to_30_days"), (90, "up_to_90_days"), (365, "up_to_365_days"))
AGE_REST = "over_365_days"
RETENTION = {
    "bronze": {"compress": 7, "archive": 14, "delete": 30},
    "silver": {"compress": 14, "archive": 30, "delete": 90},
    "gold": {"compress": 30, "archive": 180, "delete": 365},
}


@dataclass(frozen=True)
class TokenScreen:
    """Pick of tokens to follow from a raw token list."""

    min_liquidity: float = 1_000_000
    max_liquidity: float = 3_000_000
    min_volume_1h: float = 100_000
    min_change_2h: float = 0
    min_change_24h: float = 30
    keep: int = 50


@dataclass(frozen=True)
class MomentumFilter:
    """Wide quality filter on the token table."""

    min_liquidity: float = 10_000
    min_volume_24h: float = 50_000
    min_change_24h: float = 30
    min_volume_share: float = 0.05
    keep_per_date: int = 50


@dataclass(frozen=True)
class LenientFilter:
    """Lenient quality filter on the token table."""

    min_liquidity: float = 1_000
    min_volume_share: float = 0.001
    keep: int = 50

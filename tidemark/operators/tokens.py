"""Token and holder tables: screens, tracked rows, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import market as M
from tidemark.operators.ordered import keep_latest, top_n, top_n_per_group
from tidemark.settings import LenientFilter, MomentumFilter, TokenScreen

_SPANS = ("1h", "2h", "4h", "8h", "24h")


def _volume_share():
    return M.ratio(F.col("volume_24h_usd"), F.col("market_cap"))


def screened_tokens(tokens: DataFrame, rules: TokenScreen = TokenScreen()) -> DataFrame:
    """The most liquid tokens within the liquidity, volume and momentum bounds."""
    kept = tokens.filter(
        F.col("liquidity").between(rules.min_liquidity, rules.max_liquidity)
        & (F.col("volume_1h_usd") >= rules.min_volume_1h)
        & (F.col("price_change_2h_percent") >= rules.min_change_2h)
        & (F.col("price_change_24h_percent") >= rules.min_change_24h)
    )
    return top_n(kept, [F.desc("liquidity"), F.asc("token_address")], rules.keep)


def latest_tokens(tokens: DataFrame) -> DataFrame:
    """Newest ingest of every token."""
    known = tokens.filter(F.col("token_address").isNotNull())
    return keep_latest(known, ["token_address"], [F.desc("processing_date"), F.desc("ingest")])


def momentum_tokens(tokens: DataFrame, rules: MomentumFilter = MomentumFilter()) -> DataFrame:
    """Tokens with a logo, enough depth and volume and rising prices; the most liquid per date."""
    rising = F.lit(True)
    for span in _SPANS:
        rising = rising & (F.col(f"price_change_{span}_percent") > 0)
    share = _volume_share()
    kept = tokens.filter(
        (F.col("logo_uri") != "")
        & (F.col("liquidity") >= rules.min_liquidity)
        & (F.col("volume_24h_usd") >= rules.min_volume_24h)
        & (F.col("price_change_24h_percent") >= rules.min_change_24h)
        & rising
        & (share.isNull() | (share >= rules.min_volume_share))
    ).withColumn("volume_mcap_ratio", share)
    ranked = top_n_per_group(
        kept, ["processing_date"], [F.desc("liquidity"), F.asc("token_address")], rules.keep_per_date, "liquidity_rank"
    )
    score = M.token_quality_score(F.col("price_change_24h_percent"), F.col("volume_mcap_ratio"), F.col("liquidity"))
    return ranked.withColumn("quality_score", score)


def lenient_tokens(tokens: DataFrame, rules: LenientFilter = LenientFilter()) -> DataFrame:
    """Newest row per token above the low bounds, most liquid ones."""
    share = _volume_share()
    kept = latest_tokens(tokens).filter(
        (F.col("liquidity") >= rules.min_liquidity) & (share.isNull() | (share >= rules.min_volume_share))
    )
    return top_n(kept, [F.desc("liquidity"), F.asc("token_address")], rules.keep)


def tracked_tokens(tokens: DataFrame, min_liquidity: float = 100_000) -> DataFrame:
    """Unprocessed liquid tokens with tier and value per holder, newest row per token."""
    usable = tokens.filter(
        ~F.col("processed")
        & (F.col("liquidity") >= min_liquidity)
        & F.col("token_address").isNotNull()
        & F.col("symbol").isNotNull()
        & F.col("price").isNotNull()
    )
    newest = keep_latest(usable, ["token_address"], [F.desc("processing_date"), F.desc("ingest")])
    return newest.withColumns(
        {
            "liquidity_tier": M.liquidity_tier(F.col("liquidity")),
            "fdv_per_holder": F.round(M.ratio(F.col("fdv"), F.col("holder")), 2),
            "whale_fetch_status": F.lit("pending"),
            "whale_fetched_at": F.lit(None).cast("timestamp_ntz"),
            "is_newly_tracked": F.lit(True),
        }
    )


def tracked_holders(holders: DataFrame) -> DataFrame:
    """Holders with a positive holding: id, tiers and fetch state, newest row per pair."""
    usable = holders.filter(
        (F.col("ui_amount") > 0) & F.col("wallet_address").isNotNull() & F.col("token_address").isNotNull()
    )
    newest = keep_latest(usable, ["wallet_address", "token_address"], [F.desc("rank_date"), F.asc("rank")])
    return newest.withColumns(
        {
            "whale_id": F.concat_ws("_", "wallet_address", "token_address"),
            "whale_tier": M.holder_tier(F.col("ui_amount")),
            "rank_tier": M.rank_tier(F.col("rank")),
            "processing_status": M.fetch_state(F.col("txns_fetched"), F.col("txns_fetch_status")),
        }
    )


def with_availability(tokens: DataFrame, volumes: list[str], counts: list[str], changes: list[str]) -> DataFrame:
    """Gaps in volumes and counts filled with 0; flags tell what was there before."""

    def all_present(columns: list[str]):
        return F.array_compact(F.array(*[F.col(c).cast("double") for c in columns]))

    flagged = tokens.withColumns(
        {
            "volume_metrics_available": F.size(all_present(volumes)) == len(volumes),
            "price_change_available": F.size(all_present(changes)) == len(changes),
        }
    )
    return flagged.fillna(0, [*volumes, *counts])

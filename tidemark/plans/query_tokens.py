"""Queries on tokens and holders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import settings as S

from tidemark.operators import incremental, tokens as T
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.registry import query, rounded
from tidemark.settings import TokenScreen

_LATEST = """, latest AS (SELECT * FROM tokens QUALIFY row_number() OVER (PARTITION BY token_address ORDER BY processing_date DESC, ingest DESC) = 1)"""


@query(using("tokens") + _LATEST + "SELECT token_address, symbol, liquidity, processing_date, ingest FROM latest")
def latest_tokens(spark, sf_dir):
    return T.latest_tokens(A.tokens(spark, sf_dir)).select("token_address", "symbol", "liquidity", "processing_date", "ingest")


@query(using("tokens") + """, kept AS (SELECT *, CASE WHEN market_cap > 0 THEN volume_24h_usd / market_cap END AS volume_mcap_ratio FROM tokens
    WHERE logo_uri <> '' AND liquidity >= 10000 AND volume_24h_usd >= 50000 AND price_change_24h_percent >= 30 AND price_change_1h_percent > 0
      AND price_change_2h_percent > 0 AND price_change_4h_percent > 0 AND price_change_8h_percent > 0
      AND (market_cap IS NULL OR market_cap <= 0 OR volume_24h_usd / market_cap >= 0.05))
  SELECT token_address, processing_date, liquidity, round(volume_mcap_ratio, 6) AS volume_mcap_ratio,
         row_number() OVER (PARTITION BY processing_date ORDER BY liquidity DESC, token_address) AS liquidity_rank,
         round(least(price_change_24h_percent / 100, 1) * 0.4 + least(volume_mcap_ratio * 10, 1) * 0.3 + least(liquidity / 100000, 1) * 0.3, 3) AS quality_score
  FROM kept QUALIFY liquidity_rank <= 50""")
def momentum_tokens(spark, sf_dir):
    kept = T.momentum_tokens(A.tokens(spark, sf_dir))
    columns = ["token_address", "processing_date", "liquidity", "volume_mcap_ratio", F.col("liquidity_rank").cast("bigint"), "quality_score"]
    return rounded(kept.select(*columns), 6, "volume_mcap_ratio")


@query(using("tokens") + _LATEST + """SELECT token_address, liquidity FROM latest
    WHERE liquidity >= 1000 AND (market_cap IS NULL OR market_cap <= 0 OR volume_24h_usd / market_cap >= 0.001) ORDER BY liquidity DESC, token_address LIMIT 50""")
def lenient_tokens(spark, sf_dir):
    return T.lenient_tokens(A.tokens(spark, sf_dir)).select("token_address", "liquidity")


_TRACKED = """, usable AS (SELECT * FROM tokens WHERE NOT processed AND liquidity >= 100000 AND symbol IS NOT NULL AND price IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY token_address ORDER BY processing_date DESC, ingest DESC) = 1),
  tracked AS (SELECT token_address, symbol, liquidity, processing_date, CASE WHEN liquidity >= 1000000 THEN 'HIGH' WHEN liquidity >= 500000 THEN 'MEDIUM' ELSE 'LOW' END AS liquidity_tier,
         CASE WHEN holder > 0 THEN round(fdv / holder, 2) END AS fdv_per_holder, 'pending' AS whale_fetch_status, true AS is_newly_tracked FROM usable)
"""


def tracked(spark, sf_dir):
    return T.tracked_tokens(A.tokens(spark, sf_dir)).select(
        "token_address", "symbol", "liquidity", "processing_date", "liquidity_tier", "fdv_per_holder", "whale_fetch_status", "is_newly_tracked"
    )


@query(using("tokens") + _TRACKED + "SELECT * FROM tracked")
def tracked_tokens(spark, sf_dir):
    return tracked(spark, sf_dir)


@query(using("tokens") + """SELECT token_address, liquidity, ingest, row_number() OVER (ORDER BY liquidity DESC, token_address) AS row_rank FROM tokens
    WHERE liquidity BETWEEN 200000 AND 3000000 AND volume_1h_usd >= 50000 AND price_change_2h_percent >= 0 AND price_change_24h_percent >= 30
    QUALIFY row_rank <= 40""")
def screened_tokens(spark, sf_dir):
    rules = TokenScreen(min_liquidity=200_000, min_volume_1h=50_000, keep=40)
    picked = T.screened_tokens(A.tokens(spark, sf_dir).filter("token_address is not null"), rules)
    return picked.select("token_address", "liquidity", "ingest", F.col("row_rank").cast("bigint").alias("row_rank"))


@query(using("holders") + """, newest AS (SELECT * FROM holders WHERE ui_amount > 0
    QUALIFY row_number() OVER (PARTITION BY wallet_address, token_address ORDER BY rank_date DESC, rank) = 1)
  SELECT *, wallet_address || '_' || token_address AS whale_id,
         CASE WHEN ui_amount >= 1000000 THEN 'MEGA' WHEN ui_amount >= 100000 THEN 'LARGE' WHEN ui_amount >= 10000 THEN 'MEDIUM'
              WHEN ui_amount >= 1000 THEN 'SMALL' ELSE 'MINIMAL' END AS whale_tier,
         CASE WHEN rank <= 3 THEN 'TOP_3' WHEN rank <= 10 THEN 'TOP_10' WHEN rank <= 50 THEN 'TOP_50' ELSE 'OTHER' END AS rank_tier,
         CASE WHEN txns_fetched THEN 'completed' WHEN txns_fetch_status = 'pending' THEN 'pending' ELSE 'ready' END AS processing_status FROM newest""")
def tracked_holders(spark, sf_dir):
    return T.tracked_holders(A.holders(spark, sf_dir))


@query(using("tokens") + """SELECT token_address, ingest, coalesce(volume_1h_usd, 0) AS volume_1h_usd, volume_24h_usd, coalesce(trade_24h_count, 0) AS trade_24h_count,
         volume_1h_usd IS NOT NULL AS volume_metrics_available, price_change_1h_percent IS NOT NULL AS price_change_available FROM tokens""")
def token_availability(spark, sf_dir):
    filled = T.with_availability(
        A.tokens(spark, sf_dir), ["volume_1h_usd", "volume_24h_usd"], ["trade_24h_count"], ["price_change_1h_percent", "price_change_24h_percent"]
    )
    return filled.select(
        "token_address", "ingest", "volume_1h_usd", "volume_24h_usd", "trade_24h_count", "volume_metrics_available", "price_change_available"
    )


@query(using("holders") + """, aged AS (SELECT wallet_address, token_address, rank, txns_fetch_status AS status,
         rank_date - CAST(rank AS INTEGER) AS fetched_on FROM holders)
  SELECT wallet_address, token_address, status, fetched_on FROM aged WHERE status = 'pending' OR DATE '2024-01-10' - fetched_on >= 30""")
def holders_due_for_refetch(spark, sf_dir):
    aged = A.holders(spark, sf_dir).select(
        "wallet_address", "token_address", F.col("txns_fetch_status").alias("status"),
        F.date_sub("rank_date", F.col("rank").cast("int")).alias("fetched_on"),
    )
    return incremental.due_for_refetch(aged, "status", "fetched_on", F.lit("2024-01-10").cast("date"), 30)


def _refetch_sql(days: int) -> str:
    return using("holders") + f""", aged AS (SELECT wallet_address || token_address || rank_date AS id, txns_fetch_status AS status,
         CASE WHEN rank % 3 > 0 THEN rank_date - CAST(rank AS INTEGER) END AS fetched_on FROM holders)
  SELECT id, status, fetched_on FROM aged WHERE status = 'pending' OR DATE '2024-01-10' - fetched_on >= {days}
  ORDER BY fetched_on NULLS FIRST, id LIMIT 40"""


def _refetch(spark, sf_dir, stage):
    status, fetched_at, _ = S.REFETCH_STAGES[stage]
    rows = A.holders(spark, sf_dir).select(
        F.concat("wallet_address", "token_address", F.col("rank_date").cast("string")).alias("id"),
        F.col("txns_fetch_status").alias(status),
        F.when(F.col("rank") % 3 > 0, F.date_sub("rank_date", F.col("rank").cast("int"))).alias(fetched_at),
    )
    due = incremental.next_for_refetch(rows, stage, "id", F.lit("2024-01-10").cast("date"), 40)
    return due.select("id", F.col(status).alias("status"), F.col(fetched_at).alias("fetched_on"))


@query(_refetch_sql(3))
def next_holders_to_fetch(spark, sf_dir):
    return _refetch(spark, sf_dir, "holders")


@query(_refetch_sql(30))
def next_trades_to_fetch(spark, sf_dir):
    return _refetch(spark, sf_dir, "trades")


@query(_refetch_sql(30))
def next_results_to_fetch(spark, sf_dir):
    return _refetch(spark, sf_dir, "results")


@query(using("holders") + """SELECT CASE WHEN ui_amount >= 1000000 THEN 'MEGA' WHEN ui_amount >= 100000 THEN 'LARGE' WHEN ui_amount >= 10000 THEN 'MEDIUM'
              WHEN ui_amount >= 1000 THEN 'SMALL' ELSE 'MINIMAL' END AS whale_tier, count(*) AS n, count(DISTINCT wallet_address) AS wallets,
         count(DISTINCT token_address) AS tokens, min(ui_amount) AS least, max(ui_amount) AS greatest, round(avg(ui_amount), 4) AS mean
    FROM holders GROUP BY 1""")
def holder_tier_profile(spark, sf_dir):
    from tidemark.functions.market import holder_tier

    profile = A.holders(spark, sf_dir).groupBy(holder_tier(F.col("ui_amount")).alias("whale_tier")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("wallet_address").alias("wallets"), F.count_distinct("token_address").alias("tokens"),
        F.min("ui_amount").alias("least"), F.max("ui_amount").alias("greatest"), F.avg("ui_amount").alias("mean"),
    )
    return rounded(profile, 4, "mean")

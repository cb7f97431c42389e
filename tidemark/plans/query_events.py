"""Queries on messages, event records and swap notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import market as M
from tidemark.functions import scalars as C
from tidemark.operators import events as E
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_pnl import trades
from tidemark.plans.registry import query, rounded


def silver(spark, sf_dir):
    return E.silver_events(A.messages(spark, sf_dir))


def pairs(spark, sf_dir):
    return E.swap_pairs(A.payloads(spark, sf_dir))


def enriched(spark, sf_dir):
    return E.enriched_alerts(A.alerts(spark, sf_dir))


# --- messages -------------------------------------------------------------------------


@query(using("last_messages") + "SELECT message_id, payload, processed_at, delivery FROM last_messages")
def latest_messages(spark, sf_dir):
    return E.latest_messages(A.messages(spark, sf_dir)).select("message_id", "payload", "processed_at", "delivery")


@query(using("silver_events") + "SELECT * FROM silver_events")
def silver_events(spark, sf_dir):
    return silver(spark, sf_dir)


@query(using("silver_events") + """SELECT message_id, event_timestamp, event_type, json_extract_string(payload_json, '$.transactionType') AS transaction_type,
        json_extract_string(payload_json, '$.transactionAmount') AS transaction_amount, json_extract_string(payload_json, '$.tokenA') AS token_a,
        json_extract_string(payload_json, '$.tokenB') AS token_b, json_extract_string(payload_json, '$.accountKeys') AS account_keys,
        json_extract_string(payload_json, '$.signature') AS transaction_signature, json_extract_string(payload_json, '$.fee') AS transaction_fee, processing_date
    FROM silver_events WHERE event_type IN ('solana_swap', 'solana_transaction')""")
def transaction_details(spark, sf_dir):
    return E.transaction_details(silver(spark, sf_dir))


_QUALITY = """SELECT processing_date, count(*) AS total_events, count(*) FILTER (WHERE has_valid_json) AS valid_json_events,
        count(*) FILTER (WHERE has_source_ip) AS events_with_source_ip, count(event_timestamp) AS events_with_valid_timestamp,
        count(*) FILTER (WHERE event_type = 'unknown') AS unknown_event_types, count(DISTINCT message_id) AS unique_message_ids,
        round(count(*) FILTER (WHERE has_valid_json) * 100 / count(*), 2) AS json_validity_pct,
        round(count(event_timestamp) * 100 / count(*), 2) AS timestamp_validity_pct,
        round(count(*) FILTER (WHERE event_type <> 'unknown') * 100 / count(*), 2) AS categorization_pct,
        count(*) FILTER (WHERE event_type = 'solana_swap') AS solana_swap_count, count(*) FILTER (WHERE event_type = 'solana_transaction') AS solana_transaction_count,
        count(*) FILTER (WHERE event_type = 'test_event') AS test_event_count, min(processed_at) AS first_processed, max(processed_at) AS last_processed
    FROM silver_events GROUP BY processing_date"""


@query(using("silver_events") + _QUALITY)
def quality_by_date(spark, sf_dir):
    return E.quality_by_date(silver(spark, sf_dir))


@query(using("messages") + """SELECT message_id, delivery, json_valid(payload) AS valid,
        CASE WHEN NOT json_valid(payload) THEN 'invalid_json' WHEN json_extract_string(payload, '$.transactionType') = 'SWAP' THEN 'solana_swap'
             WHEN json_extract_string(payload, '$.transaction') IS NOT NULL THEN 'solana_transaction' ELSE 'unknown' END AS kind,
        CASE WHEN json_valid(payload) THEN CAST(TRY_CAST(json_extract_string(payload, '$.transactionAmount') AS DECIMAL(18,3)) AS DOUBLE) END AS amount,
        CASE WHEN json_valid(payload) THEN coalesce(length(json_extract_string(payload, '$.signature')) = 88, false) ELSE false END AS signed FROM messages""")
def payload_kinds(spark, sf_dir):
    parsed = F.col("parsed")
    return A.messages(spark, sf_dir).withColumn("parsed", C.parsed_json(F.col("payload"))).select(
        "message_id", "delivery", parsed.isNotNull().alias("valid"), C.payload_kind(parsed).alias("kind"),
        C.json_decimal(parsed, "$.transactionAmount").cast("double").alias("amount"),
        C.is_signature(C.json_text(parsed, "$.signature")).alias("signed"),
    )


@query(using("payload_parts") + """SELECT CAST(event_id AS VARCHAR) AS message_id, CASE WHEN listed THEN 'sig' || event_id END AS signature,
        CASE WHEN listed THEN kind ELSE 'UNKNOWN' END AS type, CASE WHEN listed THEN trader END AS account, CASE WHEN listed THEN from_mint END AS mint
    FROM (SELECT *, state = 'valid' AND k % 2 = 0 AS listed FROM payload_parts)""")
def first_event_fields(spark, sf_dir):
    return A.payloads(spark, sf_dir).select("message_id", C.first_event_fields(F.col("payload")).alias("f")).select("message_id", "f.*")


@query(using("payload_parts") + """SELECT count(*) AS sample_size, count(*) FILTER (WHERE state = 'valid') AS valid_records,
        count(*) FILTER (WHERE state = 'missing') AS missing_payload, count(*) FILTER (WHERE state = 'parse_error') AS parse_errors,
        count(*) FILTER (WHERE state = 'empty') AS empty_transactions, count(*) FILTER (WHERE state = 'valid') / count(*) AS success_rate FROM payload_parts""")
def payload_quality(spark, sf_dir):
    return E.payload_quality(A.payloads(spark, sf_dir))


@query(using("payload_parts") + """, valid AS (SELECT * FROM payload_parts WHERE state = 'valid'), lines AS (
    SELECT 'type' AS kind, kind AS value FROM valid UNION ALL SELECT 'source', venue FROM valid
    UNION ALL SELECT 'mint', from_mint FROM valid UNION ALL SELECT 'mint', to_mint FROM valid WHERE NOT single UNION ALL SELECT 'mint', from_mint FROM valid
    UNION ALL SELECT 'address', trader FROM valid UNION ALL SELECT 'address', 'POOL' FROM valid
    UNION ALL SELECT 'address', 'POOL' FROM valid WHERE NOT single UNION ALL SELECT 'address', trader FROM valid WHERE NOT single
    UNION ALL SELECT 'address', trader FROM valid
    UNION ALL SELECT 'swapped', from_mint FROM valid WHERE kind = 'SWAP')
  SELECT kind, value, count(*) AS occurrences FROM lines GROUP BY ALL""")
def payload_profile(spark, sf_dir):
    return E.payload_profile(A.payloads(spark, sf_dir))


# --- event records -------------------------------------------------------------------------


@query(using("enriched_alerts") + "SELECT * FROM enriched_alerts")
def enriched_alerts(spark, sf_dir):
    return enriched(spark, sf_dir)


@query(using("enriched_alerts") + """SELECT event_type, count(*) AS event_count, round(avg(event_quality_score), 9) AS avg_quality,
        count(*) FILTER (WHERE processing_status = 'PROCESSED') AS processed_count, sum(value_usd) AS total_value FROM enriched_alerts GROUP BY event_type""")
def alerts_by_type(spark, sf_dir):
    return rounded(E.alerts_by_type(enriched(spark, sf_dir)), 9, "avg_quality")


@query(using("enriched_alerts") + """SELECT event_priority, event_size_category, count(*) AS event_count, round(avg(value_usd), 4) AS avg_value
    FROM enriched_alerts GROUP BY ALL""")
def alerts_by_priority(spark, sf_dir):
    return rounded(E.alerts_by_priority(enriched(spark, sf_dir)), 4, "avg_value")


@query(using("enriched_alerts") + """SELECT count(*) AS total_events, round(avg(event_quality_score), 9) AS avg_quality_score,
        count(*) FILTER (WHERE has_complete_financial_data) AS complete_financial_data, count(*) FILTER (WHERE has_transaction_reference) AS has_tx_reference,
        count(*) FILTER (WHERE processing_status = 'PROCESSED') AS processed_successfully FROM enriched_alerts""")
def alert_summary(spark, sf_dir):
    return rounded(E.alert_summary(enriched(spark, sf_dir)), 9, "avg_quality_score")


@query("SELECT CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS event_count FROM events GROUP BY ALL")
def events_by_hour(spark, sf_dir):
    return E.events_by_hour(A.table(spark, sf_dir, "events"), "ts")


@query(using("trades") + """SELECT 'tx_' || md5(trade_id || '-' || token_address) AS message_id,
        CASE WHEN usd / quantity > 95 THEN 'ARBITRAGE_ALERT' WHEN usd >= 5000 THEN 'WHALE_ALERT' WHEN side = 'BUY' THEN 'TOKEN_PURCHASE'
             WHEN side = 'SELL' THEN 'TOKEN_SALE' ELSE 'ACCOUNT_UPDATE' END AS event_type, 'PROCESSED' AS processing_status, wallet_address, token_address,
        usd AS value_usd, trade_id AS transaction_hash FROM trades""")
def events_from_trades(spark, sf_dir):
    rows = trades(spark, sf_dir).withColumnRenamed("trade_id", "transaction_hash").withColumns(
        {"is_arbitrage": F.col("usd") / F.col("quantity") > 95, "size_tier": F.when(F.col("usd") >= 5000, "WHALE").otherwise("SMALL")}
    )
    return E.events_from_trades(rows)


# --- swaps ------------------------------------------------------------------------------------


@query(using("swap_pairs") + "SELECT * FROM swap_pairs")
def swap_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


_SOL = "'" + S.REFERENCE_MINT + "'"
_STABLE = "(" + ", ".join(f"'{m}'" for m in S.STABLE_MINTS) + ")"
_PATTERNS = f""", counted AS (SELECT count(*) AS total_swaps, count(*) FILTER (WHERE from_token = {_SOL} OR to_token = {_SOL}) AS sol_pairs,
        count(*) FILTER (WHERE from_token IN {_STABLE} OR to_token IN {_STABLE}) AS stablecoin_pairs,
        count(*) FILTER (WHERE from_token LIKE '%pump' OR to_token LIKE '%pump') AS memecoin_activity,
        count(*) FILTER (WHERE (from_token = {_SOL} AND from_amount > 10) OR (to_token = {_SOL} AND to_amount > 10)) AS large_swaps FROM swap_pairs),
  busiest AS (SELECT source AS most_active_dex, count(*) AS most_active_count FROM swap_pairs GROUP BY source ORDER BY 2 DESC, 1 DESC LIMIT 1)"""


@query(using("swap_pairs") + _PATTERNS + """SELECT *, sol_pairs / total_swaps AS sol_dominance, memecoin_activity / total_swaps AS memecoin_share,
        large_swaps / total_swaps AS large_swap_ratio, most_active_count / total_swaps AS top_dex_share FROM counted, busiest""")
def swap_patterns(spark, sf_dir):
    return E.swap_patterns(pairs(spark, sf_dir))


@query(using("swap_pairs") + _PATTERNS + """, f AS (SELECT memecoin_activity / total_swaps AS a, large_swaps / total_swaps AS b, most_active_count / total_swaps AS c FROM counted, busiest)
  SELECT 'HIGH_MEMECOIN_ACTIVITY' AS signal, a AS share, a > 0.7 AS raised FROM f UNION ALL SELECT 'WHALE_CONCENTRATION', b, b > 0.3 FROM f
  UNION ALL SELECT 'DEX_CONCENTRATION', c, c > 0.8 FROM f""")
def risk_signals(spark, sf_dir):
    return E.risk_signals(pairs(spark, sf_dir))


@query(using("swap_pairs") + """SELECT source, count(*) AS swaps, row_number() OVER (ORDER BY count(*) DESC, source) AS place,
        count(*) / (SELECT count(*) FROM swap_pairs) AS share FROM swap_pairs GROUP BY source QUALIFY place <= 3""")
def venue_ranking(spark, sf_dir):
    ranked = E.venue_ranking(pairs(spark, sf_dir))
    return ranked.withColumn("place", F.col("place").cast("bigint"))


_SIDES = f""", sides AS (SELECT *, from_token AS token FROM swap_pairs WHERE from_token IS NOT NULL UNION ALL SELECT *, to_token FROM swap_pairs WHERE from_token IS NOT NULL),
  main AS (SELECT token, source AS primary_dex FROM (SELECT token, source, count(*) AS n FROM sides GROUP BY ALL)
           QUALIFY row_number() OVER (PARTITION BY token ORDER BY n DESC, source) = 1),
  activity AS (SELECT token, count(*) AS swap_count, count(DISTINCT trader) AS unique_traders,
         sum(CASE WHEN token <> {_SOL} THEN 0 WHEN from_token = {_SOL} THEN from_amount ELSE to_amount END) AS total_volume_sol FROM sides GROUP BY token)"""


@query(using("swap_pairs") + _SIDES + f"""SELECT token, swap_count, unique_traders, total_volume_sol, primary_dex, total_volume_sol / swap_count AS avg_swap_size,
        CASE token WHEN {_SOL} THEN 'SOL' WHEN 'EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v' THEN 'USDC' ELSE left(token, 8) || '...' END AS symbol
    FROM activity JOIN main USING (token) ORDER BY swap_count DESC, total_volume_sol DESC, token LIMIT 20""")
def hot_tokens(spark, sf_dir):
    return E.hot_tokens(pairs(spark, sf_dir)).drop("place")


@query(using("swap_pairs") + f""", rows AS (SELECT *, CASE WHEN from_token = {_SOL} THEN from_amount WHEN to_token = {_SOL} THEN to_amount ELSE 0 END AS units
    FROM swap_pairs WHERE trader IS NOT NULL),
  main AS (SELECT trader, source AS preferred_dex FROM (SELECT trader, source, count(*) AS n FROM rows GROUP BY ALL)
           QUALIFY row_number() OVER (PARTITION BY trader ORDER BY n DESC, source) = 1),
  tokens AS (SELECT trader, count(DISTINCT token) AS tokens_traded FROM (SELECT trader, from_token AS token FROM rows UNION ALL SELECT trader, to_token FROM rows) GROUP BY trader)
  SELECT trader, count(*) AS swap_count, sum(units) AS total_volume, any_value(preferred_dex) AS preferred_dex, any_value(tokens_traded) AS tokens_traded,
         sum(units) > 50 AS potential_whale FROM rows JOIN main USING (trader) JOIN tokens USING (trader) GROUP BY trader
  ORDER BY swap_count DESC, total_volume DESC, trader LIMIT 10""")
def trader_activity(spark, sf_dir):
    return E.trader_activity(pairs(spark, sf_dir)).drop("place")


@query(using("meme_transfers") + f""", newest AS (SELECT mint, swap_time, row_number() OVER (PARTITION BY mint ORDER BY swap_time DESC, CAST(event_id AS VARCHAR) DESC, place DESC) AS n FROM meme_transfers),
  lists AS (SELECT mint, list(swap_time ORDER BY n) AS recent_swap_times FROM newest WHERE n <= 5 GROUP BY mint)
  SELECT mint, count(*) AS swap_count, count(DISTINCT trader) AS traders, sum(CASE WHEN mint = {_SOL} THEN amount ELSE 0 END) AS volume_sol,
         any_value(recent_swap_times) AS recent_swap_times, CASE WHEN count(*) > 10 THEN 'HIGH' WHEN count(*) >= 3 THEN 'MEDIUM' END AS alert_level
  FROM meme_transfers JOIN lists USING (mint) GROUP BY mint ORDER BY swap_count DESC, volume_sol DESC, mint LIMIT 15""")
def meme_trends(spark, sf_dir):
    return E.meme_trends(A.payloads(spark, sf_dir)).drop("place")


@query(using("meme_transfers") + f"""SELECT count(*) FILTER (WHERE on_venue AND place = 0) AS total_swaps, count(DISTINCT mint) AS unique_tokens,
        count(DISTINCT trader) FILTER (WHERE on_venue) AS unique_traders, coalesce(sum(amount) FILTER (WHERE mint = {_SOL}), 0) AS total_volume_sol FROM meme_transfers""")
def meme_venue_summary(spark, sf_dir):
    return E.meme_venue_summary(A.payloads(spark, sf_dir))


@query(using("payload_parts") + f"""SELECT DISTINCT from_mint AS mint, CASE from_mint WHEN {_SOL} THEN 'SOL' WHEN 'EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v' THEN 'USDC'
        ELSE left(from_mint, 8) || '...' END AS symbol, from_mint LIKE '%pump' AS is_meme FROM payload_parts WHERE state = 'valid' AND kind = 'SWAP' AND NOT single""")
def mint_symbols(spark, sf_dir):
    mints = pairs(spark, sf_dir).select(F.col("from_token").alias("mint")).filter("mint is not null").distinct()
    return mints.withColumns({"symbol": C.mint_symbol(F.col("mint")), "is_meme": F.col("mint").endswith(S.MEME_SUFFIX)})


# --- diagnostics ----------------------------------------------------------------------------------


def unknowns(spark, sf_dir):
    side = M.side_by_direction(F.col("base_type_swap"))
    return A.swaps(spark, sf_dir).select(
        "wallet_address", F.concat(F.lit("T"), F.col("event_id") % 5).alias("token_address"), F.col("base_address").alias("from_address"),
        F.col("quote_address").alias("to_address"), F.col("base_symbol").alias("from_symbol"), F.col("quote_symbol").alias("to_symbol"),
        "transaction_hash", F.when(side == "SWAP", "UNKNOWN").otherwise(side).alias("transaction_type"),
    )


@query(using("unknowns") + """SELECT count(*) AS total_unknown, count(*) FILTER (WHERE from_address = token_address) AS from_matches_target,
        count(*) FILTER (WHERE to_address = token_address) AS to_matches_target,
        count(*) FILTER (WHERE from_address <> token_address AND to_address <> token_address) AS neither_matches FROM unknowns WHERE transaction_type = 'UNKNOWN'""")
def unknown_match_counts(spark, sf_dir):
    return E.unknown_match_counts(unknowns(spark, sf_dir))


@query(using("unknowns") + """SELECT from_symbol, to_symbol, count(*) AS n FROM unknowns WHERE transaction_type = 'UNKNOWN' GROUP BY ALL
    ORDER BY n DESC, from_symbol NULLS LAST, to_symbol NULLS LAST LIMIT 10""")
def unknown_pairs(spark, sf_dir):
    return E.unknown_pairs(unknowns(spark, sf_dir)).drop("place")


@query(using("unknowns") + """, sides AS (SELECT from_symbol AS symbol, from_address AS address FROM unknowns WHERE transaction_type = 'UNKNOWN'
    UNION ALL SELECT to_symbol, to_address FROM unknowns WHERE transaction_type = 'UNKNOWN')
  SELECT symbol, address, count(*) AS occurrences FROM sides GROUP BY ALL ORDER BY occurrences DESC, symbol NULLS LAST, address LIMIT 10""")
def unknown_tokens(spark, sf_dir):
    return E.unknown_tokens(unknowns(spark, sf_dir)).drop("place")


@query(using("unknowns") + """SELECT transaction_hash, wallet_address, token_address FROM unknowns u WHERE transaction_type = 'UNKNOWN' AND EXISTS (
    SELECT 1 FROM unknowns o WHERE o.wallet_address = u.wallet_address AND o.token_address = u.token_address AND o.transaction_type <> 'UNKNOWN')""")
def unknown_with_known(spark, sf_dir):
    return E.unknown_with_known(unknowns(spark, sf_dir)).select("transaction_hash", "wallet_address", "token_address")


@query("""SELECT event_id, ts FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events)
    WHERE (pos - 1) % (n // 300) = 0 AND pos <= 300 * (n // 300)""")
def systematic_sample(spark, sf_dir):
    return E.systematic_sample(A.table(spark, sf_dir, "events"), ["ts", "event_id"], 300).select("event_id", "ts")


@query("""SELECT max(ts) AS latest, CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-03 12:00:00') >= 86400
        THEN (epoch(TIMESTAMP '2024-02-03 12:00:00') - epoch(max(ts)))::BIGINT // 86400 || ' days ago' END AS age FROM events""")
def data_freshness(spark, sf_dir):
    now = F.lit("2024-02-03 12:00:00").cast("timestamp_ntz")
    return E.freshness(A.table(spark, sf_dir, "events"), "ts", now)


# --- activity windows ------------------------------------------------------------------------------


@query(using("trades") + """, busy AS (SELECT time_bucket(INTERVAL 4 HOUR, trade_time, TIMESTAMP '1970-01-01') AS window_start, token_address, sum(usd) AS volume, count(*) AS trades
    FROM trades GROUP BY ALL HAVING sum(usd) >= 20000 AND count(*) >= 5)
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY volume DESC, token_address) AS place FROM busy QUALIFY place <= 2""")
def trending_tokens(spark, sf_dir):
    found = E.trending_tokens(trades(spark, sf_dir), "4 hours", {"min_volume": 20_000, "min_trades": 5, "top": 2})
    return found.withColumn("place", F.col("place").cast("bigint"))


@query(using("trades") + "SELECT trade_id, wallet_address, usd FROM trades WHERE usd >= 2000 ORDER BY usd DESC, trade_id LIMIT 100")
def whale_trades(spark, sf_dir):
    return E.whale_trades(trades(spark, sf_dir), floor=2000).select("trade_id", "wallet_address", "usd")


@query(using("trades") + """SELECT CAST(t.trade_time AS DATE) AS trade_date, s.source, sum(t.usd) AS volume, count(*) AS trades
    FROM trades t JOIN swaps s ON s.transaction_hash = t.trade_id GROUP BY ALL HAVING sum(t.usd) >= 100000""")
def venue_daily_volume(spark, sf_dir):
    venue = A.swaps(spark, sf_dir).select(F.col("transaction_hash").alias("trade_id"), "source")
    return E.venue_daily_volume(trades(spark, sf_dir).join(venue, "trade_id"), floor=100_000)


@query(using("trades") + """, w AS (SELECT time_bucket(INTERVAL 1 HOUR, trade_time, TIMESTAMP '1970-01-01') AS window_start, token_address, sum(usd) AS volume,
        sum(usd) / sum(quantity) AS price, max(usd) AS largest_trade FROM trades GROUP BY ALL),
  j AS (SELECT *, lag(volume) OVER t AS volume_before, lag(price) OVER t AS price_before FROM w WINDOW t AS (PARTITION BY token_address ORDER BY window_start)),
  f AS (SELECT *, coalesce(volume >= volume_before * 3, false) AS volume_spike,
        coalesce(abs((price - price_before) / price_before) * 100 >= 20, false) AS price_move, largest_trade >= 50000 AS whale_trade FROM j)
  SELECT * FROM f WHERE volume_spike OR price_move OR whale_trade""")
def activity_alerts(spark, sf_dir):
    return E.activity_alerts(trades(spark, sf_dir), "1 hour")


@query("""SELECT event_id, CASE WHEN lower(event_type || ' ' || props) SIMILAR TO '.*(swap|exchange|trade|dex).*' THEN 'swap'
        WHEN lower(event_type || ' ' || props) SIMILAR TO '.*(transfer|send|receive).*' THEN 'transfer' ELSE 'other' END AS category FROM events""")
def event_categories(spark, sf_dir):
    text = F.concat_ws(" ", "event_type", "props")
    return A.table(spark, sf_dir, "events").select("event_id", C.event_category(text).alias("category"))


@query("""SELECT lang, count(*) AS n, count(*) FILTER (WHERE regexp_matches(lower(text), 'swap|exchange|trade|dex')) AS swap_words,
        count(*) FILTER (WHERE NOT regexp_matches(lower(text), 'swap|exchange|trade|dex') AND regexp_matches(lower(text), 'transfer|send|receive')) AS transfer_words
    FROM documents GROUP BY lang""")
def document_keywords(spark, sf_dir):
    category = C.event_category(F.col("text"))
    return A.table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(category == "swap").alias("swap_words"), F.count_if(category == "transfer").alias("transfer_words")
    )


@query(using("messages") + """, parts AS (SELECT message_id, delivery, json_extract_string(payload, '$.transactionType') AS kind,
        TRY_CAST(json_extract_string(payload, '$.transactionAmount') AS DOUBLE) AS amount, json_extract_string(payload, '$.signature') AS signature
    FROM messages WHERE json_valid(payload))
  SELECT message_id, delivery, coalesce(kind IN ('SWAP','TRANSFER','UNKNOWN') AND amount BETWEEN 0.000001 AND 1000000000 AND length(signature) >= 64, false) AS valid FROM parts""")
def transaction_validity(spark, sf_dir):
    parsed = F.col("parsed")
    signature = C.json_text(parsed, "$.signature")
    rows = A.messages(spark, sf_dir).withColumn("parsed", C.parsed_json(F.col("payload")))
    return rows.select("message_id", "delivery", "parsed").filter(parsed.isNotNull()).select(
        "message_id", "delivery",
        E.valid_transaction(
            C.json_text(parsed, "$.transactionType"), C.json_text(parsed, "$.transactionAmount").try_cast("double"), signature, signature
        ).alias("valid"),
    )

"""Webhook messages and swap notifications: cleaning, quality figures and activity reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import market as M
from tidemark.functions import scalars as C
from tidemark.operators.ordered import global_position, keep_latest, top_n, top_n_per_group

# --- messages ---------------------------------------------------------------------------


def latest_messages(messages: DataFrame) -> DataFrame:
    """One row per message id, the one processed last; messages without an id are kept apart by content."""
    content = F.when(F.col("message_id").isNull(), F.sha2(F.to_json(F.struct(*messages.columns)), 256))
    keyed = messages.withColumn("__content", content)
    return keep_latest(keyed, ["message_id", "__content"], [F.desc("processed_at"), F.desc("delivery")]).drop("__content")


def silver_events(messages: DataFrame) -> DataFrame:
    """Deduplicated messages with checked time, payload fields, category and quality flags."""
    payload, parsed = F.col("payload"), F.col("__parsed")
    return latest_messages(messages).withColumn("__parsed", C.parsed_json(payload)).select(
        "message_id",
        C.iso_timestamp(F.col("webhook_timestamp")).alias("event_timestamp"),
        "source_ip",
        F.when(parsed.isNotNull(), payload).alias("payload_json"),
        *[C.json_text(parsed, f"$.{name}").alias(f"payload_{name}") for name in ("source", "test", "value")],
        C.payload_kind_by_text(payload).alias("event_type"),
        parsed.isNotNull().alias("has_valid_json"),
        F.col("source_ip").isNotNull().alias("has_source_ip"),
        "processed_at",
        "processing_date",
    )


# Output column and payload field of a transaction.
_DETAILS = {
    "transaction_type": "transactionType",
    "transaction_amount": "transactionAmount",
    "token_a": "tokenA",
    "token_b": "tokenB",
    "account_keys": "accountKeys",
    "transaction_signature": "signature",
    "transaction_fee": "fee",
}


def transaction_details(events: DataFrame) -> DataFrame:
    """Payload fields of swap and transaction events."""
    chosen = events.filter(F.col("event_type").isin("solana_swap", "solana_transaction"))
    parsed = F.from_json("payload_json", ",".join(f"`{path}` string" for path in _DETAILS.values()))
    fields = [F.col("__parsed")[path].alias(name) for name, path in _DETAILS.items()]
    return chosen.withColumn("__parsed", parsed).select("message_id", "event_timestamp", "event_type", *fields, "processing_date")


def quality_by_date(events: DataFrame) -> DataFrame:
    """Counts and percentages of well-formed events per processing date."""

    def number(test: Column) -> Column:
        return F.count_if(test)

    def share(test: Column) -> Column:
        return F.round(number(test) * 100.0 / F.count(F.lit(1)), 2)

    timed, kind = F.col("event_timestamp").isNotNull(), F.col("event_type")
    return events.groupBy("processing_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        number(F.col("has_valid_json")).alias("valid_json_events"),
        number(F.col("has_source_ip")).alias("events_with_source_ip"),
        number(timed).alias("events_with_valid_timestamp"),
        number(kind == "unknown").alias("unknown_event_types"),
        F.count_distinct("message_id").alias("unique_message_ids"),
        share(F.col("has_valid_json")).alias("json_validity_pct"),
        share(timed).alias("timestamp_validity_pct"),
        share(kind != "unknown").alias("categorization_pct"),
        *[number(kind == k).alias(f"{k}_count") for k in ("solana_swap", "solana_transaction", "test_event")],
        F.min("processed_at").alias("first_processed"),
        F.max("processed_at").alias("last_processed"),
    )


# --- typed event records ------------------------------------------------------------------


def enriched_alerts(alerts: DataFrame) -> DataFrame:
    """Deduplicated event records with priority, size, quality and completeness."""
    keyed = alerts.withColumn("__key", F.coalesce("transaction_hash", "message_id"))
    single = keep_latest(
        keyed, ["__key", "wallet_address", "token_address"], [F.desc("received_at"), F.desc("arrival")]
    )
    value, done = F.col("value_usd"), F.col("processing_status") == "PROCESSED"
    kind, score = F.col("event_type"), F.col("data_quality_score")
    priority = M.first_label(
        [
            (kind.isin("WHALE_ALERT", "ARBITRAGE_ALERT"), "HIGH_PRIORITY"),
            (kind.isin("TOKEN_PURCHASE", "TOKEN_SALE") & (value > 10_000), "MEDIUM_PRIORITY"),
            (F.col("processing_status") == "FAILED", "ERROR_PRIORITY"),
        ],
        "LOW_PRIORITY",
    )
    size = F.when(value > 0, M.band(value, S.EVENT_SIZE_BANDS, "SMALL_EVENT")).otherwise("NON_FINANCIAL")
    parsed = done & F.col("has_valid_json")
    quality = F.when(parsed & (score >= 0.9), 0.95).when(parsed & (score >= 0.7), 0.85).when(parsed, 0.75)
    quality = quality.when(done, 0.65).otherwise(0.40)
    complete = F.col("wallet_address").isNotNull() & F.col("token_address").isNotNull() & (value > 0)
    referenced = F.col("transaction_hash").isNotNull() & F.col("is_transaction_event")
    return single.drop("__key").withColumns(
        {
            "value_usd": F.coalesce(value, F.lit(0.0)),
            "event_priority": priority,
            "event_size_category": size,
            "event_quality_score": quality,
            "has_complete_financial_data": F.coalesce(complete, F.lit(False)),
            "has_transaction_reference": F.coalesce(referenced, F.lit(False)),
            "event_date": F.to_date("received_at"),
            "event_hour": F.hour("received_at"),
            "event_day_of_week": C.day_of_week(F.col("received_at")),
        }
    )


def events_from_trades(trades: DataFrame) -> DataFrame:
    """Event records for trades; the id is a key over hash and token, not a running number."""
    return trades.filter(F.col("transaction_hash").isNotNull()).select(
        F.concat(F.lit("tx_"), C.surrogate_key("transaction_hash", "token_address")).alias("message_id"),
        M.trade_event_type(F.col("is_arbitrage"), F.col("size_tier"), F.col("side")).alias("event_type"),
        F.lit("PROCESSED").alias("processing_status"),
        "wallet_address",
        "token_address",
        F.col("usd").alias("value_usd"),
        "transaction_hash",
    )


def alerts_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.avg("event_quality_score").alias("avg_quality"),
        F.count_if(F.col("processing_status") == "PROCESSED").alias("processed_count"),
        F.sum("value_usd").alias("total_value"),
    )


def alerts_by_priority(events: DataFrame) -> DataFrame:
    return events.groupBy("event_priority", "event_size_category").agg(
        F.count(F.lit(1)).alias("event_count"), F.avg("value_usd").alias("avg_value")
    )


def alert_summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("event_quality_score").alias("avg_quality_score"),
        F.count_if("has_complete_financial_data").alias("complete_financial_data"),
        F.count_if("has_transaction_reference").alias("has_tx_reference"),
        F.count_if(F.col("processing_status") == "PROCESSED").alias("processed_successfully"),
    )


def events_by_hour(events: DataFrame, moment: str) -> DataFrame:
    return events.groupBy(F.to_date(moment).alias("event_date"), F.hour(moment).alias("event_hour")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


# --- swap notifications ------------------------------------------------------------------------

_NOTE = (
    "struct<type:string,source:string,signature:string,timestamp:bigint,"
    "tokenTransfers:array<struct<mint:string,tokenAmount:double,fromUserAccount:string,toUserAccount:string>>,"
    "accountData:array<struct<account:string,tokenBalanceChanges:array<struct<mint:string>>>>,"
    "events:struct<swap:struct<tokenInputs:array<struct<mint:string,tokenAmount:double>>>>>"
)


def payload_state(payload: Column) -> Column:
    """missing, parse_error, empty or valid."""
    return (
        F.when(payload.isNull(), "missing")
        .when(C.parsed_json(payload).isNull(), "parse_error")
        .when(F.trim(payload).isin("[]", "{}", "null", '""', "0", "false"), "empty")
        .otherwise("valid")
    )


def notifications(payloads: DataFrame) -> DataFrame:
    """One row per transaction in a valid payload, which may be one object or an array of them."""
    # A single object is read as an array of one.  The outer form and the filter
    # afterwards keep Spark from parsing again for a filter of its own.
    listed = F.from_json(F.trim("payload"), f"array<{_NOTE}>")
    return payloads.select(*payloads.columns, F.explode_outer(listed).alias("tx")).filter(F.col("tx").isNotNull())


def payload_quality(payloads: DataFrame) -> DataFrame:
    state = payload_state(F.col("payload"))
    counts = {"valid_records": "valid", "missing_payload": "missing", "parse_errors": "parse_error", "empty_transactions": "empty"}
    figures = payloads.agg(
        F.count(F.lit(1)).alias("sample_size"), *[F.count_if(state == label).alias(n) for n, label in counts.items()]
    )
    return figures.withColumn("success_rate", F.try_divide("valid_records", "sample_size"))


def payload_profile(payloads: DataFrame) -> DataFrame:
    """How often each transaction type, source, mint, address and swapped token occurs."""
    tx = F.col("tx")

    def lines(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    none = F.array().cast("array<string>")

    def gathered(*parts: Column) -> Column:
        return F.concat(*[F.coalesce(p, none) for p in parts])

    transfers, accounts = tx["tokenTransfers"], tx["accountData"]
    changed = F.flatten(F.transform(accounts["tokenBalanceChanges"], lambda c: c["mint"]))
    everything = F.concat(
        lines("type", F.array(F.coalesce(tx["type"], F.lit("UNKNOWN")))),
        lines("source", F.array(F.coalesce(tx["source"], F.lit("UNKNOWN")))),
        lines("mint", gathered(transfers["mint"], changed)),
        lines("address", gathered(transfers["fromUserAccount"], transfers["toUserAccount"], accounts["account"])),
        lines("swapped", F.when(tx["type"] == "SWAP", gathered(tx["events"]["swap"]["tokenInputs"]["mint"])).otherwise(none)),
    )
    values = notifications(payloads).select(F.inline(everything)).filter(F.col("value").isNotNull())
    return values.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("occurrences"))


def swap_pairs(payloads: DataFrame) -> DataFrame:
    """Swap transactions with first and last transfer; pair columns are null below two transfers."""
    rows = notifications(payloads).filter(F.col("tx.type") == "SWAP")
    transfers = F.col("tx.tokenTransfers")
    paired = F.size(transfers) >= 2

    def of_pair(place: int, field: str) -> Column:
        return F.when(paired, F.try_element_at(transfers, F.lit(place))[field])

    return rows.select(
        "message_id",
        F.col("tx.signature").alias("signature"),
        F.coalesce("tx.source", F.lit("UNKNOWN")).alias("source"),
        F.col("tx.timestamp").alias("swap_time"),
        of_pair(1, "mint").alias("from_token"),
        of_pair(1, "tokenAmount").alias("from_amount"),
        of_pair(-1, "mint").alias("to_token"),
        of_pair(-1, "tokenAmount").alias("to_amount"),
        of_pair(1, "fromUserAccount").alias("trader"),
    )


def _either(test) -> Column:
    return F.coalesce(test(F.col("from_token")) | test(F.col("to_token")), F.lit(False))


def _reference_units() -> Column:
    """Reference-token amount of a swap: the sold side first, else the bought side, else 0."""
    return (
        F.when(F.col("from_token") == S.REFERENCE_MINT, F.col("from_amount"))
        .when(F.col("to_token") == S.REFERENCE_MINT, F.col("to_amount"))
        .otherwise(0.0)
    )


def swap_patterns(pairs: DataFrame) -> DataFrame:
    """Swap counters, shares of all swaps and the busiest venue in one row."""
    big = ((F.col("from_token") == S.REFERENCE_MINT) & (F.col("from_amount") > S.LARGE_SWAP_UNITS)) | (
        (F.col("to_token") == S.REFERENCE_MINT) & (F.col("to_amount") > S.LARGE_SWAP_UNITS)
    )
    per_venue = pairs.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_either(lambda t: t == S.REFERENCE_MINT)).alias("sol_pairs"),
        F.count_if(_either(lambda t: t.isin(*S.STABLE_MINTS))).alias("stablecoin_pairs"),
        F.count_if(_either(lambda t: t.endswith(S.MEME_SUFFIX))).alias("memecoin_activity"),
        F.count_if(F.coalesce(big, F.lit(False))).alias("large_swaps"),
    )
    names = ("sol_pairs", "stablecoin_pairs", "memecoin_activity", "large_swaps")
    totals = per_venue.agg(
        F.sum("n").alias("total_swaps"),
        *[F.sum(n).alias(n) for n in names],
        F.max_by("source", F.struct("n", "source")).alias("most_active_dex"),
        F.max("n").alias("most_active_count"),
    )
    return totals.withColumns(
        {
            "sol_dominance": F.try_divide("sol_pairs", "total_swaps"),
            "memecoin_share": F.try_divide("memecoin_activity", "total_swaps"),
            "large_swap_ratio": F.try_divide("large_swaps", "total_swaps"),
            "top_dex_share": F.try_divide("most_active_count", "total_swaps"),
        }
    )


def risk_signals(pairs: DataFrame) -> DataFrame:
    """Which concentration limits the swaps exceed."""
    figures = swap_patterns(pairs)
    # Signal name, figure and limit.
    limits = (
        ("HIGH_MEMECOIN_ACTIVITY", "memecoin_share", 0.7),
        ("WHALE_CONCENTRATION", "large_swap_ratio", 0.3),
        ("DEX_CONCENTRATION", "top_dex_share", 0.8),
    )
    lines = [
        F.struct(F.lit(name).alias("signal"), F.col(figure).alias("share"), (F.col(figure) > limit).alias("raised"))
        for name, figure, limit in limits
    ]
    return figures.select(F.inline(F.array(*lines)))


def venue_ranking(pairs: DataFrame, keep: int = 3) -> DataFrame:
    """Venues by swaps with their share."""
    counted = pairs.groupBy("source").agg(F.count(F.lit(1)).alias("swaps"))
    head = top_n(counted, [F.desc("swaps"), F.asc("source")], keep, "place")
    total = counted.agg(F.sum("swaps")).first()[0] or 0
    return head.withColumn("share", F.try_divide(F.col("swaps"), F.lit(total)))


def _sides(pairs: DataFrame) -> DataFrame:
    """Two rows per paired swap: its first and its second token."""
    return pairs.filter(F.col("from_token").isNotNull()).select(
        "trader", "source", "from_token", "from_amount", "to_token", "to_amount",
        F.posexplode_outer(F.array("from_token", "to_token")).alias("side", "token"),
    )


def _usual_source() -> Column:
    """Most frequent venue, the first by name among equals.  Venues are few, so the counts stay small."""
    return F.mode("source", deterministic=True)


def token_activity(pairs: DataFrame) -> DataFrame:
    """Swaps, traders, reference volume and main venue of every swapped token, in one pass."""
    units = F.when(F.col("token") == S.REFERENCE_MINT, _reference_units()).otherwise(0.0)
    tokens = _sides(pairs).filter(F.col("token") != "").groupBy("token").agg(
        F.count(F.lit(1)).alias("swap_count"),
        F.count_distinct("trader").alias("unique_traders"),
        F.sum(units).alias("total_volume_sol"),
        _usual_source().alias("primary_dex"),
    )
    return tokens.withColumns(
        {
            "symbol": C.mint_symbol(F.col("token")),
            "avg_swap_size": F.try_divide("total_volume_sol", "swap_count"),
        }
    )


def hot_tokens(pairs: DataFrame, keep: int = 20) -> DataFrame:
    order = [F.desc("swap_count"), F.desc("total_volume_sol"), F.asc("token")]
    return top_n(token_activity(pairs), order, keep, "place")


def trader_activity(pairs: DataFrame, keep: int = 10) -> DataFrame:
    """The busiest traders with tokens, reference volume, preferred venue and a whale flag."""
    first = F.col("side") == 0
    traders = _sides(pairs).filter(F.col("trader") != "").groupBy("trader").agg(
        F.count_if(first).alias("swap_count"),
        F.sum(F.when(first, _reference_units()).otherwise(0.0)).alias("total_volume"),
        F.count_distinct("token").alias("tokens_traded"),
        _usual_source().alias("preferred_dex"),
    )
    head = top_n(traders, [F.desc("swap_count"), F.desc("total_volume"), F.asc("trader")], keep, "place")
    return head.withColumn("potential_whale", F.col("total_volume") > S.WHALE_TRADER_UNITS)


def meme_transfers(payloads: DataFrame) -> DataFrame:
    """Transfers of meme tokens: by mint suffix, or any transfer on a meme venue."""
    on_venue = F.col("tx.source").isin(*S.MEME_SOURCES)
    swaps = notifications(payloads).filter(
        (F.col("tx.type") == "SWAP") & (F.size("tx.tokenTransfers") >= 2)
    )
    rows = swaps.select(
        "message_id",
        F.coalesce(on_venue, F.lit(False)).alias("on_meme_venue"),
        F.col("tx.timestamp").alias("swap_time"),
        F.try_element_at("tx.tokenTransfers", F.lit(1))["fromUserAccount"].alias("trader"),
        F.posexplode_outer("tx.tokenTransfers").alias("place", "t"),
    )
    return rows.select(
        "message_id", "on_meme_venue", "swap_time", "trader", "place",
        F.col("t.mint").alias("mint"), F.col("t.tokenAmount").alias("amount"),
    ).filter(F.col("mint").endswith(S.MEME_SUFFIX) | F.col("on_meme_venue"))


def meme_trends(payloads: DataFrame, keep: int = 15, recent: int = 5) -> DataFrame:
    """The busiest meme tokens with traders, volume, latest swaps and alert level."""
    rows = meme_transfers(payloads)
    units = F.when(F.col("mint") == S.REFERENCE_MINT, F.col("amount")).otherwise(0.0)
    tokens = rows.groupBy("mint").agg(
        F.count(F.lit(1)).alias("swap_count"),
        F.count_distinct(F.when(F.col("trader") != "", F.col("trader"))).alias("traders"),
        F.sum(units).alias("volume_sol"),
    )
    newest = top_n_per_group(
        rows, ["mint"], [F.desc("swap_time"), F.desc("message_id"), F.desc("place")], recent, "__n"
    )
    lists = newest.groupBy("mint").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("__n", "swap_time", "amount", "trader"))), lambda r: r["swap_time"]
        ).alias("recent_swap_times")
    )
    head = top_n(tokens, [F.desc("swap_count"), F.desc("volume_sol"), F.asc("mint")], keep, "place")
    level = F.when(F.col("swap_count") > 10, "HIGH").when(F.col("swap_count") >= 3, "MEDIUM")
    return head.join(lists, "mint").withColumn("alert_level", level)


def meme_venue_summary(payloads: DataFrame) -> DataFrame:
    """Figures of the meme venues and tokens as a whole."""
    rows = meme_transfers(payloads)
    on_venue = F.col("on_meme_venue")
    return rows.agg(
        F.count_if(on_venue & (F.col("place") == 0)).alias("total_swaps"),
        F.count_distinct("mint").alias("unique_tokens"),
        F.count_distinct(F.when(on_venue & (F.col("trader") != ""), F.col("trader"))).alias("unique_traders"),
        F.coalesce(F.sum(F.when(F.col("mint") == S.REFERENCE_MINT, F.col("amount"))), F.lit(0.0)).alias("total_volume_sol"),
    )


# --- samples and diagnostics -----------------------------------------------------------------------


def systematic_sample(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Every k-th row in ``order`` with k the whole part of rows / size, ``size`` rows at most."""
    placed = global_position(df, order, "__pos")
    step = max(1, placed.count() // size)
    wanted = ((F.col("__pos") - 1) % step == 0) & (F.col("__pos") <= step * size)
    return placed.filter(wanted).drop("__pos")


def freshness(df: DataFrame, moment: str, now: Column) -> DataFrame:
    newest = df.agg(F.max(moment).alias("latest"))
    return newest.withColumn("age", C.age_text(F.col("latest"), now))


def unknown_match_counts(trades: DataFrame) -> DataFrame:
    """For trades of unknown side: does either token equal the followed one?"""
    source, target = F.col("from_address") == F.col("token_address"), F.col("to_address") == F.col("token_address")
    return trades.filter(F.col("transaction_type") == "UNKNOWN").agg(
        F.count(F.lit(1)).alias("total_unknown"),
        F.count_if(source).alias("from_matches_target"),
        F.count_if(target).alias("to_matches_target"),
        F.count_if(~source & ~target).alias("neither_matches"),
    )


def unknown_pairs(trades: DataFrame, keep: int = 10) -> DataFrame:
    counted = (
        trades.filter(F.col("transaction_type") == "UNKNOWN")
        .groupBy("from_symbol", "to_symbol")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_n(counted, [F.desc("n"), F.asc_nulls_last("from_symbol"), F.asc_nulls_last("to_symbol")], keep, "place")


def unknown_tokens(trades: DataFrame, keep: int = 10) -> DataFrame:
    rows = trades.filter(F.col("transaction_type") == "UNKNOWN")
    sides = [rows.select(F.col(f"{s}_symbol").alias("symbol"), F.col(f"{s}_address").alias("address")) for s in ("from", "to")]
    counted = sides[0].unionAll(sides[1]).groupBy("symbol", "address").agg(F.count(F.lit(1)).alias("occurrences"))
    return top_n(counted, [F.desc("occurrences"), F.asc_nulls_last("symbol"), F.asc("address")], keep, "place")


def unknown_with_known(trades: DataFrame) -> DataFrame:
    """Unknown trades of wallets that also bought or sold the same token."""
    unknown = trades.filter(F.col("transaction_type") == "UNKNOWN")
    known = trades.filter(F.col("transaction_type").isin("BUY", "SELL")).select("wallet_address", "token_address")
    return unknown.join(known.distinct(), ["wallet_address", "token_address"], "left_semi")


# --- activity windows ------------------------------------------------------------------------------


def trending_tokens(trades: DataFrame, width: str, rules: dict = S.TRENDING) -> DataFrame:
    """Most traded tokens of every time window above the volume and count floors."""
    per_window = trades.groupBy(F.window("trade_time", width).alias("w"), "token_address").agg(
        F.sum("usd").alias("volume"), F.count(F.lit(1)).alias("trades")
    )
    busy = per_window.filter((F.col("volume") >= rules["min_volume"]) & (F.col("trades") >= rules["min_trades"]))
    flat = busy.select(F.col("w.start").alias("window_start"), "token_address", "volume", "trades")
    return top_n_per_group(flat, ["window_start"], [F.desc("volume"), F.asc("token_address")], rules["top"], "place")


def whale_trades(trades: DataFrame, floor: float = S.WHALE_TRADE_FLOOR, keep: int = S.WHALE_TRADES_KEPT) -> DataFrame:
    return top_n(trades.filter(F.col("usd") >= floor), [F.desc("usd"), F.asc("trade_id")], keep, "place")


def venue_daily_volume(trades: DataFrame, venues=S.VENUES, floor: float = S.VENUE_MIN_DAILY_VOLUME) -> DataFrame:
    daily = (
        trades.filter(F.col("source").isin(*venues))
        .groupBy(F.to_date("trade_time").alias("trade_date"), "source")
        .agg(F.sum("usd").alias("volume"), F.count(F.lit(1)).alias("trades"))
    )
    return daily.filter(F.col("volume") >= floor)


def activity_alerts(trades: DataFrame, width: str = "5 minutes", limits: dict = S.ALERTS) -> DataFrame:
    """Windows whose volume or mean price jumped against the token's window before, or with a very large trade."""
    before = Window.partitionBy("token_address").orderBy("window_start")
    flat = alert_windows(trades, width).drop("w")
    return judged_alerts(flat.withColumns({"volume_before": F.lag("volume").over(before), "price_before": F.lag("price").over(before)}), limits)


def alert_windows(trades: DataFrame, width: str) -> DataFrame:
    """Volume, mean price and largest trade of each token and window, for batch and streaming frames."""
    windows = trades.groupBy(F.window("trade_time", width).alias("w"), "token_address").agg(
        F.sum("usd").alias("volume"),
        F.try_divide(F.sum("usd"), F.sum("quantity")).alias("price"),
        F.max("usd").alias("largest_trade"),
    )
    return windows.select("w", F.col("w.start").alias("window_start"), "token_address", "volume", "price", "largest_trade")


def judged_alerts(paired: DataFrame, limits: dict = S.ALERTS) -> DataFrame:
    """Windows, each with the figures of its token's window before, that pass a limit."""
    move = F.abs(F.try_divide(F.col("price") - F.col("price_before"), F.col("price_before"))) * 100
    flags = {
        "volume_spike": F.coalesce(F.col("volume") >= F.col("volume_before") * limits["volume_multiple"], F.lit(False)),
        "price_move": F.coalesce(move >= limits["price_change_percent"], F.lit(False)),
        "whale_trade": F.col("largest_trade") >= limits["whale_trade"],
    }
    return paired.withColumns(flags).filter(F.col("volume_spike") | F.col("price_move") | F.col("whale_trade"))


def valid_transaction(kind: Column, amount: Column, signature: Column, address: Column) -> Column:
    """Supported type, amount within limits, long enough signature and address."""
    low, high = S.AMOUNT_LIMITS
    tests = (
        kind.isin(*S.SUPPORTED_TYPES),
        amount.between(low, high),
        F.length(signature) >= S.MIN_SIGNATURE_LENGTH,
        F.length(address) >= S.MIN_ADDRESS_LENGTH,
    )
    whole = tests[0]
    for test in tests[1:]:
        whole = whole & test
    return F.coalesce(whole, F.lit(False))

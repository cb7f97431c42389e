"""Landed raw JSON turned into typed rows.  Every reader states its schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import first_event_fields, unix_time
from tidemark.operators.ordered import keep_latest

WEBHOOK_FILE_SCHEMA = "webhook_id string, received_at string, source_ip string, payload string"
MESSAGE_SCHEMA = "message_id string, timestamp string, source_ip string, file_path string, payload string"


def read_json_files(spark: SparkSession, path: str, schema: str = WEBHOOK_FILE_SCHEMA) -> DataFrame:
    """Landed JSON-lines files; lines that are no JSON give rows of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def webhook_rows(landed: DataFrame, ingested_at: Column, batch_id: str) -> DataFrame:
    """Bronze webhook rows: key fields of the payload's first event and audit columns."""
    event = first_event_fields(F.col("payload"))
    return (
        landed.filter(F.col("webhook_id").isNotNull())
        .withColumn("__event", event)
        .select(
            "webhook_id",
            F.col("__event.signature").alias("transaction_signature"),
            F.col("__event.type").alias("webhook_type"),
            F.col("received_at").try_cast("timestamp_ntz").alias("webhook_timestamp"),
            F.col("payload").alias("raw_payload"),
            F.col("__event.account").alias("account_address"),
            F.col("__event.mint").alias("token_address"),
            "source_ip",
            ingested_at.alias("ingested_at"),
            F.to_date(ingested_at).alias("processing_date"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(False).alias("processed_to_silver"),
        )
    )


def latest_webhooks(rows: DataFrame) -> DataFrame:
    """One row per webhook id, the one received last; files that landed twice count once."""
    return keep_latest(rows, ["webhook_id"], [F.desc_nulls_last("webhook_timestamp"), F.desc("raw_payload")])


# --- token lists ---------------------------------------------------------------------------

# Field names of the token list answers, first present one wins.
_TOKEN_ALIASES = {
    "token_address": ("address", "token_address"),
    "logo_uri": ("logo_uri", "logoURI"),
    "market_cap": ("market_cap", "mc"),
    "last_trade_unix_time": ("last_trade_unix_time", "lastTradeUnixTime"),
    "recent_listing_time": ("recent_listing_time", "recentListingTime"),
}
_TOKEN_TEXT = ("token_address", "logo_uri", "symbol", "name", "extensions")
_TOKEN_LONG = ("decimals", "holder", "last_trade_unix_time", "recent_listing_time")
_SPANS = ("1h", "2h", "4h", "8h", "24h")
_TOKEN_DOUBLE = (
    "liquidity", "price", "fdv", "market_cap",
    *[f"volume_{s}_usd" for s in _SPANS],
    *[f"volume_{s}_change_percent" for s in _SPANS],
    *[f"price_change_{s}_percent" for s in _SPANS],
)
_TOKEN_COUNTS = tuple(f"trade_{s}_count" for s in _SPANS)


def _token_fields() -> dict[str, str]:
    kinds = dict.fromkeys(_TOKEN_TEXT, "string")
    kinds |= dict.fromkeys((*_TOKEN_LONG, *_TOKEN_COUNTS), "bigint")
    return kinds | dict.fromkeys(_TOKEN_DOUBLE, "double")


def token_rows(documents: DataFrame, body: str = "body") -> DataFrame:
    """Flat token rows out of token-list answers (``data.items`` or ``data.tokens``)."""
    kinds = _token_fields()
    names = {alias: kinds[target] for target, aliases in _TOKEN_ALIASES.items() for alias in aliases}
    names |= {n: k for n, k in kinds.items() if n not in _TOKEN_ALIASES}
    item = ",".join(f"`{n}`:{k}" for n, k in names.items())
    parsed = F.from_json(
        F.col(body), f"struct<data:struct<items:array<struct<{item}>>,tokens:array<struct<{item}>>>>",
        {"caseSensitive": "true"},
    )
    # The outer forms of explode keep Spark from parsing again for a filter of its own.
    listed = F.explode_outer(F.coalesce(parsed["data"]["items"], parsed["data"]["tokens"]))
    items = documents.select(listed.alias("i")).filter(F.col("i").isNotNull())

    def value(target: str) -> Column:
        return F.coalesce(*[F.col("i")[a] for a in _TOKEN_ALIASES.get(target, (target,))])

    return items.select(*[value(n).alias(n) for n in kinds])


# --- holders -----------------------------------------------------------------------------------

_HOLDER = "array<struct<owner:string,amount:string,ui_amount:double,decimals:int,mint:string,token_account:string>>"


def holder_rows(documents: DataFrame, body: str = "body") -> DataFrame:
    """One row per listed holder; the rank is the place in the list (``items`` or ``holders``)."""
    parsed = F.from_json(F.col(body), f"struct<data:struct<items:{_HOLDER},holders:{_HOLDER}>>")
    holders = F.coalesce(parsed["data"]["items"], parsed["data"]["holders"])
    listed = documents.select("token_address", F.posexplode_outer(holders).alias("pos", "h")).filter(F.col("h").isNotNull())
    return listed.select(
        "token_address",
        F.coalesce("h.owner", F.lit("")).alias("wallet_address"),
        (F.col("pos") + 1).alias("rank"),
        F.coalesce("h.amount", F.lit("0")).alias("amount"),
        F.coalesce("h.ui_amount", F.lit(0.0)).alias("ui_amount"),
        F.coalesce("h.decimals", F.lit(9)).alias("decimals"),
        F.coalesce("h.mint", "token_address").alias("mint"),
        F.coalesce("h.token_account", F.lit("")).alias("token_account"),
    )


# --- trades -----------------------------------------------------------------------------------------

_LEG = "struct<symbol:string,address:string,type_swap:string,ui_change_amount:double,nearest_price:double>"
_TRADE = f"array<struct<tx_hash:string,owner:string,block_unix_time:bigint,source:string,tx_type:string,base:{_LEG},quote:{_LEG}>>"


def trade_rows(documents: DataFrame, fetched_at: Column, body: str = "body") -> DataFrame:
    """Two-legged swap rows of a wallet's trade list.

    Entries without hash or of another owner are dropped; an entry without time
    gets the fetch time.  ``data`` may be the list itself or hold it as ``items``
    or ``trades``.
    """
    parsed = documents.select("wallet_address", F.try_parse_json(F.col(body)).alias("v"))
    places = [F.try_variant_get("v", path, _TRADE) for path in ("$.data.items", "$.data.trades", "$.data")]
    listed = parsed.select("wallet_address", F.explode_outer(F.coalesce(*places)).alias("x"))
    own = listed.filter((F.col("x.tx_hash") != "") & (F.col("x.owner") == F.col("wallet_address")))
    legs = [
        F.col(f"x.{leg}.{name}").alias(f"{leg}_{name}")
        for leg in ("base", "quote")
        for name in ("symbol", "address", "type_swap", "ui_change_amount", "nearest_price")
    ]
    return own.select(
        "wallet_address",
        F.col("x.tx_hash").alias("transaction_hash"),
        unix_time(F.col("x.block_unix_time"), fetched_at).alias("timestamp"),
        *legs,
        F.col("x.source").alias("source"),
        F.col("x.tx_type").alias("tx_type"),
    )


"""Queries that read, write and update tables.  Scratch copies go to the shared folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.scalars import moment
from tidemark.operators import incremental as I
from tidemark.operators.checks import null_profile
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_tokens import _TRACKED, tracked
from tidemark.plans.registry import query
from tidemark.session import fresh_path
from tidemark.sources import landing as L
from tidemark.sources import tables as T
from tidemark.streaming import landing as ST

NOON = datetime(2024, 2, 1, 12)
LATER = datetime(2024, 2, 2, 12)


def events(spark, sf_dir):
    return A.table(spark, sf_dir, "events")


def _written_by_date(spark, sf_dir):
    path = fresh_path(spark, "events-by-date")
    T.write_partitioned(events(spark, sf_dir).withColumn("date", F.to_date("ts")), path, ["date"], "overwrite")
    return path


# --- scans ------------------------------------------------------------------------------


@query("SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier")
def scan_union_by_name(spark, sf_dir):
    return T.read_files(spark, [f"{sf_dir}/customer*.parquet", f"{sf_dir}/supplier*.parquet"])


@query("SELECT event_id, user_id, value, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07'")
def scan_one_partition(spark, sf_dir):
    day = datetime(2024, 1, 7).date()
    return T.read_partition(spark, _written_by_date(spark, sf_dir), "date", day).select("event_id", "user_id", "value", "date")


@query("SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-19'")
def recent_partitions(spark, sf_dir):
    table = spark.read.parquet(_written_by_date(spark, sf_dir))
    return T.recent_partitions(table, "date", F.lit("2024-01-19").cast("date"), 7)


@query(using("tokens") + "SELECT token_address, symbol, liquidity, processing_date, ingest FROM tokens")
def registered_table(spark, sf_dir):
    lake = T.Lake(spark, fresh_path(spark, "lake"))
    tokens = A.tokens(spark, sf_dir).select("token_address", "symbol", "liquidity", "processing_date", "ingest")
    lake.write("tokens", tokens.filter("ingest = 1"))
    lake.write("tokens", tokens.filter("ingest = 2"))
    return lake.read("tokens")


# --- raw JSON ------------------------------------------------------------------------------


@query(using("payload_parts") + """SELECT CAST(event_id AS VARCHAR) AS webhook_id, CASE WHEN state = 'valid' AND k % 2 = 0 THEN 'sig' || event_id END AS transaction_signature,
        CASE WHEN state = 'valid' AND k % 2 = 0 THEN kind ELSE 'UNKNOWN' END AS webhook_type, CASE WHEN state = 'valid' AND k % 2 = 0 THEN trader END AS account_address,
        CASE WHEN state = 'valid' AND k % 2 = 0 THEN from_mint END AS token_address, DATE '2024-02-01' AS processing_date, false AS processed_to_silver FROM payload_parts""")
def ingest_json_files(spark, sf_dir):
    path = fresh_path(spark, "webhook-files")
    payloads = A.payloads(spark, sf_dir)
    payloads.select(
        F.col("message_id").alias("webhook_id"), F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss").alias("received_at"),
        F.lit("10.0.0.1").alias("source_ip"), "payload",
    ).write.json(path)
    lake = T.Lake(spark, fresh_path(spark, "lake"))
    for batch in ("batch-1", "batch-2"):  # the same files land twice
        lake.merge("webhooks", L.latest_webhooks(L.webhook_rows(L.read_json_files(spark, path), moment(NOON), batch)))
    return lake.read("webhooks").select(
        "webhook_id", "transaction_signature", "webhook_type", "account_address", "token_address", "processing_date", "processed_to_silver"
    )


@query("""SELECT CAST(p_partkey AS VARCHAR) AS token_address, p_brand AS symbol, p_name AS name, 'l' || p_partkey AS logo_uri, p_size::BIGINT AS decimals, p_retailprice AS price,
        p_retailprice * 2 AS market_cap, (p_partkey % 7)::BIGINT AS last_trade_unix_time FROM part UNION ALL
    SELECT 'x' || p_partkey, p_brand, NULL, NULL, NULL, p_retailprice, NULL, NULL FROM part WHERE p_partkey % 3 = 0""")
def token_list_rows(spark, sf_dir):
    key = F.col("p_partkey")
    common = [F.col("p_brand").alias("symbol"), F.col("p_retailprice").alias("price")]
    new = F.struct(
        key.cast("string").alias("address"), *common, F.col("p_name").alias("name"), F.concat(F.lit("l"), key).alias("logo_uri"),
        F.col("p_size").alias("decimals"), (F.col("p_retailprice") * 2).alias("market_cap"), (key % 7).alias("last_trade_unix_time"),
    )
    old = F.struct(
        key.cast("string").alias("address"), *common, F.col("p_name").alias("name"), F.concat(F.lit("l"), key).alias("logoURI"),
        F.col("p_size").alias("decimals"), (F.col("p_retailprice") * 2).alias("mc"), (key % 7).alias("lastTradeUnixTime"),
    )
    extra = F.to_json(F.struct(F.concat(F.lit("x"), key).alias("address"), *common))
    listed = F.when(key % 2 == 0, F.to_json(new)).otherwise(F.to_json(old))
    items = F.when(key % 3 == 0, F.concat(listed, F.lit(","), extra)).otherwise(listed)
    field = F.when(key % 2 == 0, '{"data":{"items":[').otherwise('{"success":true,"data":{"tokens":[')
    documents = A.table(spark, sf_dir, "part").select(F.concat(field, items, F.lit("]}}")).alias("body"))
    return L.token_rows(documents).select(
        "token_address", "symbol", "name", "logo_uri", "decimals", "price", "market_cap", "last_trade_unix_time"
    )


@query("""SELECT 'N' || c_nationkey AS token_address, 'H' || (c_custkey + r) AS wallet_address, r AS rank, CASE WHEN r = 1 THEN CAST(c_custkey AS VARCHAR) ELSE '0' END AS amount,
        CASE WHEN r = 1 THEN c_acctbal ELSE 0 END AS ui_amount, CASE WHEN r = 1 THEN 6 ELSE 9 END AS decimals, 'N' || c_nationkey AS mint, '' AS token_account
    FROM customer, (SELECT unnest([1, 2, 3]) AS r) WHERE c_custkey % 5 <> 0 OR r < 2""")
def holder_list_rows(spark, sf_dir):
    key = F.col("c_custkey")

    def owner(place: int):
        return F.concat(F.lit('{"owner":"H'), (key + place).cast("string"), F.lit('"'))

    first = F.concat(
        owner(1), F.lit(',"amount":"'), key.cast("string"), F.lit('","ui_amount":'), F.col("c_acctbal").cast("string"), F.lit(',"decimals":6}')
    )
    rest = F.concat(*[x for place in (2, 3) for x in (F.lit(","), owner(place), F.lit("}"))])
    items = F.when(key % 5 == 0, first).otherwise(F.concat(first, rest))
    field = F.when(key % 2 == 0, '{"data":{"items":[').otherwise('{"data":{"holders":[')
    documents = A.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("N"), "c_nationkey").alias("token_address"), F.concat(field, items, F.lit("]}}")).alias("body")
    )
    return L.holder_rows(documents)


@query("""SELECT 'W' || user_id AS wallet_address, 'tx' || event_id AS transaction_hash,
        CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '2024-02-01 12:00:00' ELSE TIMESTAMP '1970-01-01' + to_seconds(1704067200 + event_id) END AS "timestamp",
        event_type AS base_symbol, value AS base_ui_change_amount, 'Q' AS quote_symbol, NULL::DOUBLE AS quote_nearest_price, 'swap' AS tx_type
    FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""")
def trade_list_rows(spark, sf_dir):
    event_id, user = F.col("event_id"), F.col("user_id").cast("string")
    owner = F.when(event_id % 11 == 0, "somebody").otherwise(F.concat(F.lit("W"), user))
    tx_hash = F.when(event_id % 13 == 0, "").otherwise(F.concat(F.lit("tx"), event_id.cast("string")))
    when = F.when(event_id % 7 == 0, "").otherwise(F.concat(F.lit(',"block_unix_time":'), (event_id + 1_704_067_200).cast("string")))
    trade = F.concat(
        F.lit('{"tx_hash":"'), tx_hash, F.lit('","owner":"'), owner, F.lit('"'), when, F.lit(',"tx_type":"swap","base":{"symbol":"'),
        F.col("event_type"), F.lit('","ui_change_amount":'), F.col("value").cast("string"), F.lit('},"quote":{"symbol":"Q","nearest_price":null}}'),
    )
    body = (
        F.when(event_id % 3 == 0, F.concat(F.lit('{"data":['), trade, F.lit("]}")))
        .when(event_id % 3 == 1, F.concat(F.lit('{"data":{"items":['), trade, F.lit("]}}")))
        .otherwise(F.concat(F.lit('{"data":{"trades":['), trade, F.lit("]}}")))
    )
    documents = events(spark, sf_dir).select(F.concat(F.lit("W"), user).alias("wallet_address"), body.alias("body"))
    rows = L.trade_rows(documents, moment(NOON))
    return rows.select(
        "wallet_address", "transaction_hash", "timestamp", "base_symbol", "base_ui_change_amount", "quote_symbol", "quote_nearest_price", "tx_type"
    )


# --- writes -----------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def write_partitioned(spark, sf_dir):
    path = fresh_path(spark, "events-by-type")
    T.write_partitioned(events(spark, sf_dir), path, ["event_type"], "overwrite")
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT 'first' AS batch_id, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_rows, 'completed' AS status FROM orders
    UNION ALL SELECT 'second', count(*) FILTER (WHERE o_orderstatus <> 'O'), 'completed' FROM orders""")
def batch_status(spark, sf_dir):
    path, status = fresh_path(spark, "orders"), fresh_path(spark, "orders-status")
    orders = A.table(spark, sf_dir, "orders")
    T.append_batch(orders.filter("o_orderstatus = 'O'"), path, status, "first", NOON)
    T.append_batch(orders.filter("o_orderstatus <> 'O'"), path, status, "second", LATER)
    return spark.read.parquet(status).select("batch_id", "n_rows", "status")


@query("""SELECT count(*) AS n_rows, round(avg(c_acctbal), 4) AS mean_balance, max(c_acctbal) AS max_balance, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building FROM customer""")
def run_metadata(spark, sf_dir):
    path = fresh_path(spark, "run-metadata")
    figures = {
        "n_rows": F.count(F.lit(1)), "mean_balance": F.round(F.avg("c_acctbal"), 4), "max_balance": F.max("c_acctbal"),
        "building": F.count_if(F.col("c_mktsegment") == "BUILDING"),
    }
    T.write_run_metadata(A.table(spark, sf_dir, "customer"), path, figures)
    return spark.read.schema("n_rows bigint, mean_balance double, max_balance double, building bigint").json(path)


@query("SELECT l_returnflag, l_suppkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL")
def compacted_table(spark, sf_dir):
    path = fresh_path(spark, "lines-compacted")
    source = fresh_path(spark, "lines-by-flag")
    A.table(spark, sf_dir, "lineitem").write.partitionBy("l_returnflag").parquet(source)
    T.compact(spark, source, path, ["l_suppkey", "l_shipdate"], ["l_returnflag"])
    flag = F.regexp_extract(F.col("_metadata.file_path"), "l_returnflag=([A-Z])/", 1)  # the partitions are still folders
    return spark.read.parquet(path).withColumn("l_returnflag", flag).groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


# --- snapshots ----------------------------------------------------------------------------------


def _snapshots(spark, sf_dir):
    table = T.SnapshotTable(spark, fresh_path(spark, "suppliers"))
    suppliers = A.table(spark, sf_dir, "supplier")
    table.commit(suppliers.filter("s_acctbal > 0"), NOON, "CREATE")
    table.commit(suppliers.withColumn("s_acctbal", F.col("s_acctbal") + 1), LATER, "MERGE")
    return table


@query("SELECT * FROM supplier WHERE s_acctbal > 0")
def snapshot_by_version(spark, sf_dir):
    return _snapshots(spark, sf_dir).read(version=0)


@query("SELECT s_suppkey, s_acctbal + 1 AS s_acctbal FROM supplier")
def snapshot_by_time(spark, sf_dir):
    return _snapshots(spark, sf_dir).read(timestamp=datetime(2024, 2, 3)).select("s_suppkey", "s_acctbal")


@query("SELECT true AS readable, 1::BIGINT AS version, count(*) AS record_count, ['MERGE', 'CREATE'] AS recent_operations FROM supplier")
def snapshot_health(spark, sf_dir):
    return _snapshots(spark, sf_dir).health().drop("committed_at")


@query("""SELECT s_suppkey, s_acctbal + 1 AS now, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS before,
    s_acctbal + 1 - CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0 END AS change FROM supplier""")
def snapshot_change(spark, sf_dir):
    table = _snapshots(spark, sf_dir)
    before = table.read(version=0).select("s_suppkey", F.col("s_acctbal").alias("before"))
    now = table.read().select("s_suppkey", F.col("s_acctbal").alias("now"))
    return now.join(before, "s_suppkey", "left").withColumn("change", F.col("now") - F.coalesce("before", F.lit(0.0)))


# --- upserts ------------------------------------------------------------------------------------------


def _stored_and_fresh(spark, sf_dir):
    tokens = A.tokens(spark, sf_dir).select("token_address", "symbol", "liquidity", "processing_date", "ingest")
    return tokens.filter("ingest = 1 AND token_address % 5 <> 0"), tokens.filter("ingest = 2")


_MERGED = """, stored AS (SELECT token_address, symbol, liquidity, processing_date, ingest FROM tokens WHERE ingest = 1 AND token_address % 5 <> 0),
    fresh AS (SELECT token_address, symbol, liquidity, processing_date, ingest FROM tokens WHERE ingest = 2)"""


@query(using("tokens") + _MERGED + """SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE token_address NOT IN (SELECT token_address FROM fresh)""")
def upsert(spark, sf_dir):
    stored, fresh = _stored_and_fresh(spark, sf_dir)
    return I.upsert(stored, fresh, ["token_address"])


@query(using("tokens") + _MERGED + """SELECT s.token_address, s.symbol, s.liquidity + coalesce(f.liquidity, 0) AS liquidity, s.processing_date,
    CASE WHEN f.token_address IS NULL THEN s.ingest ELSE 9 END AS ingest FROM stored s LEFT JOIN fresh f USING (token_address)""")
def update_with_expressions(spark, sf_dir):
    stored, fresh = _stored_and_fresh(spark, sf_dir)
    changes = {"liquidity": F.col("t.liquidity") + F.col("s.liquidity"), "ingest": F.lit(9)}
    return I.upsert(stored, fresh, ["token_address"], changes, insert=False)


@query(using("tokens") + _MERGED + "SELECT count(*) FILTER (WHERE s.token_address IS NULL) AS new_records, count(s.token_address) AS updated_records FROM fresh f LEFT JOIN stored s USING (token_address)")
def new_and_updated(spark, sf_dir):
    stored, fresh = _stored_and_fresh(spark, sf_dir)
    return I.new_and_updated(stored, fresh, ["token_address"])


@query(using("tokens") + _TRACKED + """SELECT token_address, CASE WHEN token_address % 10 = 3 THEN 'completed' ELSE whale_fetch_status END AS whale_fetch_status,
    token_address % 10 <> 3 AS is_newly_tracked FROM tracked""")
def status_update(spark, sf_dir):
    rows = tracked(spark, sf_dir)
    done = rows.filter("token_address % 10 = 3")
    changed = I.update_status(rows, done, ["token_address"], {"whale_fetch_status": F.lit("completed"), "is_newly_tracked": F.lit(False)})
    return changed.select("token_address", "whale_fetch_status", "is_newly_tracked")


@query(using("holders") + "SELECT wallet_address, token_address, rank_date, false AS txns_fetched, 'pending' AS txns_fetch_status, NULL::VARCHAR AS token_symbol FROM holders")
def status_reset(spark, sf_dir):
    values = {"txns_fetched": F.lit(False), "txns_fetch_status": F.lit("pending"), "token_symbol": None}
    reset = I.reset_status(A.holders(spark, sf_dir), values)
    return reset.select("wallet_address", "token_address", "rank_date", "txns_fetched", "txns_fetch_status", "token_symbol")


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT max(o_orderdate) + INTERVAL 8202 DAY FROM orders)")
def above_high_water(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "ts")
    done = A.table(spark, sf_dir, "orders").select((F.col("o_orderdate") + F.expr("INTERVAL 8202 DAYS")).alias("ts"))
    return I.above_high_water(rows, "ts", done)


@query("SELECT DISTINCT CAST(ts AS DATE) AS processed_date FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE user_id = 3)")
def pending_dates(spark, sf_dir):
    dated = events(spark, sf_dir).select("user_id", F.to_date("ts").alias("day"))
    log = I.log_of(dated.filter("user_id = 3"), "day", "batch-1")
    return I.pending_dates(dated, "day", log)


@query("""SELECT d.*, n.null_count FROM (VALUES ('o_totalprice', 'retyped', 'double', 'string'), ('o_orderstatus', 'removed', 'string', NULL),
      ('o_orderkey', 'same', 'bigint', 'bigint'), ('o_custkey', 'same', 'bigint', 'bigint'), ('o_orderdate', 'same', 'timestamp_ntz', 'timestamp_ntz'),
      ('o_orderpriority', 'same', 'string', 'string'), ('o_region', 'added', NULL, 'string')) d(column_name, change, old_type, new_type)
    LEFT JOIN (SELECT unnest(['o_totalprice', 'o_orderstatus', 'o_orderkey', 'o_custkey', 'o_orderdate', 'o_orderpriority']) AS column_name,
      unnest([count(*) - count(o_totalprice), count(*) - count(o_orderstatus), count(*) - count(o_orderkey), count(*) - count(o_custkey),
              count(*) - count(o_orderdate), count(*) - count(o_orderpriority)]) AS null_count FROM orders) n USING (column_name)""")
def schema_changes(spark, sf_dir):
    old = A.table(spark, sf_dir, "orders")
    new = old.drop("o_orderstatus").withColumns({"o_totalprice": F.col("o_totalprice").cast("string"), "o_region": F.lit("x")})
    filled = null_profile(old, "o_orderkey").select("column_name", "null_count")
    return I.schema_diff_frame(old, new).join(filled, "column_name", "left")


@query(using("tokens") + """, stored AS (SELECT token_address, symbol, liquidity, ingest, CASE WHEN token_address % 13 <> 0 THEN processing_date END AS processing_date
                       FROM tokens WHERE ingest = 1),
    fresh AS (SELECT token_address, symbol || '!' AS symbol, liquidity + 1 AS liquidity, 2 AS ingest, processing_date FROM stored
              WHERE processing_date >= DATE '2024-01-04' AND token_address % 3 = 0 AND token_address % 11 <> 5
              UNION ALL SELECT -token_address, symbol, liquidity, 2, processing_date FROM stored WHERE processing_date = DATE '2024-01-04' AND token_address % 7 = 0
              UNION ALL SELECT token_address, symbol, liquidity, 3, DATE '2024-02-01' FROM stored WHERE token_address % 11 = 5
              UNION ALL SELECT token_address, symbol, liquidity, 4, NULL FROM stored WHERE token_address = 13)
    SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE token_address NOT IN (SELECT token_address FROM fresh)""")
def merge_into_partitions(spark, sf_dir):
    """Changed and new keys, keys that move to another partition, and rows without a partition value."""
    lake = T.Lake(spark, fresh_path(spark, "lake"))
    day = F.when(F.col("token_address") % 13 != 0, F.col("processing_date"))
    stored = A.tokens(spark, sf_dir).filter("ingest = 1").withColumn("processing_date", day)
    stored = stored.select("token_address", "symbol", "liquidity", "ingest", "processing_date")
    lake.merge("tokens", stored)
    changed = stored.filter("processing_date >= date'2024-01-04' and token_address % 3 = 0 and token_address % 11 <> 5").withColumns(
        {"symbol": F.concat("symbol", F.lit("!")), "liquidity": F.col("liquidity") + 1, "ingest": F.lit(2)}
    )
    added = stored.filter("processing_date = date'2024-01-04' and token_address % 7 = 0").withColumns(
        {"token_address": -F.col("token_address"), "ingest": F.lit(2)}
    )
    moved = stored.filter("token_address % 11 = 5").withColumns({"processing_date": F.lit("2024-02-01").cast("date"), "ingest": F.lit(3)})
    undated = stored.filter("token_address = 13").withColumn("ingest", F.lit(4))
    lake.merge("tokens", changed.unionByName(added).unionByName(moved).unionByName(undated))
    return lake.read("tokens")


def _stored_by_flag(spark, sf_dir):
    """Order lines with one file per return flag."""
    path = fresh_path(spark, "lines-by-flag")
    T.write_file_per_partition(A.table(spark, sf_dir, "lineitem"), path, ["l_returnflag"])
    return I.age_report(I.stored_files(spark, path), "bronze", F.lit("2040-01-01").cast("date"))


@query("""SELECT 'bronze' AS layer, 'over_365_days' AS age_band, n AS files, n AS compress_due, n AS archive_due, n AS delete_due
    FROM (SELECT count(DISTINCT l_returnflag) AS n FROM lineitem)""")
def storage_age(spark, sf_dir):
    return _stored_by_flag(spark, sf_dir).filter("bytes > 0").drop("bytes")


@query("""SELECT 'bronze' AS layer, round(n * 0.3, 2)::DOUBLE AS compress_mb, round(n * 0.7, 2)::DOUBLE AS archive_mb, true AS frees_space
    FROM (SELECT count(DISTINCT l_returnflag) AS n FROM lineitem)""")
def storage_savings(spark, sf_dir):
    saved = I.saving_estimate(_stored_by_flag(spark, sf_dir))
    both = [F.col(c).cast("double").alias(c) for c in ("compress_mb", "archive_mb")]
    return saved.select("layer", *both, (F.col("delete_mb") > 0).alias("frees_space"))


# --- streams ---------------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    return ST.file_source(spark, f"{sf_dir}/events*.parquet", events(spark, sf_dir).schema)


@query("SELECT strftime(ts, '%Y-%m-%d') AS processing_date, strftime(ts, '%H') AS processing_hour, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL")
def stream_landing(spark, sf_dir):
    path, checkpoint = fresh_path(spark, "landed"), fresh_path(spark, "landed-checkpoint")
    ST.land(ST.with_partitions(_event_stream(spark, sf_dir), F.col("ts")), path, checkpoint, every=None).awaitTermination()
    stored = spark.read.schema("event_id bigint, processing_date string, processing_hour string").parquet(path)
    return stored.groupBy("processing_date", "processing_hour").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT DISTINCT event_id // 4 AS message FROM events")
def stream_once_per_key(spark, sf_dir):
    path, checkpoint = fresh_path(spark, "single"), fresh_path(spark, "single-checkpoint")
    at = F.col("ts").cast("timestamp").alias("ts")
    keyed = _event_stream(spark, sf_dir).select(F.floor(F.col("event_id") / 4).alias("message"), at)
    ST.run_to_end(ST.once_per_key(keyed, ["message"], "ts"), path, checkpoint)
    return spark.read.parquet(path).select("message")


@query("""SELECT * FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, round(sum(value), 2) AS volume, count(*) AS n FROM events GROUP BY ALL)
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_windowed_volume(spark, sf_dir):
    path, checkpoint = fresh_path(spark, "volume"), fresh_path(spark, "volume-checkpoint")
    stream = _event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    ST.run_to_end(ST.windowed_volume(stream, "ts", "event_type", "value", "1 hour", "10 minutes"), path, checkpoint)
    start = F.col("window_start").cast("timestamp_ntz")
    return spark.read.parquet(path).withColumns({"volume": F.round("volume", 2), "window_start": start})

"""Queries for as-of joins, versions that share partitions, Z-order files, streaming upserts and resumed results."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import resume
from tidemark.operators.asof import asof_join
from tidemark.operators.relational import differences
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_pnl import trades
from tidemark.plans.registry import query, rounded
from tidemark.session import cut_lineage, fresh_path
from tidemark.sources import tables as T
from tidemark.sources.snapshots import SharedPartitions
from tidemark.streaming import alerts
from tidemark.streaming import landing as ST
from tidemark.streaming.upserts import upsert_stream

NOON = datetime(2024, 2, 1, 12)


# --- as-of joins ------------------------------------------------------------------------

_SHIPPED = """shipped AS (SELECT o_custkey, l_shipdate AS moment, max(l_extendedprice) AS largest, count(*) AS lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def _orders_and_shipments(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("moment"))
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    shipped = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", F.col("l_shipdate").alias("moment"))
    return orders, shipped.agg(F.max("l_extendedprice").alias("largest"), F.count(F.lit(1)).alias("lines"))


@query(f"""WITH {_SHIPPED} SELECT o_orderkey, orders.o_custkey, o_orderdate AS moment, shipped.moment AS shipped_at, largest, lines
    FROM orders ASOF LEFT JOIN shipped ON orders.o_custkey = shipped.o_custkey AND orders.o_orderdate >= shipped.moment""")
def asof_shipments(spark, sf_dir):
    """Each order with the last day before it on which its customer was shipped something."""
    orders, shipped = _orders_and_shipments(spark, sf_dir)
    return asof_join(orders, shipped, ["o_custkey"], "moment", right_on="shipped_at")


@query("""WITH last AS (SELECT ts AS moment, max(event_id) AS event_id FROM events GROUP BY ts)
    SELECT l_orderkey, l_linenumber, moment, event_id FROM (SELECT l_orderkey, l_linenumber, TIMESTAMP '2024-01-01' + to_seconds(l_orderkey * 60) AS due FROM lineitem)
    ASOF JOIN last ON due >= moment WHERE moment >= due - INTERVAL 10 MINUTE""")
def asof_events_within(spark, sf_dir):
    """Without keys, within ten minutes, ties by the largest id."""
    at = (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("l_orderkey").cast("int"))).alias("at")
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", at)
    events = A.table(spark, sf_dir, "events").select(F.col("ts").alias("at"), "event_id")
    found = asof_join(lines, events, [], "at", F.expr("INTERVAL 10 MINUTES"), ties=["event_id"], how="inner", right_on="moment")
    return found.select("l_orderkey", "l_linenumber", "moment", "event_id")


# --- versions that share partitions --------------------------------------------------------


def _orders_by_year(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    table = SharedPartitions(spark, fresh_path(spark, "orders-by-year"), orders.schema, ["year"])
    table.create(orders, NOON)
    changed = orders.filter("year = 1996").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = orders.filter("year = 1996 and o_orderkey % 5 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    table.merge(changed.unionByName(added), ["o_orderkey"], NOON)
    table.merge(orders.filter("year = 1997").withColumn("year", F.lit(2030)), ["o_orderkey"], NOON)
    return table


@query("""WITH o AS (SELECT *, year(o_orderdate)::INT AS year FROM orders)
    SELECT o_orderkey, CASE WHEN year = 1996 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN year = 1997 THEN 2030 ELSE year END::INT AS year FROM o
    UNION ALL SELECT -o_orderkey - 1, o_totalprice, year FROM o WHERE year = 1996 AND o_orderkey % 5 = 0""")
def shared_partition_merge(spark, sf_dir):
    return _orders_by_year(spark, sf_dir).read().select("o_orderkey", "o_totalprice", "year")


@query("SELECT o_orderkey, o_totalprice, year(o_orderdate)::INT AS year FROM orders WHERE year(o_orderdate) IN (1996, 1997)")
def shared_partition_version(spark, sf_dir):
    """The first version, two of its partitions read."""
    return _orders_by_year(spark, sf_dir).read(version=0, where=F.col("year").isin(1996, 1997)).select("o_orderkey", "o_totalprice", "year")


@query("""WITH o AS (SELECT *, year(o_orderdate) AS year FROM orders), y AS (SELECT count(DISTINCT year) AS years, count(*) AS n, count(*) FILTER (year = 1996 AND o_orderkey % 5 = 0) AS more FROM o)
    SELECT v AS version, CASE v WHEN 0 THEN n ELSE n + more END AS n_rows, CASE v WHEN 0 THEN years ELSE 1 END AS n_folders_written FROM y, range(3) AS t(v)""")
def shared_partition_history(spark, sf_dir):
    """A merge that touches one partition writes one."""
    return _orders_by_year(spark, sf_dir).history().select("version", "n_rows", "n_folders_written")


# --- files along a Z-order curve ------------------------------------------------------------


@query("SELECT l_partkey, l_suppkey, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'")
def z_ordered_scan(spark, sf_dir):
    """A filter on the third clustering column of Z-ordered files."""
    path = fresh_path(spark, "lines-z")
    T.compact(spark, f"{sf_dir}/lineitem.parquet", path, ["l_partkey", "l_suppkey", "l_shipdate"], file_bytes=1 << 20, curve="z")
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-03-31"))
    return spark.read.parquet(path).filter(F.col("l_shipdate").between(first, last)).select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")


# --- streaming upsert -------------------------------------------------------------------------


@query("SELECT event_id // 3 AS message, arg_max(value, event_id) AS value, max(ts) AS ts, count(*) FILTER (false) AS repeats FROM events GROUP BY 1")
def stream_upsert(spark, sf_dir):
    """Landed files merged batch by batch in any order, each message kept as it was last."""
    landed, root, checkpoint = (fresh_path(spark, x) for x in ("landed", "messages", "messages-checkpoint"))
    rows = A.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 3).alias("message"), "event_id", "value", "ts", F.to_date("ts").alias("day"))
    rows.repartition(6).write.parquet(landed)
    table = SharedPartitions(spark, root, rows.schema, ["day"])
    upsert_stream(ST.file_source(spark, landed, rows.schema, max_files=3), table, ["message"], ["event_id"], checkpoint, "messages", NOON).awaitTermination()
    now = table.read()
    twice = now.groupBy("message").agg(F.count(F.lit(1)).alias("n")).select("message", (F.col("n") - 1).alias("repeats"))
    return now.join(twice, "message").select("message", "value", "ts", "repeats")


# --- resumed results -----------------------------------------------------------------------------


@query(using("trades") + """, moved AS (SELECT * FROM trades WHERE side IN ('BUY', 'SELL')
), levels AS (
    SELECT *, sum(CASE WHEN side = 'BUY' THEN usd END) OVER w / nullif(sum(CASE WHEN side = 'BUY' THEN quantity END) OVER w, 0) AS unit
    FROM moved WINDOW w AS (PARTITION BY wallet_address, token_address ORDER BY trade_time RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT wallet_address, token_address, round(coalesce(sum(CASE WHEN side = 'SELL' THEN coalesce(usd - quantity * unit, 0) END), 0), 2) AS realized_pnl,
    round(coalesce(sum(CASE WHEN side = 'BUY' THEN usd END), 0), 2) AS bought_usd, count(*) FILTER (side = 'SELL') AS sell_count
FROM levels GROUP BY ALL""")
def resumed_running_cost(spark, sf_dir):
    """Four increments, with late rows in the later ones, end where one run over all trades does."""
    all_trades = trades(spark, sf_dir)
    store = resume.RunningCost(spark, fresh_path(spark, "running-cost"))
    part = F.pmod(F.xxhash64("trade_id"), F.lit(100))
    # Most trades come in order of time, a few in a later increment.
    step = F.least(F.lit(3), F.greatest(F.lit(0), F.floor(F.datediff("trade_time", F.lit("2024-01-01")) / 8)) + F.when(part < 3, 1).otherwise(0))
    arrived = cut_lineage(all_trades.withColumn("step", step))  # read once per increment
    for i in range(4):
        store.add(arrived.filter(F.col("step") == i).drop("step"))
    found = store.results().select("wallet_address", "token_address", "realized_pnl", "bought_usd", "sell_count")
    return rounded(found, 2, "realized_pnl", "bought_usd")


# --- alerts on a stream, comparison of nearly equal tables ------------------------------------


@query(using("trades") + """, w AS (SELECT time_bucket(INTERVAL 1 HOUR, trade_time, TIMESTAMP '1970-01-01') AS window_start, token_address, sum(usd) AS volume,
        sum(usd) / sum(quantity) AS price, max(usd) AS largest_trade FROM trades GROUP BY ALL),
  l AS (SELECT *, lag(window_start) OVER t AS start_before, lag(volume) OVER t AS last_volume, lag(price) OVER t AS last_price
        FROM w WINDOW t AS (PARTITION BY token_address ORDER BY window_start)),
  j AS (SELECT * EXCLUDE (start_before, last_volume, last_price), CASE WHEN start_before >= window_start - INTERVAL 1 DAY THEN last_volume END AS volume_before,
        CASE WHEN start_before >= window_start - INTERVAL 1 DAY THEN last_price END AS price_before FROM l),
  f AS (SELECT *, coalesce(volume >= volume_before * 3, false) AS volume_spike,
        coalesce(abs((price - price_before) / price_before) * 100 >= 20, false) AS price_move, largest_trade >= 50000 AS whale_trade FROM j)
  SELECT window_start, token_address, round(volume, 4) AS volume, round(price, 6) AS price, largest_trade, round(volume_before, 4) AS volume_before,
    round(price_before, 6) AS price_before, volume_spike, price_move, whale_trade FROM f
  WHERE (volume_spike OR price_move OR whale_trade)
    AND window_start + INTERVAL 1 HOUR <= (SELECT max(trade_time) - INTERVAL 10 MINUTE - INTERVAL 1 DAY FROM trades)""")
def stream_activity_alerts(spark, sf_dir):
    """Alerts from a stream of trade files; the windows of the last day are not judged yet."""
    landed, path, checkpoint = (fresh_path(spark, f"alerts-{part}") for part in ("trades", "out", "checkpoint"))
    at = F.col("trade_time").cast("timestamp").alias("trade_time")
    trades(spark, sf_dir).select(at, "token_address", "usd", "quantity").write.parquet(landed)
    stream = ST.file_source(spark, landed, spark.read.parquet(landed).schema)
    ST.run_to_end(alerts.activity_alerts(stream, "1 hour", "10 minutes", "1 day"), path, checkpoint)
    judged = rounded(rounded(spark.read.parquet(path), 4, "volume", "volume_before"), 6, "price", "price_before")
    return judged.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_CHANGED = "CASE WHEN l_orderkey % 997 = 5 THEN l_quantity + 1 ELSE l_quantity END"
_COMPARED = "l_orderkey, l_linenumber, l_shipdate"


@query(f"""WITH a AS (SELECT {_COMPARED}, l_quantity FROM lineitem WHERE l_orderkey % 1009 <> 3), b AS (SELECT {_COMPARED}, {_CHANGED} AS l_quantity FROM lineitem)
    SELECT *, 'a_minus_b' AS which_diff FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'b_minus_a' FROM (FROM b EXCEPT FROM a)""")
def nearly_equal_tables(spark, sf_dir):
    """Rows by which two copies of a table differ, found from digests of buckets."""
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    changed = lines.withColumn("l_quantity", F.expr(_CHANGED).cast(lines.schema["l_quantity"].dataType))
    return differences(lines.filter("l_orderkey % 1009 <> 3"), changed)

"""Queries for joins, set operations, scalar functions and generic transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as C
from tidemark.operators import relational as R
from tidemark.operators.ordered import keep_latest, top_n
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_pnl import trades
from tidemark.plans.registry import query, rounded

# --- joins ------------------------------------------------------------------------------


@query("""SELECT c_custkey, c_mktsegment, n_orders, latest FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS latest FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
def left_join_latest(spark, sf_dir):
    latest = A.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("latest"))
    customers = A.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def semi_join_members(spark, sf_dir):
    large = A.table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") >= 49).select(F.col("l_partkey").alias("p_partkey"))
    return A.table(spark, sf_dir, "part").select("p_partkey", "p_brand").join(large, "p_partkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_join_missing(spark, sf_dir):
    done = A.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return A.table(spark, sf_dir, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("""SELECT coalesce(nation_a, nation_b) AS nation, count_a, count_b FROM (SELECT c_nationkey AS nation_a, count(*) AS count_a FROM customer GROUP BY 1)
    FULL JOIN (SELECT s_nationkey AS nation_b, count(*) AS count_b FROM supplier GROUP BY 1) ON nation_a = nation_b""")
def full_join_counts(spark, sf_dir):
    a = A.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("count_a"))
    b = A.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("count_b"))
    return a.join(b, "nation", "full")


@query("SELECT count(DISTINCT d.doc_id) AS matched, (SELECT count(DISTINCT doc_id) FROM labels) AS labels FROM documents d JOIN labels l USING (doc_id)")
def join_integrity(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("doc_id", F.lit(True).alias("known"))
    labels = A.table(spark, sf_dir, "labels").select("doc_id").distinct()
    return labels.join(docs, "doc_id", "left").agg(
        F.count_distinct(F.when(F.col("known"), F.col("doc_id"))).alias("matched"), F.count_distinct("doc_id").alias("labels")
    )


# --- set operations -------------------------------------------------------------------------


@query("""SELECT 'a_minus_b' AS which_diff, * FROM (SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer WHERE c_acctbal > 9000
      EXCEPT SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0
      EXCEPT SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000)""")
def symmetric_difference(spark, sf_dir):
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    rich, poor = rows.filter("c_acctbal > 9000"), rows.filter("c_acctbal < 0")
    return R.symmetric_difference(rich, poor, ["nation", "segment"])


@query("""SELECT name, kind, count(*) AS n FROM (SELECT c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier
    UNION ALL SELECT n_name, 'nation' FROM nation) GROUP BY ALL""")
def union_all_names(spark, sf_dir):
    sources = (("customer", "c_name"), ("supplier", "s_name"), ("nation", "n_name"))
    parts = [A.table(spark, sf_dir, t).select(F.col(c).alias("name"), F.lit(t).alias("kind")) for t, c in sources]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) = 1""")
def keep_latest_line(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    order = [F.desc("l_shipdate"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]
    return keep_latest(A.table(spark, sf_dir, "lineitem").select(*columns), ["l_orderkey"], order).drop("l_shipdate")


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def latest_rows(spark, sf_dir):
    return top_n(A.table(spark, sf_dir, "events").select("event_id", "ts"), [F.desc("ts"), F.desc("event_id")], 25).drop("row_rank")


@query("SELECT DISTINCT source, lang FROM documents WHERE source <> ''")
def distinct_sources(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").filter("source <> ''").select("source", "lang").distinct()


# --- pivot and unpivot ---------------------------------------------------------------------------


@query("""SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS n_click, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS n_view,
    sum(CASE WHEN event_type = 'it''s' THEN 1 ELSE 0 END)::BIGINT AS "n_it's" FROM events GROUP BY user_id""")
def pivot_counts(spark, sf_dir):
    columns = R.pivot_columns("event_type", ["click", "view", "it's"], prefix="n_")
    return A.table(spark, sf_dir, "events").groupBy("user_id").agg(*columns)


@query("""SELECT l_returnflag, max(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS o_max, max(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS f_max,
    count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_suppkey END) AS o_suppliers, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS f_suppliers
    FROM lineitem GROUP BY l_returnflag""")
def pivot_max_and_distinct(spark, sf_dir):
    largest = R.pivot_columns("l_linestatus", ["O", "F"], agg="max", suffix="_max", then_value=F.col("l_quantity"), else_value=0.0, slugs=True)
    suppliers = R.pivot_columns(
        "l_linestatus", ["O", "F"], agg="count", suffix="_suppliers", then_value=F.col("l_suppkey"), else_value=None, distinct=True, slugs=True
    )
    return A.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*largest, *suppliers)


@query("""SELECT n_nationkey, n_name, sum(n0)::BIGINT AS n0, sum(n1)::BIGINT AS n1, sum(n2)::BIGINT AS n2, sum(n3)::BIGINT AS n3, sum(n4)::BIGINT AS n4 FROM (
      SELECT c_nationkey, CASE WHEN c_mktsegment = s[1] THEN 1 ELSE 0 END AS n0, CASE WHEN c_mktsegment = s[2] THEN 1 ELSE 0 END AS n1, CASE WHEN c_mktsegment = s[3] THEN 1 ELSE 0 END AS n2,
        CASE WHEN c_mktsegment = s[4] THEN 1 ELSE 0 END AS n3, CASE WHEN c_mktsegment = s[5] THEN 1 ELSE 0 END AS n4
      FROM customer, (SELECT list(c_mktsegment ORDER BY n DESC, c_mktsegment) AS s FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)))
    JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def pivot_found_values(spark, sf_dir):
    customers = A.table(spark, sf_dir, "customer")
    found = R.column_value_list(customers, "c_mktsegment", 5)
    columns = [c.alias(f"n{i}") for i, c in enumerate(R.pivot_columns("c_mktsegment", found))]
    nations = A.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name").agg(*columns)


@query("""SELECT o_orderkey, field_name, value FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderstatus AS VARCHAR) AS o_orderstatus,
      CAST(o_totalprice > 100000 AS VARCHAR) AS is_large FROM orders) UNPIVOT INCLUDE NULLS (value FOR field_name IN (o_custkey, o_orderstatus, is_large))""")
def unpivot_orders(spark, sf_dir):
    rows = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") > 100_000).alias("is_large"), "o_orderpriority"
    )
    return R.unpivot(rows, exclude=["o_orderkey"], remove=["O_ORDERPRIORITY"])


# --- union by name --------------------------------------------------------------------------------


@query("""SELECT 'customer' AS origin, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS s_suppkey FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL, s_suppkey FROM supplier WHERE s_acctbal > 0""")
def union_relations(spark, sf_dir):
    customers = A.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = A.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return R.union_relations(
        {"customer": customers, "supplier": suppliers}, exclude=["C_CUSTKEY"], source_column_name="origin", where="balance > 0"
    )


@query("SELECT 'tidemark_part_a' AS source_relation, p_partkey, p_brand FROM part WHERE p_size < 10 UNION ALL SELECT 'tidemark_part_b', p_partkey, NULL FROM part WHERE p_size > 40")
def union_tables_by_pattern(spark, sf_dir):
    part = A.table(spark, sf_dir, "part")
    part.filter("p_size < 10").select("p_partkey", "p_brand").createOrReplaceTempView("tidemark_part_a")
    part.filter("p_size > 40").select("p_partkey").createOrReplaceTempView("tidemark_part_b")
    part.createOrReplaceTempView("tidemark_part_old")
    return R.union_tables_like(spark, "TIDEMARK_PART%", exclude="%_OLD")


# --- series -----------------------------------------------------------------------------------------


@query("""WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) - 1, INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders)
    SELECT date_day, count(o_orderkey) AS n_orders FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_day GROUP BY date_day""")
def date_spine_orders(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    span = orders.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last")).first()
    daily = orders.groupBy("date_day").agg(F.count(F.lit(1)).alias("n"))
    spine = R.date_spine(spark, "day", str(span["first"]), str(span["last"]))
    return spine.join(daily, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("""WITH n AS (SELECT unnest(generate_series(1, (SELECT max(l_quantity)::BIGINT + 5 FROM lineitem))) AS generated_number)
    SELECT generated_number, count(l_orderkey) AS n_lines FROM n LEFT JOIN lineitem ON l_quantity = generated_number GROUP BY 1""")
def number_series(spark, sf_dir):
    lines = A.table(spark, sf_dir, "lineitem")
    upper = int(R.single_value(lines.agg(F.max("l_quantity")), 0)) + 5
    counted = lines.groupBy(F.col("l_quantity").cast("bigint").alias("generated_number")).agg(F.count(F.lit(1)).alias("n"))
    series = R.generate_series(spark, upper)
    return series.join(counted, "generated_number", "left").select("generated_number", F.coalesce("n", F.lit(0)).alias("n_lines"))


# --- rows and columns -----------------------------------------------------------------------------------


@query("SELECT * EXCLUDE (p_type) FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_retailprice DESC, p_partkey) = 1")
def deduplicated_parts(spark, sf_dir):
    kept = R.deduplicate(A.table(spark, sf_dir, "part"), ["p_brand", "p_size"], [F.desc("p_retailprice"), F.asc("p_partkey")])
    return kept.select(*R.star(kept, exclude=["P_TYPE"]))


@query(using("swaps") + """SELECT transaction_hash, md5(transaction_hash || '-' || coalesce(base_symbol, '_dbt_utils_surrogate_key_null_') || '-' || base_address) AS key,
    md5(coalesce(base_symbol, '') || '-' || base_address) AS plain_key FROM swaps""")
def surrogate_keys(spark, sf_dir):
    return A.swaps(spark, sf_dir).select(
        "transaction_hash",
        C.surrogate_key("transaction_hash", "base_symbol", "base_address").alias("key"),
        C.surrogate_key("base_symbol", "base_address", null_text="").alias("plain_key"),
    )


@query("SELECT c_custkey AS c_custkey_x, c_nationkey AS c_nationkey_x, c_acctbal AS c_acctbal_x FROM customer")
def star_with_suffix(spark, sf_dir):
    customers = A.table(spark, sf_dir, "customer")
    return customers.select(*R.star(customers, exclude=["C_NAME", "c_mktsegment"], suffix="_x"))


@query("SELECT p_brand AS value, count(*) AS n_rows FROM part WHERE p_size > 5 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12")
def column_values(spark, sf_dir):
    return R.column_values(A.table(spark, sf_dir, "part"), "p_brand", max_records=12, where="p_size > 5")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders) * 0.95")
def single_value_filter(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders")
    peak = R.single_value(orders.agg(F.max("o_totalprice")), 0.0)
    return orders.filter(F.col("o_totalprice") >= peak * 0.95).select("o_orderkey", "o_totalprice")


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY ALL")
def group_by_first(spark, sf_dir):
    lines = A.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return R.group_by_first(lines, 2).agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))


# --- scalar functions ---------------------------------------------------------------------------------------


@query(using("tokens") + """SELECT token_address, ingest, coalesce(volume_1h_usd, 0) + coalesce(volume_24h_usd, 0) + coalesce(market_cap, 0) AS added,
    coalesce(volume_24h_usd, 0) - coalesce(volume_1h_usd, 0) AS less, volume_24h_usd / nullif(market_cap, 0) AS share,
    abs(price_change_24h_percent) AS size, greatest(price_change_2h_percent, price_change_4h_percent) AS best, nullif(trade_24h_count, 0) AS trades FROM tokens""")
def safe_arithmetic(spark, sf_dir):
    day, hour, cap = F.col("volume_24h_usd"), F.col("volume_1h_usd"), F.col("market_cap")
    return A.tokens(spark, sf_dir).select(
        "token_address", "ingest", C.safe_add(hour, day, cap).alias("added"), C.safe_subtract(day, hour).alias("less"),
        C.safe_divide(day, cap).alias("share"), F.abs("price_change_24h_percent").alias("size"),
        F.greatest("price_change_2h_percent", "price_change_4h_percent").alias("best"),
        F.nullif(F.col("trade_24h_count"), F.lit(0)).alias("trades"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_quantity, ((CASE WHEN CAST(l_quantity AS DECIMAL(28,6)) % CAST(8 AS DECIMAL(28,6)) = 0 THEN 1 ELSE 0 END)
    + least(ceil((l_quantity - 2) / 8), 6))::BIGINT AS bucket FROM lineitem""")
def width_buckets(spark, sf_dir):
    bucket = C.width_bucket(F.col("l_quantity"), F.lit(2.0), F.lit(42.0), 5)
    return A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", bucket.cast("bigint").alias("bucket"))


@query("""WITH p AS (SELECT event_id, user_id % 90 AS lat1, event_id % 180 AS lon1, value / 2 AS lat2, -value AS lon2 FROM events),
    d AS (SELECT event_id, 2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2)
      + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2))) AS mi FROM p)
    SELECT event_id, round(mi, 4) AS miles, round(mi * 1.60934, 4) AS km FROM d""")
def haversine_distances(spark, sf_dir):
    at = [F.col("user_id") % 90, F.col("event_id") % 180, F.col("value") / 2, -F.col("value")]
    points = A.table(spark, sf_dir, "events").select(
        "event_id", C.haversine(*at).alias("miles"), C.haversine(*at, unit="km").alias("km")
    )
    return rounded(points, 4, "miles", "km")


@query("""WITH u AS (SELECT page_id, url, replace(replace(url, 'http://', ''), 'https://', '') AS rest FROM pages)
    SELECT page_id, split_part(split_part(replace(rest, 'android-app://', ''), '/', 1), '?', 1) AS host,
           split_part(right(rest, length(rest) - coalesce(nullif(position('/' IN rest), 0), position('?' IN rest) - 1)), '?', 1) AS path,
           nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM u""")
def url_parts(spark, sf_dir):
    url = F.col("url")
    return A.table(spark, sf_dir, "pages").select(
        "page_id", C.url_host(url).alias("host"), C.url_path(url).alias("path"), C.url_parameter(url, "ref").alias("ref"),
        C.url_parameter_exact(url, "page").alias("page"),
    )


@query(using("tokens") + "SELECT token_address, ingest, nullif(logo_uri, '') AS logo_uri, nullif(name, '') AS name FROM tokens")
def blanks_to_null(spark, sf_dir):
    return C.blank_to_null(A.tokens(spark, sf_dir).select("token_address", "ingest", "logo_uri", "name"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(t), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug
    FROM (SELECT p_partkey, (p_size % 3) || ' ' || p_name || ' - ' || p_brand AS t FROM part)""")
def slugs(spark, sf_dir):
    text = F.concat((F.col("p_size") % 3).cast("string"), F.lit(" "), F.col("p_name"), F.lit(" - "), F.col("p_brand"))
    return A.table(spark, sf_dir, "part").select("p_partkey", C.slugify(text).alias("slug"))


@query("""SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) AS INTEGER) AS dow, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%H') AS hour_text,
    CAST(date_diff('day', DATE '2024-01-01', ts) AS INTEGER) AS days_in, substr(event_type, 1, 3) || '_' || user_id AS label,
    TIMESTAMP '1970-01-01 00:00:00' + to_seconds(1700000000 + event_id) AS moment FROM events""")
def time_parts(spark, sf_dir):
    ts = F.col("ts")
    return A.table(spark, sf_dir, "events").select(
        "event_id", F.to_date(ts).alias("day"), F.hour(ts).alias("hour"), C.day_of_week(ts).alias("dow"), F.year(ts).alias("year"),
        F.month(ts).alias("month"), F.date_format(ts, "yyyy-MM-dd").alias("day_text"), F.date_format(ts, "HH").alias("hour_text"),
        F.datediff(ts, F.lit("2024-01-01").cast("date")).alias("days_in"),
        F.concat(F.substring("event_type", 1, 3), F.lit("_"), F.col("user_id")).alias("label"),
        C.unix_time(F.lit(1_700_000_000) + F.col("event_id")).alias("moment"),
    )


@query(using("trades") + """SELECT wallet_address, arg_max(token_address, (CAST(trade_time AS DATE), trade_id)) AS last_token,
    arg_min(token_address, (CAST(trade_time AS DATE), trade_id)) AS first_token FROM trades GROUP BY 1""")
def argmax_token(spark, sf_dir):
    # Days instead of moments, so that trades share a time and the id decides.
    at = F.struct(F.to_date("trade_time"), "trade_id")
    return trades(spark, sf_dir).groupBy("wallet_address").agg(
        F.max_by("token_address", at).alias("last_token"), F.min_by("token_address", at).alias("first_token")
    )

"""Queries that run the data tests on the given tables.  Each returns the failing rows or counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import market as M
from tidemark.operators import checks as K
from tidemark.operators import traders
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.query_pnl import portfolios
from tidemark.plans.query_pnl import _GOLD_COLUMNS
from tidemark.plans.registry import query


def load(spark, sf_dir, name, *columns):
    df = A.table(spark, sf_dir, name)
    return df.select(*columns) if columns else df


@query(using("tokens") + "SELECT token_address, ingest FROM tokens WHERE symbol IS NULL AND liquidity > 100000")
def check_not_null(spark, sf_dir):
    return K.not_null(A.tokens(spark, sf_dir), "symbol", "liquidity > 100000").select("token_address", "ingest")


@query("SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return K.unique(load(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') GROUP BY 1")
def check_accepted_values(spark, sf_dir):
    return K.accepted_values(load(spark, sf_dir, "events"), "event_type", ["click", "view", "purchase"])


@query("SELECT DISTINCT lang AS value_field FROM documents WHERE lang IN ('en', 'xx')")
def check_not_accepted_values(spark, sf_dir):
    return K.not_accepted_values(load(spark, sf_dir, "documents"), "lang", ["en", "xx"])


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9500")
def check_accepted_range(spark, sf_dir):
    return K.accepted_range(load(spark, sf_dir, "customer", "c_custkey", "c_acctbal"), "c_acctbal", 0, 9500)


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT (l_discount > 0.0 AND l_discount < 0.1)")
def check_open_range(spark, sf_dir):
    return K.accepted_range(load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_discount"), "l_discount", 0.0, 0.1, inclusive=False)


@query(using("tokens") + "SELECT token_address, ingest, trim(logo_uri) AS logo_uri FROM tokens WHERE trim(logo_uri) = ''")
def check_not_empty_string(spark, sf_dir):
    return K.not_empty_string(A.tokens(spark, sf_dir).select("token_address", "ingest", "logo_uri"), "logo_uri")


@query("SELECT doc_id, source FROM documents WHERE trim(text) = '' OR NOT (n_chars >= 100)")
def check_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    short = K.expression_is_true(docs, ">= 100", column="n_chars")
    return K.not_empty_string(docs, "text").unionByName(short).select("doc_id", "source").distinct()


@query("SELECT o_orderkey FROM orders WHERE NOT (o_totalprice > 1000 AND o_orderstatus <> 'P')")
def check_expression(spark, sf_dir):
    return K.expression_is_true(load(spark, sf_dir, "orders"), "o_totalprice > 1000 AND o_orderstatus <> 'P'").select("o_orderkey")


@query(using("tokens") + "SELECT token_address, count(price_change_1h_percent) AS n_values FROM tokens GROUP BY 1 HAVING count(price_change_1h_percent) = 0")
def check_at_least_one(spark, sf_dir):
    return K.at_least_one(A.tokens(spark, sf_dir), "price_change_1h_percent", ["token_address"])


@query("SELECT o_custkey, 1::BIGINT AS n_distinct FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1")
def check_not_constant(spark, sf_dir):
    return K.not_constant(load(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query(using("tokens") + """SELECT processing_date, round(count(symbol) / count(*), 9) AS not_null_proportion FROM tokens GROUP BY 1
    HAVING count(symbol) / count(*) < 0.98 OR count(symbol) / count(*) > 1""")
def check_not_null_proportion(spark, sf_dir):
    found = K.not_null_proportion(A.tokens(spark, sf_dir), "symbol", 0.98, group_by=["processing_date"])
    return found.withColumn("not_null_proportion", F.round("not_null_proportion", 9))


@query("""SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""")
def check_recency(spark, sf_dir):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    return K.recency(load(spark, sf_dir, "events"), "ts", "day", 1, now, group_by=["user_id"])


@query("""SELECT * FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber FROM lineitem)
    WHERE l_linenumber <> previous_l_linenumber + 1""")
def check_sequential_in_group(spark, sf_dir):
    return K.sequential_values(load(spark, sf_dir, "lineitem"), "l_linenumber", group_by=["l_orderkey"], stored=True)


@query("""SELECT * FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous_o_orderkey FROM orders SEMI JOIN
    (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 3) ON o_orderkey = l_orderkey) WHERE o_orderkey <> previous_o_orderkey + 1""")
def check_sequential(spark, sf_dir):
    large = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").count().filter("count > 3")
    orders = load(spark, sf_dir, "orders")
    return K.sequential_values(orders.join(large, orders["o_orderkey"] == large["l_orderkey"], "left_semi"), "o_orderkey")


@query("""SELECT * FROM (SELECT day, lag(day) OVER (ORDER BY day) AS previous_day FROM (SELECT l_shipdate AS day FROM lineitem GROUP BY 1 HAVING sum(l_quantity) % 2 = 0))
    WHERE day <> previous_day + INTERVAL 1 DAY""")
def check_sequential_days(spark, sf_dir):
    days = load(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("n")).filter("n % 2 = 0").select("day")
    return K.sequential_values(days, "day", datepart="day")


_RANGES = """WITH r AS (SELECT o_custkey, o_orderdate AS lower_bound, o_orderdate + to_days(CAST(o_orderkey % 200 AS INTEGER)) AS upper_bound FROM orders),
    w AS (SELECT *, lead(lower_bound) OVER t AS next_lower_bound, lead(true) OVER t IS NULL AS is_last FROM r
          WINDOW t AS (PARTITION BY o_custkey ORDER BY lower_bound, upper_bound))
    SELECT o_custkey, lower_bound, upper_bound, next_lower_bound FROM w"""


def _ranges(spark, sf_dir):
    length = F.make_dt_interval(days=(F.col("o_orderkey") % 200).cast("int"))
    return load(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").alias("starts"), (F.col("o_orderdate") + length).alias("ends"))


@query(_RANGES + " WHERE NOT (lower_bound < upper_bound AND coalesce(upper_bound <= next_lower_bound, is_last))")
def check_exclusive_ranges(spark, sf_dir):
    return K.mutually_exclusive_ranges(_ranges(spark, sf_dir), "starts", "ends", ["o_custkey"], stored=True)


@query(_RANGES + " WHERE NOT (lower_bound <= upper_bound AND coalesce(upper_bound < next_lower_bound, is_last))")
def check_ranges_with_gaps(spark, sf_dir):
    return K.mutually_exclusive_ranges(_ranges(spark, sf_dir), "starts", "ends", ["o_custkey"], gaps="required", zero_length=True, stored=True)


@query("""WITH w AS (SELECT ts AS lower_bound, ts + INTERVAL 5 MINUTE AS upper_bound, lead(ts) OVER (ORDER BY ts, ts + INTERVAL 5 MINUTE) AS next_lower_bound FROM events)
    SELECT * FROM w WHERE NOT coalesce(upper_bound <= next_lower_bound, next_lower_bound IS NULL)""")
def check_exclusive_ranges_overall(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select(F.col("ts").alias("starts"), (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("ends"))
    return K.mutually_exclusive_ranges(rows, "starts", "ends")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_unique_combination(spark, sf_dir):
    return K.unique_combination(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT doc_id AS id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def check_relationships(spark, sf_dir):
    return K.relationships(load(spark, sf_dir, "labels"), "doc_id", load(spark, sf_dir, "documents"), "doc_id", parent_where="n_chars > 500")


@query("SELECT l_suppkey AS id FROM lineitem WHERE l_quantity > 45 AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 5000)")
def check_relationships_where(spark, sf_dir):
    return K.relationships(
        load(spark, sf_dir, "lineitem"), "l_suppkey", load(spark, sf_dir, "supplier"), "s_suppkey", "l_quantity > 45", "s_acctbal > 5000"
    )


@query("""WITH a AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS value, count(*) AS num_rows FROM supplier GROUP BY 1)
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_cardinality_equality(spark, sf_dir):
    return K.cardinality_equality(load(spark, sf_dir, "customer"), "c_nationkey", load(spark, sf_dir, "supplier"), "s_nationkey")


@query("""WITH a AS (SELECT p_brand, p_type FROM part WHERE p_size < 10), b AS (SELECT p_brand, p_type FROM part WHERE p_size > 42)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_equality(spark, sf_dir):
    part = load(spark, sf_dir, "part", "p_brand", "p_type", "p_size")
    return K.equality(part.filter("p_size < 10"), part.filter("p_size > 42"), ["p_brand", "p_type"])


@query("""WITH a AS (SELECT p_brand, p_type FROM part WHERE p_size < 10), b AS (SELECT p_brand, p_type FROM part WHERE p_size > 42),
      d AS (SELECT 1 AS s FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT -1 FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
    SELECT (count(*) + coalesce(abs(sum(s)), 0))::BIGINT AS failures FROM d""")
def check_equality_failures(spark, sf_dir):
    return K.equality_failures(check_equality(spark, sf_dir))


@query("""WITH a AS (SELECT c_nationkey AS nation_a, count(*) AS count_a FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS nation_b, count(*) AS count_b FROM supplier GROUP BY 1)
    SELECT *, abs(count_a - count_b) AS diff_count FROM a FULL JOIN b ON nation_a = nation_b WHERE abs(count_a - count_b) > 0""")
def check_equal_rowcount(spark, sf_dir):
    a = load(spark, sf_dir, "customer", F.col("c_nationkey").alias("nation"))
    return K.equal_rowcount(a, load(spark, sf_dir, "supplier", F.col("s_nationkey").alias("nation")), ["nation"])


@query("""WITH a AS (SELECT s_nationkey AS nation_a, count(*) AS count_a FROM supplier GROUP BY 1),
      b AS (SELECT c_nationkey AS nation_b, count(*) AS count_b FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
    SELECT *, CASE WHEN count_a > count_b THEN count_a - count_b WHEN count_a = count_b THEN 1 ELSE 0 END AS row_count_delta FROM a FULL JOIN b ON nation_a = nation_b""")
def check_row_surplus(spark, sf_dir):
    a = load(spark, sf_dir, "supplier", F.col("s_nationkey").alias("nation"))
    b = load(spark, sf_dir, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    return K.row_surplus(a, b, ["nation"])


@query("SELECT count_a, count_b, count_a - count_b AS row_count_delta FROM (SELECT count(*) AS count_a FROM lineitem), (SELECT count(*) AS count_b FROM orders)")
def check_fewer_rows(spark, sf_dir):
    return K.fewer_rows_than(load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders"))


@query("""SELECT d.*, n.n_values FROM (VALUES ('c_comment', 'missing'), ('c_acctbal', 'unexpected'), ('c_nationkey', 'unexpected')) d(column_name, problem)
    LEFT JOIN (SELECT unnest(['c_acctbal', 'c_nationkey']) AS column_name, unnest([count(c_acctbal), count(c_nationkey)]) AS n_values FROM customer) n USING (column_name)""")
def check_columns_match(spark, sf_dir):
    customers = load(spark, sf_dir, "customer")
    wrong = K.columns_match(customers, ["C_CUSTKEY", "c_name", "c_mktsegment", "c_comment"])
    held = K.null_profile(customers, "c_custkey").select("column_name", (F.col("total") - F.col("null_count")).alias("n_values"))
    return wrong.join(held, "column_name", "left")


@query(using("tokens") + """, t AS (SELECT token_address, symbol, logo_uri, market_cap FROM tokens)
    SELECT column_name, total, duplicates, null_count, round(null_count * 100 / total, 2) AS null_pct FROM (
      SELECT count(*) AS total, count(*) - count(DISTINCT token_address) AS duplicates, unnest(['token_address', 'symbol', 'logo_uri', 'market_cap']) AS column_name,
             unnest([count(*) - count(token_address), count(*) - count(symbol), count(*) - count(logo_uri), count(*) - count(market_cap)]) AS null_count FROM t)""")
def null_profile(spark, sf_dir):
    return K.null_profile(A.tokens(spark, sf_dir).select("token_address", "symbol", "logo_uri", "market_cap"), "token_address")


@query(using("portfolios") + """SELECT 'columns' AS test, 0::BIGINT AS failures UNION ALL SELECT 'not_null_wallet_address', count(*) - count(wallet_address) FROM portfolios
    UNION ALL SELECT 'not_null_total_pnl', count(*) - count(total_pnl) FROM portfolios UNION ALL SELECT 'not_null_realized_pnl', count(*) - count(realized_pnl) FROM portfolios
    UNION ALL SELECT 'not_null_unrealized_pnl', count(*) - count(unrealized_pnl) FROM portfolios
    UNION ALL SELECT 'unique_key', count(*) - count(DISTINCT wallet_address) FROM portfolios
    UNION ALL SELECT 'pnl_adds_up', count(*) FILTER (WHERE abs(total_pnl - realized_pnl - unrealized_pnl) >= 0.011) FROM portfolios
    UNION ALL SELECT 'positive_trade_count', count(*) FILTER (WHERE trade_count <= 0) FROM portfolios
    UNION ALL SELECT 'row_count', CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM portfolios""")
def validate_wallet_pnl(spark, sf_dir):
    return K.validate(portfolios(spark, sf_dir), K.PROFILES["wallet_pnl"])


@query(using("tokens") + """SELECT 'columns' AS test, 0::BIGINT AS failures UNION ALL SELECT 'not_null_token_address', count(*) - count(token_address) FROM tokens
    UNION ALL SELECT 'not_null_symbol', count(*) - count(symbol) FROM tokens UNION ALL SELECT 'not_null_market_cap', count(*) - count(market_cap) FROM tokens
    UNION ALL SELECT 'not_null_liquidity', count(*) - count(liquidity) FROM tokens
    UNION ALL SELECT 'positive_market_cap', count(*) FILTER (WHERE market_cap <= 0) FROM tokens UNION ALL SELECT 'row_count', CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM tokens""")
def validate_tokens(spark, sf_dir):
    return K.validate(A.tokens(spark, sf_dir), K.PROFILES["tokens"])


# Every seventh wallet is ranked one too low and every fifth has the tier ELITE.
@query(using("portfolios") + _GOLD_COLUMNS + """, ranked AS (
    SELECT performance_tier, smart_trader_score, CAST(substr(wallet_address, 2) AS BIGINT) AS n,
           row_number() OVER (ORDER BY smart_trader_score DESC, total_pnl DESC, wallet_address) AS place FROM qualified),
  changed AS (SELECT *, place + CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END AS overall_rank FROM ranked),
  walked AS (SELECT *, lag(overall_rank) OVER w AS rank_before, lag(smart_trader_score) OVER w AS score_before FROM changed
             WINDOW w AS (ORDER BY overall_rank, smart_trader_score DESC))
  SELECT 'rank_gaps' AS test, (SELECT count(*) FROM (SELECT overall_rank FROM walked
         WHERE (rank_before IS NULL AND overall_rank <> 1) OR overall_rank <> rank_before + 1 OR smart_trader_score > score_before)) AS failures
  UNION ALL SELECT 'tier_consistency', count(*) FILTER (WHERE n % 5 = 0 AND performance_tier <> 'ELITE') FROM changed""")
def validate_gold_traders(spark, sf_dir):
    wallet = F.substring("wallet_address", 2, 20).cast("bigint")
    gold = traders.gold_traders(portfolios(spark, sf_dir)).withColumns(
        {
            "overall_rank": F.col("overall_rank") + F.when(wallet % 7 == 0, 1).otherwise(0),
            "performance_tier": F.when(wallet % 5 == 0, "ELITE").otherwise(F.col("performance_tier")),
        }
    )
    wrong_tier = gold.filter(F.col("performance_tier") != M.gold_tier())
    return K.run_suite({"rank_gaps": K.rank_gaps(gold, "overall_rank", "smart_trader_score"), "tier_consistency": wrong_tier})


@query(using("messages") + """SELECT minimum, rate >= minimum AS passed, CASE WHEN rate >= minimum THEN rate END AS rate
    FROM (SELECT count(*) FILTER (WHERE json_valid(payload)) / count(*) AS rate FROM messages), (SELECT unnest([0.5, 0.95]::DOUBLE[]) AS minimum)""")
def success_rate(spark, sf_dir):
    """The gate at two limits: the rate where it passes, none where it refuses."""
    from tidemark.functions.scalars import parsed_json

    valid, rows = parsed_json(F.col("payload")).isNotNull(), A.messages(spark, sf_dir)
    results = []
    for minimum in (0.5, S.MIN_SUCCESS_RATE):
        try:
            results.append((minimum, True, K.success_gate(rows, valid, minimum)))
        except ValueError:
            results.append((minimum, False, None))
    return spark.createDataFrame(results, "minimum double, passed boolean, rate double")

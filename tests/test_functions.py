"""Tiers, scores and scalar functions at their edges."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import market as M
from tidemark.functions import scalars as C
from tidemark.operators import relational as R
from tidemark.operators.events import payload_state, valid_transaction


def column(spark, values, kind, make):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r["y"] for r in df.select(make(F.col("x")).alias("y")).collect()]


def test_bands(spark):
    assert column(spark, [99_999.0, 100_000.0, 500_000.0, 1e6, None], "double", M.liquidity_tier) == ["MINIMAL", "LOW", "MEDIUM", "HIGH", "MINIMAL"]
    assert column(spark, [999.0, 1e3, 1e4, 1e5, 1e6], "double", M.holder_tier) == ["MINIMAL", "SMALL", "MEDIUM", "LARGE", "MEGA"]
    assert column(spark, [3, 4, 10, 11, 50, 51], "int", M.rank_tier) == ["TOP_3", "TOP_10", "TOP_10", "TOP_50", "TOP_50", "OTHER"]
    assert column(spark, ["to", "from", "x", None], "string", M.side_by_direction) == ["BUY", "SELL", "SWAP", "SWAP"]


def test_trader_tiers(spark):
    cases = [
        (10_000.0, 50.0, 30.0, "ELITE"), (9_999.0, 50.0, 30.0, "STRONG"), (1_000.0, 20.0, 20.0, "STRONG"), (100.0, 10.0, 10.0, "PROMISING"),
        (99.0, 90.0, 90.0, "QUALIFIED"), (-5.0, 0.0, 1.0, "QUALIFIED"), (0.0, 0.0, 0.0, "UNQUALIFIED"),
    ]
    df = spark.createDataFrame(cases, "total_pnl double, portfolio_roi double, win_rate double, want string")
    assert df.withColumn("got", M.gold_tier()).filter("got <> want").count() == 0


def test_gold_score(spark):
    df = spark.createDataFrame([(2_000.0, 150.0, 50.0, 12), (-10.0, -5.0, 0.0, 3)], "total_pnl double, portfolio_roi double, win_rate double, trade_count int")
    assert [r[0] for r in df.select(M.gold_score()).collect()] == [41.8, 0.3]


def test_missing_ratio_scores_full(spark):
    df = spark.createDataFrame([(50.0, None, 50_000.0)], "a double, b double, c double")
    assert df.select(M.token_quality_score(F.col("a"), F.col("b"), F.col("c"))).first()[0] == 0.65


def test_division_never_fails(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, -2.0), (1.0, 4.0)], "a double, b double")
    got = df.select(M.ratio(F.col("a"), F.col("b")), C.safe_divide(F.col("a"), F.col("b")), M.percent(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, None, 0.0), (None, None, 0.0), (None, -0.5, 0.0), (0.25, 0.25, 25.0)]


def test_json(spark):
    texts = ['{"a": 1, "b": "x"}', "[1]", "{bad", "", None]
    assert column(spark, texts, "string", lambda x: C.parsed_json(x).isNotNull()) == [True, True, False, False, False]
    assert column(spark, texts, "string", lambda x: C.json_text(C.parsed_json(x), "$.b")) == ["x", None, None, None, None]
    kinds = ['{"transactionType":"SWAP"}', '{"transaction":1}', "{}", "no", None]
    assert column(spark, kinds, "string", lambda x: C.payload_kind(C.parsed_json(x))) == ["solana_swap", "solana_transaction", "unknown", "invalid_json", "invalid_json"]
    words = ["a transaction SWAP", "transaction swap", "test", "Test", None]
    assert column(spark, words, "string", C.payload_kind_by_text) == ["solana_swap", "solana_transaction", "test_event", "unknown", "unknown"]


def test_first_event(spark):
    texts = ['[{"signature":"s","accountData":[{"account":"a"}],"tokenTransfers":[]}]', '{"signature":"s"}', "[]", "oops"]
    got = [tuple(r) for r in column(spark, texts, "string", C.first_event_fields)]
    assert got == [("s", "UNKNOWN", "a", None), (None, "UNKNOWN", None, None), (None, "UNKNOWN", None, None), (None, "UNKNOWN", None, None)]


def test_payload_state(spark):
    texts = [None, "", "{", "[]", " {} ", '{"a":1}', "[1]"]
    assert column(spark, texts, "string", payload_state) == ["missing", "parse_error", "parse_error", "empty", "empty", "valid", "valid"]


def test_iso_timestamps(spark):
    texts = ["2024-01-02T03:04:05", "2024-01-02T03:04:05.5", "2024-01-02 03:04:05", "2024-13-02T03:04:05", "n/a", None]
    got = [None if v is None else v.isoformat() for v in column(spark, texts, "string", C.iso_timestamp)]
    assert got == ["2024-01-02T03:04:05", "2024-01-02T03:04:05.500000", None, None, None, None]


def test_age_text(spark):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    times = ["2024-01-08 11:00:00", "2024-01-10 03:00:00", "2024-01-10 11:30:00", None]
    got = column(spark, times, "string", lambda x: C.age_text(x.cast("timestamp_ntz"), now))
    assert got == ["2 days ago", "9 hours ago", "30 minutes ago", "No data"]


def test_width_bucket(spark):
    got = column(spark, [-1.0, 0.0, 1.0, 2.0, 9.9, 10.0, 12.0], "double", lambda x: C.width_bucket(x, F.lit(0.0), F.lit(10.0), 5))
    assert got == [0, 1, 1, 2, 5, 6, 7]


def test_haversine(spark):
    point = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    miles, km = point.select(C.haversine(*[F.col(c) for c in "abcd"]), C.haversine(*[F.col(c) for c in "abcd"], unit="km")).first()
    assert round(miles) == 267 and round(km) == 430
    with pytest.raises(ValueError):
        C.haversine(F.lit(0), F.lit(0), F.lit(0), F.lit(0), unit="ly")


def test_urls(spark):
    urls = ["https://a.b/c/d?x=1&ref=9", "http://a.b?ref=2", "a.b", "android-app://z.y/q", None]
    assert column(spark, urls, "string", C.url_host) == ["a.b", "a.b", "a.b", "z.y", None]
    assert column(spark, urls, "string", C.url_path) == ["c/d", "", "a.b", "/z.y/q", None]
    odd = ["http://a.b?xref=7&ref=3#top", "http://a.b?ref="]
    assert column(spark, odd, "string", lambda u: C.url_parameter(u, "ref")) == ["7", None]
    assert column(spark, odd, "string", lambda u: C.url_parameter_exact(u, "ref")) == ["3", None]


def test_slugs(spark):
    assert column(spark, ["My  Col-Name!", "1st", ""], "string", C.slugify) == ["my_col_name", "_1st", ""]
    assert [C.slugify_name(n) for n in ("My  Col-Name!", "1st", "")] == ["my_col_name", "_1st", ""]


def test_surrogate_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(C.surrogate_key("x", "y").alias("k")).distinct().count() == 2
    assert df.select(C.surrogate_key("x", "y", null_text="").alias("k")).distinct().count() == 1


def test_safe_sums_and_blanks(spark):
    df = spark.createDataFrame([(1, None, ""), (None, 2, "x")], "a int, b int, c string")
    assert [tuple(r) for r in df.select(C.safe_add(F.col("a"), F.col("b")), C.safe_subtract(F.col("a"), F.col("b"))).collect()] == [(1, 1), (2, -2)]
    assert [r["c"] for r in C.blank_to_null(df).collect()] == [None, "x"]


def test_categories_and_limits(spark):
    assert column(spark, ["Dex Swap", "send it", "unstake", "hello"], "string", C.event_category) == ["swap", "transfer", "defi", "other"]
    df = spark.createDataFrame([("SWAP", 1.0, "s" * 64, "a" * 32), ("SWAP", 0.0, "s" * 64, "a" * 32), ("X", 1.0, "s" * 64, "a" * 32), ("SWAP", 1.0, None, "a" * 32)],
                               "k string, v double, s string, a string")
    assert [r[0] for r in df.select(valid_transaction(F.col("k"), F.col("v"), F.col("s"), F.col("a"))).collect()] == [True, False, False, False]


def test_pivot_fills_zero(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red")], "size string, color string")
    assert rows(df.groupBy("size").agg(*R.pivot_columns("color", ["red", "blue"]))) == [("M", 1, 0), ("S", 2, 1)]
    named = df.groupBy("size").agg(*R.pivot_columns("color", ["red", "dark blue"], prefix="n ", slugs=True, cmp="!="))
    assert named.columns == ["size", "n_red", "n_dark_blue"]


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(1, True, 2.5, "z")], "id int, flag boolean, amount double, note string")
    assert rows(R.unpivot(df, exclude=["id"], remove=["NOTE"])) == [(1, "amount", "2.5"), (1, "flag", "true")]


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 3.0)], "id int, extra double")
    assert rows(R.union_relations({"a": a, "b": b})) == [("a", 1, "x", None), ("b", 2, None, 3.0)]
    assert R.union_relations({"a": a, "b": b}, include=["ID"], column_override={"id": "string"}).dtypes == [("source_relation", "string"), ("id", "string")]
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["nothing"])


def test_date_spine(spark):
    days = [str(r[0]) for r in R.date_spine(spark, "day", "2018-01-01", "2018-01-10").collect()]
    assert days[0] == "2018-01-01" and days[-1] == "2018-01-09" and len(days) == 9
    assert [str(r[0]) for r in R.date_spine(spark, "month", "2024-01-31", "2024-04-01").collect()] == ["2024-01-31", "2024-02-29", "2024-03-31"]
    assert R.date_spine(spark, "hour", "2024-01-01", "2024-01-02").count() == 24
    with pytest.raises(ValueError):
        R.date_spine(spark, "day", "2018-01-10", "2018-01-10")
    with pytest.raises(ValueError):
        R.generate_series(spark, 0)


def test_column_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    assert R.column_value_list(df, "c", 2) == ["b", None] or R.column_value_list(df, "c", 2)[0] == "b"
    assert R.column_value_list(df, "c", 5, where="c = 'zz'", default=["d"]) == ["d"]
    assert R.column_value_list(None, "c", 5, default=[1]) == [1]
    with pytest.raises(ValueError):
        R.column_value_list(None, "c", 5)
    assert R.single_value(df.filter("c = 'zz'"), "none") == "none"

"""Ordered operators: buckets give what windows over whole groups give, ranks are exact."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered as O

SCHEMA = "g string, t int, id int, x double, y string"


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, moments repeat, some values are missing."""
    draw = random.Random(3)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 else draw.choice(["a", "b", None])
        x = None if draw.random() < 0.2 else float(draw.randint(-5, 9))
        data.append((group, draw.randint(0, 60), i, x, draw.choice(["u", "v", None])))
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def columns():
    return {
        "sums": {"total": F.col("x")}, "tied_sums": {"tied": F.col("x")}, "least": {"low": F.col("x")}, "least_before": {"low_before": F.col("x")},
        "carry": {"last_y": F.col("y")}, "following": {"next_x": F.col("x")}, "preceding": {"prev_y": F.col("y")}, "totals": {"whole": F.col("x")},
    }


def by_windows(df):
    """The same columns from plain windows over whole groups."""
    W = O.Window.partitionBy("g")
    order = W.orderBy("t", "id")
    so_far = order.rowsBetween(O.Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        F.sum("x").over(so_far).alias("total"),
        F.sum("x").over(W.orderBy("t")).alias("tied"),
        F.min("x").over(so_far).alias("low"),
        F.min("x").over(order.rowsBetween(O.Window.unboundedPreceding, -1)).alias("low_before"),
        F.last("y", True).over(so_far).alias("last_y"),
        F.lead("x").over(order).alias("next_x"),
        F.lag("y").over(order).alias("prev_y"),
        F.sum("x").over(W).alias("whole"),
        F.row_number().over(order).cast("bigint").alias("pos"),
    )


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_buckets_equal_whole_groups(skewed, rows, width):
    got = O.scan(skewed, ["g"], ["t", "id"], position="pos", bucket=F.floor(F.col("t") / width), **columns())
    assert got.columns == by_windows(skewed).columns
    assert rows(got) == rows(by_windows(skewed))


def test_null_order_and_null_keys_keep_all_rows(spark, rows):
    df = spark.createDataFrame([(None, None, i, float(i), None) for i in range(5)] + [(None, 3, 9, 1.0, "u"), ("a", None, 1, None, None)], SCHEMA)
    assert rows(O.scan(df, ["g"], ["t", "id"], position="pos", **columns())) == rows(by_windows(df))


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "double"])
def test_default_buckets_keep_the_order(spark, kind):
    df = spark.range(200).select((F.col("id") * 40_000).alias("id"), F.timestamp_seconds(F.col("id") * 40_000).alias("timestamp"))
    df = df.withColumns({"date": F.to_date("timestamp"), "string": F.lpad(F.col("id").cast("string"), 9, "0"), "double": F.col("id") / 3.0})
    got = O.scan(df, [], [kind, "id"], sums={"s": F.lit(1)}, position="p").orderBy("id").collect()
    assert [(r.s, r.p) for r in got] == [(i, i) for i in range(1, 201)]


def test_building_a_scan_with_buckets_runs_no_job(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    O.scan(skewed, ["g"], ["t", "id"], position="pos", bucket=F.floor(F.col("t") / 7), **columns())
    jobs = tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs


@pytest.mark.parametrize(("keys", "order"), [(["g"], ["t", "id"]), ([], ["id"])])
def test_sampled_cuts_equal_whole_groups(skewed, rows, keys, order):
    given = columns() if keys else {"sums": {"s": F.col("id")}, "preceding": {"before": F.col("y")}}
    got = O.scan(skewed, keys, order, position="pos", stored=True, **given)
    if keys:
        assert rows(got) == rows(by_windows(skewed))
    W = O.Window.orderBy("id")
    plain = skewed.select(*skewed.columns, F.sum("id").over(W).alias("s"), F.lag("y").over(W).alias("before"), F.row_number().over(W).cast("bigint").alias("pos"))
    assert keys or rows(got) == rows(plain)


@pytest.mark.parametrize("values", [lambda i: f"Customer#0000{i:05d}", lambda i: i % 50 + 1, lambda i: float(i) / 1e9, lambda i: 10**15 * i])
def test_any_range_of_values_is_split(spark, values):
    """Texts with one prefix, few numbers, slivers and wide ranges: more stretches than cores, none with more than its share."""
    df = spark.createDataFrame([(values(i), i) for i in range(4000)]).toDF("v", "id")
    for order, most in ((["v"], 4000), (["v", "id"], 600)):
        sizes = [r["count"] for r in df.groupBy(O.sampled_bucket(df, order).alias("b")).count().collect()]
        assert len(sizes) > 8 and max(sizes) <= most
    assert O.sampled_bucket(df.limit(0), ["v"]) is not None


def test_small_groups_are_not_cut(spark, monkeypatch):
    """Only groups with a cut inside lie in several buckets, however their rows mix in the order."""
    df = spark.range(2000).select((F.col("id") % 500).alias("g"), F.col("id").alias("t"))
    seen, sampled = [], O.sampled_bucket

    def watched(rows, order, n=None):
        found = sampled(rows, order, n)
        seen.append(rows.select("g", found.alias("b")).distinct().count())
        return found

    monkeypatch.setattr(O, "sampled_bucket", watched)
    got = O.scan(df, ["g"], ["t"], position="p").orderBy("t").collect()
    assert [r.p for r in got] == [1 + i // 500 for i in range(2000)]
    assert seen[0] <= 500 + O.BUCKETS_PER_PART * 4


def test_scan_without_keys(skewed):
    got = O.scan(skewed, [], ["t", "id"], sums={"s": F.lit(1)}, preceding={"before": F.col("id")}, position="p")
    pdf = got.orderBy("t", "id").toPandas()
    assert list(pdf.p) == list(range(1, 3001))
    assert list(pdf.s) == list(range(1, 3001))
    assert pd.isna(pdf.before[0])
    assert list(pdf.before[1:].astype(int)) == list(pdf.id[:-1])


def test_global_position(skewed):
    pdf = O.global_position(skewed, [F.desc("t"), F.asc("id")], "pos").toPandas().sort_values("pos")
    assert list(pdf.pos) == list(range(1, 3001))
    want = pdf.sort_values(["t", "id"], ascending=[False, True])
    assert list(want.id) == list(pdf.id)


def test_row_number_in_groups(skewed, rows):
    got = O.global_position(skewed, [F.desc("t"), F.asc("id")], "p", within={"n": ["g"], "m": ["g", "y"]}).drop("p")
    order = [F.desc("t"), F.asc("id")]
    number = lambda *by: F.row_number().over(O.Window.partitionBy(*by).orderBy(*order)).cast("bigint")
    want = skewed.withColumns({"n": number("g"), "m": number("g", "y")})
    assert rows(got) == rows(want)


def test_percent_rank_with_ties(skewed):
    pdf = O.global_position(skewed, [F.desc("x"), F.asc("id")], "r", percent={"share": "x"}).toPandas()
    ranks = pdf.x.rank(method="min", na_option="top")
    assert ((ranks - 1) / 2999 - pdf.share).abs().max() < 1e-12


def test_percent_rank_of_one_row(spark):
    one = spark.createDataFrame([(1.0,)], "x double")
    assert O.global_position(one, [F.desc("x")], "r", percent={"share": "x"}).first()["share"] == 0.0


def test_percent_rank_when_nearly_all_share_a_value(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(0).cast("double").alias("x"))
    pdf = O.global_position(df, [F.desc("x"), "id"], "r", percent={"share": "x"}).toPandas()
    assert ((pdf.x.rank(method="min") - 1) / 999 - pdf.share).abs().max() < 1e-12


def test_keep_latest_and_top_n(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 5), (None, 4)], "k string, v int")
    assert rows(O.keep_latest(df, ["k"], [F.desc("v")])) == [("a", 3), ("b", 2), (None, 5)]
    assert [r["v"] for r in O.top_n(df, [F.desc("v")], 2).collect()] == [5, 4]
    assert O.top_n_per_group(df, ["k"], [F.desc("v")], 2).count() == 5

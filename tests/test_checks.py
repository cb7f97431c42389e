"""Every data test on a passing and a failing table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks as K


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "ann", "a@x", True, 1.0), (2, "bob", " ", True, 2.0), (3, None, "c@x", True, None), (3, "dan", "", True, 9.0)]
    return spark.createDataFrame(data, "id int, name string, mail string, active boolean, score double")


def fails(df):
    return df.count()


def test_column_checks(people):
    assert fails(K.not_null(people, "id")) == 0 and fails(K.not_null(people, "name")) == 1
    assert fails(K.not_null(people, "name", where="id < 3")) == 0
    assert fails(K.unique(people, "name")) == 0 and [tuple(r) for r in K.unique(people, "id").collect()] == [(3, 2)]
    assert fails(K.accepted_values(people, "name", ["ann", "bob", "dan"])) == 0  # a missing value passes
    assert [tuple(r) for r in K.accepted_values(people, "id", [1, 2]).collect()] == [(3, 2)]
    assert fails(K.not_accepted_values(people, "id", [9])) == 0 and fails(K.not_accepted_values(people, "id", [3])) == 1
    assert fails(K.accepted_range(people, "score", 1, 9)) == 0
    assert fails(K.accepted_range(people, "score", 1, 9, inclusive=False)) == 2
    assert fails(K.accepted_range(people, "score", low=2)) == 1 and fails(K.accepted_range(people, "score")) == 0
    assert fails(K.not_empty_string(people, "mail")) == 2 and fails(K.not_empty_string(people, "mail", trim=False)) == 1
    assert fails(K.expression_is_true(people, "score > 0")) == 0 and fails(K.expression_is_true(people, "> 1.5", column="score")) == 1


def test_group_checks(people):
    assert fails(K.at_least_one(people, "score")) == 0
    assert fails(K.at_least_one(people.filter("score is null"), "score")) == 1
    assert fails(K.at_least_one(people, "score", ["name"])) == 1
    assert fails(K.not_constant(people, "id")) == 0 and fails(K.not_constant(people, "active")) == 1
    assert fails(K.not_constant(people, "name", ["id"])) == 3
    assert fails(K.not_null_proportion(people, "score", 0.75)) == 0 and fails(K.not_null_proportion(people, "score", 0.8)) == 1
    assert fails(K.not_null_proportion(people, "score", 0.1, 0.5)) == 1
    assert fails(K.not_null_proportion(people, "score", 0.9, group_by=["id"])) == 1


def test_recency(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 9, 20)), ("b", datetime(2024, 1, 1))], "k string, t timestamp_ntz")
    now = F.lit("2024-01-10 21:00:00").cast("timestamp_ntz")
    assert fails(K.recency(df, "t", "day", 2, now)) == 0
    assert fails(K.recency(df, "t", "hour", 24, now)) == 1
    assert fails(K.recency(df, "t", "day", 1, now, ignore_time=True)) == 0
    assert [r["k"] for r in K.recency(df, "t", "day", 2, now, group_by=["k"]).collect()] == ["b"]


def test_sequences(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), ("b", 7), ("c", 3), ("c", 3)], "k string, v int")
    got = sorted((r.k, r.v) for r in K.sequential_values(df, "v", group_by=["k"]).collect())
    assert got == [("b", 7), ("c", 3)]
    assert fails(K.sequential_values(df.filter("k = 'a'"), "v")) == 0
    assert fails(K.sequential_values(df.filter("k <> 'c'"), "v")) == 2
    assert fails(K.sequential_values(df.filter("k = 'b'"), "v", interval=2)) == 0


RANGES = [("a", 1, 3), ("a", 3, 5), ("a", 6, 6), ("b", 4, 2), ("c", 1, 9), ("c", 2, 3), ("d", None, 1)]


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, {("a", 6), ("b", 4), ("c", 1), ("d", None)}),
        ({"zero_length": True}, {("b", 4), ("c", 1), ("d", None)}),
        ({"gaps": "not_allowed", "zero_length": True}, {("a", 3), ("b", 4), ("c", 1), ("d", None)}),
        ({"gaps": "required", "zero_length": True}, {("a", 1), ("b", 4), ("c", 1), ("d", None)}),
    ],
)
def test_exclusive_ranges(spark, options, expected):
    df = spark.createDataFrame(RANGES, "k string, lo int, hi int")
    got = K.mutually_exclusive_ranges(df, "lo", "hi", ["k"], **options)
    assert {(r.k, r.lower_bound) for r in got.collect()} == expected
    with pytest.raises(ValueError):
        K.mutually_exclusive_ranges(df, "lo", "hi", gaps="maybe")


def test_table_checks(spark, people):
    other = people.filter("id < 3")
    assert fails(K.unique_combination(people, ["id", "name"])) == 0 and fails(K.unique_combination(people, ["id"])) == 1
    assert fails(K.unique_combination(people, ["id"], where="name is not null")) == 0
    assert fails(K.relationships(other, "id", people, "id")) == 0 and fails(K.relationships(people, "id", other, "id")) == 2
    assert fails(K.relationships(people, "name", other, "name")) == 1  # a missing key passes
    assert fails(K.cardinality_equality(people, "id", people, "id")) == 0 and fails(K.cardinality_equality(people, "id", other, "id")) == 1
    assert fails(K.equality(people, people)) == 0
    differences = K.equality(people, other, ["id", "name"])
    assert fails(differences) == 2 and K.equality_failures(differences).first()["failures"] == 4
    assert K.equality_failures(K.equality(people, people)).first()["failures"] == 0
    assert fails(K.equal_rowcount(people, people)) == 0 and K.equal_rowcount(people, other).first()["diff_count"] == 2
    grouped = {r["id_a"]: r["diff_count"] for r in K.row_counts_compared(people, other, ["id"]).collect()}
    assert grouped == {1: 0, 2: 0, 3: None}
    assert fails(K.fewer_rows_than(other, people)) == 0
    assert K.fewer_rows_than(people, people).first()["row_count_delta"] == 1
    assert K.fewer_rows_than(people, other).first()["row_count_delta"] == 2
    assert fails(K.columns_match(people, ["ID", "name", "mail", "active", "score"])) == 0
    assert {tuple(r) for r in K.columns_match(people, ["id", "x"]).collect()} >= {("x", "missing"), ("name", "unexpected")}


def test_profile_and_suite(spark, people):
    profile = {r["column_name"]: (r["total"], r["null_count"], r["null_pct"], r["duplicates"]) for r in K.null_profile(people, "id").collect()}
    assert profile["name"] == (4, 1, 25.0, 1) and profile["id"] == (4, 0, 0.0, 1)
    suite = K.run_suite({"names": K.not_null(people, "name"), "ids": K.not_null(people, "id")})
    assert {tuple(r) for r in suite.collect()} == {("names", 1), ("ids", 0)}
    wanted = K.TableProfile(("id", "name", "missing"), ("id",), {"small": "score < 5"}, min_rows=10)
    got = {r["test"]: r["failures"] for r in K.validate(people, wanted).collect()}
    assert got == {"columns": 1, "not_null_id": 0, "not_null_name": 1, "unique_key": 1, "small": 1, "row_count": 1}


def test_rank_gaps(spark):
    good = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 1.0)], "r bigint, s double")
    assert fails(K.rank_gaps(good, "r", "s")) == 0
    bad = spark.createDataFrame([(2, 1.0), (4, 9.0)], "r bigint, s double")
    assert fails(K.rank_gaps(bad, "r", "s")) == 2


def test_success_gate(people):
    assert K.success_gate(people, F.col("name").isNotNull(), 0.7) == 0.75
    with pytest.raises(ValueError):
        K.success_gate(people, F.col("name").isNotNull(), 0.95)
    with pytest.raises(ValueError):
        K.success_gate(people.filter("id > 99"), F.col("name").isNotNull(), 0.95)

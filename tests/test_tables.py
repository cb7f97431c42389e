"""Writes, snapshots and incremental updates over two runs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import incremental as I
from tidemark.plans import query_tables
from tidemark.session import fresh_path, shared_folder, stored_bytes
from tidemark.sources import tables as S

TARGET = "k string, v int, status string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, "done"), ("b", 2, "done"), (None, 9, "done")], TARGET)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", 20, "new"), ("c", 30, "new")], TARGET)


def test_upsert(target, source, rows):
    merged = I.upsert(target, source, ["k"])
    want = sorted([("a", 1, "done"), ("b", 20, "new"), ("c", 30, "new"), (None, 9, "done")], key=repr)
    assert rows(merged) == want
    assert rows(I.upsert(merged, source, ["k"])) == want  # a second run changes nothing


def test_upsert_with_expressions(target, source, rows):
    changes = {"v": F.col("t.v") + F.col("s.v"), "status": F.lit("pending")}
    merged = I.upsert(target, source, ["k"], changes, insert=False)
    assert rows(merged) == sorted([("a", 1, "done"), ("b", 22, "pending"), (None, 9, "done")], key=repr)
    newer = I.upsert(target, source, ["k"], only_if=F.col("s.v") > 25)
    assert ("b", 2, "done") in rows(newer) and ("c", 30, "new") in rows(newer)


def test_upsert_refuses_repeated_keys(target, source):
    with pytest.raises(ValueError):
        I.upsert(target, source.unionByName(source), ["k"])


def test_status(target, rows):
    done = target.filter("k = 'a'")
    assert ("a", 1, "completed") in rows(I.update_status(target, done.unionByName(done), ["k"], {"status": F.lit("completed")}))
    assert {r["status"] for r in I.reset_status(target, {"status": None, "v": F.lit(0)}).collect()} == {None}


def test_new_and_updated(target, source):
    assert tuple(I.new_and_updated(target, source, ["k"]).first()) == (1, 1)


def test_refetch(spark):
    data = [("pending", date(2024, 1, 9)), ("completed", date(2024, 1, 7)), ("completed", date(2024, 1, 8)), (None, None), ("completed", None)]
    df = spark.createDataFrame(data, "status string, at date")
    due = I.due_for_refetch(df, "status", "at", F.lit("2024-01-10").cast("date"), 3)
    assert sorted(repr(tuple(r)) for r in due.collect()) == sorted(repr(d) for d in (data[0], data[1], data[3]))


def test_high_water(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    assert rows(I.above_high_water(df, "n", df.filter("n < 3"))) == [(3,)]
    assert rows(I.above_high_water(df, "n", df.filter("n < 3"), include_equal=True)) == [(2,), (3,)]
    assert I.above_high_water(df, "n", df.filter("n > 9")).count() == 3  # nothing processed yet: all rows


def test_pending_dates(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 1),), (date(2024, 1, 2),)], "d date")
    log = I.log_of(df.filter("d = '2024-01-01'"), "d", "b1")
    assert rows(log) == [(date(2024, 1, 1), 2, "b1")]
    assert rows(I.pending_dates(df, "d", log)) == [(date(2024, 1, 2),)]


def test_schema_rules():
    old = T.StructType.fromDDL("a int, b string, c double")
    new = T.StructType.fromDDL("a bigint, c double, d string")
    changes = {name: change for name, change, _, _ in I.schema_diff(old, new)}
    assert changes == {"a": "retyped", "b": "removed", "c": "same", "d": "added"}
    with pytest.raises(ValueError):
        I.require_compatible(old, new)
    assert I.dataset_kind(["base_address", "quote_address", "x"]) == "raw"
    assert I.dataset_kind(["from_address", "transaction_type"]) == "processed"
    assert I.dataset_kind(["x"]) == "unknown"


def test_age_report(spark):
    files = spark.createDataFrame(
        [("f1", 100, datetime(2024, 1, 1)), ("f2", 50, datetime(2023, 12, 1)), ("f3", 10, datetime(2020, 1, 1))],
        "file_path string, file_size bigint, modified_at timestamp_ntz",
    )
    report = I.age_report(files, "bronze", F.lit("2024-01-05").cast("date"))
    got = {r["age_band"]: (r["files"], r["bytes"], r["compress_due"], r["archive_due"], r["delete_due"]) for r in report.collect()}
    assert got == {"up_to_7_days": (1, 100, 0, 0, 0), "up_to_90_days": (1, 50, 1, 1, 1), "over_365_days": (1, 10, 1, 1, 1)}
    saved = I.saving_estimate(report).first()
    assert (saved["compress_mb"], saved["archive_mb"]) == (0.6, 1.4)


def test_lake(spark):
    lake = S.Lake(spark, fresh_path(spark, "lake"))
    tokens = spark.createDataFrame([("t", 1.0, date(2024, 1, 1))], "token_address string, liquidity double, processing_date date")
    assert not lake.exists("tokens")
    lake.write("tokens", tokens)
    lake.write("tokens", tokens.withColumn("extra", F.lit(7)))  # a new column is fine
    assert lake.read("tokens").filter("extra is null").count() == 1
    with pytest.raises(ValueError):
        lake.write("tokens", tokens.withColumn("liquidity", F.lit("much")))
    with pytest.raises(ValueError):
        lake.path("nothing")


def test_missing_partition(spark):
    schema = T.StructType.fromDDL("a int, d date")
    assert S.read_partition(spark, fresh_path(spark, "none"), "d", date(2024, 1, 1), schema).count() == 0


def test_partition_pruning(spark):
    path = fresh_path(spark, "by-day")
    df = spark.range(100).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")))
    S.write_partitioned(df, path, ["day"], "overwrite")
    one = S.read_partition(spark, path, "day", date(2024, 1, 2))
    plan = one._jdf.queryExecution().toString()
    assert one.count() == 20 and "PartitionFilters: [isnotnull(day" in plan


def test_snapshots(spark, rows):
    table = S.SnapshotTable(spark, fresh_path(spark, "snap"))
    with pytest.raises(ValueError):
        table.read()
    first = spark.createDataFrame([("a", 1, "x")], TARGET)
    assert table.commit(first, datetime(2024, 1, 1), "CREATE") == 0
    fresh = spark.createDataFrame([("a", 2, "x"), ("b", 1, "x")], TARGET)
    assert table.commit(I.upsert(table.read(), fresh, ["k"]), datetime(2024, 1, 2), "MERGE") == 1
    assert rows(table.read(version=0)) == [("a", 1, "x")]
    assert rows(table.read()) == [("a", 2, "x"), ("b", 1, "x")]
    assert rows(table.read(timestamp=datetime(2024, 1, 1, 12))) == [("a", 1, "x")]
    health = table.health().first()
    assert (health["version"], health["record_count"], health["recent_operations"]) == (1, 2, ["MERGE", "CREATE"])


def test_batches(spark):
    path, status = fresh_path(spark, "b"), fresh_path(spark, "s")
    for batch, n in (("one", 3), ("two", 5)):
        S.append_batch(spark.range(n), path, status, batch, datetime(2024, 1, 1))
    assert {r["batch_id"]: r["n_rows"] for r in spark.read.parquet(status).collect()} == {"one": 3, "two": 5}


def test_compaction_clusters(spark):
    source, target = fresh_path(spark, "many"), fresh_path(spark, "few")
    spark.range(1000).repartition(20).write.parquet(source)
    S.compact(spark, source, target, ["id"], file_bytes=stored_bytes(spark, source) // 2 + 1)
    files = spark.read.parquet(target).groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert len(files) == 2 and files[0]["hi"] < files[1]["lo"]


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None


def test_merge_rewrites_only_touched_partitions(spark, rows):
    lake = S.Lake(spark, fresh_path(spark, "lake"))
    schema = "token_address string, liquidity double, processing_date date"
    lake.merge("tokens", spark.createDataFrame([("a", 1.0, date(2024, 1, 1)), ("b", 2.0, date(2024, 1, 2))], schema))
    before = {r["file_path"] for r in I.stored_files(spark, lake.path("tokens") + "/processing_date=2024-01-01").collect()}
    lake.merge("tokens", spark.createDataFrame([("b", 5.0, date(2024, 1, 2)), ("c", 6.0, date(2024, 1, 3))], schema))
    after = {r["file_path"] for r in I.stored_files(spark, lake.path("tokens") + "/processing_date=2024-01-01").collect()}
    assert before == after
    assert rows(lake.read("tokens"), "token_address", "liquidity") == [("a", 1.0), ("b", 5.0), ("c", 6.0)]


TRADERS = "wallet_address string, performance_tier string, smart_trader_score double"


def test_merge_moves_keys_between_partitions(spark, rows):
    lake = S.Lake(spark, fresh_path(spark, "lake"))
    lake.merge("traders", spark.createDataFrame([("a", "STRONG", 1.0), ("b", "STRONG", 2.0), ("c", None, 3.0), (None, "ELITE", 4.0)], TRADERS))
    lake.merge("traders", spark.createDataFrame([("a", "ELITE", 9.0)], TRADERS))
    want = [("a", "ELITE", 9.0), ("b", "STRONG", 2.0), ("c", None, 3.0), (None, "ELITE", 4.0)]
    assert rows(lake.read("traders"), "wallet_address", "performance_tier", "smart_trader_score") == sorted(want, key=repr)
    # The last row of a partition leaves it; rows without a partition value and without a key stay and match.
    lake.merge("traders", spark.createDataFrame([("b", "ELITE", 5.0), ("c", None, 6.0), (None, "ELITE", 7.0)], TRADERS))
    want = [("a", "ELITE", 9.0), ("b", "ELITE", 5.0), ("c", None, 6.0), (None, "ELITE", 7.0)]
    assert rows(lake.read("traders"), "wallet_address", "performance_tier", "smart_trader_score") == sorted(want, key=repr)


def test_upsert_matches_null_keys(target, rows):
    source = target.sparkSession.createDataFrame([(None, 90, "new")], TARGET)
    once = I.upsert(target, source, ["k"])
    want = sorted([("a", 1, "done"), ("b", 2, "done"), (None, 90, "new")], key=repr)
    assert rows(once) == want and rows(I.upsert(once, source, ["k"])) == want


def test_compaction_keeps_partitions(spark, rows):
    source, target = fresh_path(spark, "many"), fresh_path(spark, "few")
    spark.range(300).withColumn("p", F.col("id") % 3).repartition(10).write.partitionBy("p").parquet(source)
    S.compact(spark, source, target, ["id"], ["p"])
    assert rows(spark.read.parquet(target), "id", "p") == rows(spark.read.parquet(source), "id", "p")
    folders = {r["f"] for r in spark.read.parquet(target).select(F.regexp_extract(F.input_file_name(), "/(p=[0-9])/", 1).alias("f")).collect()}
    assert folders == {"p=0", "p=1", "p=2"} and I.stored_files(spark, target).count() == 3


def test_refetch_takes_the_longest_waiting(spark):
    data = [("a", "completed", date(2024, 1, 1)), ("b", "completed", date(2024, 1, 9)), ("c", None, None), ("d", "pending", date(2024, 1, 9)), ("e", "completed", date(2023, 12, 1))]
    df = spark.createDataFrame(data, "id string, whale_fetch_status string, whale_fetched_at date")
    found = I.next_for_refetch(df, "holders", "id", F.lit("2024-01-10").cast("date"), 3)
    assert [r["id"] for r in found.collect()] == ["c", "e", "a"]


def test_one_file_per_partition_without_a_sort(spark, tmp_path):
    """The task that writes a partition's only file does not hold its rows, as a sort by partition would."""
    rows = spark.range(4000).repartition(6).select((F.col("id") % 3).cast("string").alias("l_returnflag"), "id")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert [r.files for r in query_tables.storage_age(spark, str(tmp_path)).collect()] == [3]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    plans = [spark._jsparkSession.sharedState().statusStore().executionsList()]
    plans = [plans[0].apply(i).physicalPlanDescription() for i in range(plans[0].size())]
    writes = [p for p in plans if "lines-by-flag" in p and "InsertIntoHadoopFsRelationCommand" in p]
    assert writes and "Sort" not in writes[-1]


def test_a_merge_computes_its_source_once(spark, rows):
    lake = S.Lake(spark, fresh_path(spark, "lake"), {"t": S.TableSpec("t", "bronze", ("k",), ("day",))})
    schema = "k string, v int, day date"
    lake.merge("t", spark.createDataFrame([(f"k{i}", i, date(2024, 1, 1 + i % 3)) for i in range(30)], schema))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    changed = spark.createDataFrame([(f"k{i}", -i, date(2024, 1, 1 + i % 3)) for i in range(20, 40)], schema)
    lake.merge("t", changed.mapInArrow(counted, schema))
    assert seen.value == 20
    assert rows(lake.read("t").select("k", "v")) == sorted([(f"k{i}", i if i < 20 else -i) for i in range(40)], key=repr)

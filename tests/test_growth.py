"""As-of joins, versions that share partitions, Z-order files, streaming upserts and resumed totals."""

import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import events, pnl, resume
from tidemark.operators.asof import asof_join
from tidemark.operators.relational import differences, differing_buckets, symmetric_difference
from tidemark.session import fresh_path
from tidemark.sources import tables as T
from tidemark.sources.snapshots import SharedPartitions
from tidemark.streaming import alerts
from tidemark.streaming import landing as ST
from tidemark.streaming.upserts import upsert_stream

DAY = datetime(2024, 1, 1)
NOON = datetime(2024, 2, 1, 12)


# --- as-of join -----------------------------------------------------------------------


def plain_asof(left, right, tolerance=None):
    """(id, k, t, matched t, x) by looking at all right rows of each left row."""
    out = []
    for i, k, t in left:
        fit = [(rt, x) for rk, rt, x in right if rk == k and rt is not None and t is not None and rt <= t and (tolerance is None or rt >= t - tolerance)]
        best = max(fit, key=lambda r: (r[0], r[1] is not None, r[1] or ""), default=(None, None))
        out.append((i, k, t, *best))
    return sorted(out, key=repr)


def sides(spark, n=400):
    rnd = random.Random(6)
    key = lambda: rnd.choice(["hot", "hot", "hot", "a", "b", None])
    moment = lambda: None if rnd.random() < 0.05 else rnd.randrange(0, 300)
    left = [(i, key(), moment()) for i in range(n)] + [(1, "a", 5), (1, "a", 5)]
    right = [(key(), moment(), rnd.choice(["p", "q", "r", None])) for _ in range(n // 2)]
    right += [right[0], right[1]]
    return left, right, spark.createDataFrame(left, "id int, k string, t int").repartition(4), spark.createDataFrame(right, "k string, t int, x string").repartition(3)


@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_equals_brute_force(spark, rows, tolerance):
    left, right, l_df, r_df = sides(spark)
    got = asof_join(l_df, r_df, ["k"], "t", None if tolerance is None else F.lit(tolerance))
    assert got.columns == ["id", "k", "t", "t_right", "x"]
    assert rows(got) == plain_asof(left, right, tolerance)


def test_asof_without_keys_and_inner(spark, rows):
    left, right, l_df, r_df = sides(spark, 120)
    got = asof_join(l_df.drop("k"), r_df.drop("k"), [], "t", how="inner")
    want = [(i, t, rt, x) for i, _, t, rt, x in plain_asof([(i, None, t) for i, _, t in left], [(None, t, x) for _, t, x in right])]
    assert rows(got) == [r for r in sorted(want, key=repr) if r[2] is not None]
    empty = asof_join(l_df, r_df.limit(0), ["k"], "t")
    assert empty.filter("x is null and t_right is null").count() == len(left)
    assert asof_join(l_df.limit(0), r_df, ["k"], "t").count() == 0


def test_asof_refuses_clashing_names(spark):
    _, _, l_df, r_df = sides(spark, 10)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(l_df.withColumn("x", F.lit(1)), r_df, ["k"], "t")
    with pytest.raises(ValueError, match="how"):
        asof_join(l_df, r_df, ["k"], "t", how="outer")


# --- versions -----------------------------------------------------------------------------

SCHEMA = "k int, v string, p string"


@pytest.fixture
def table(spark):
    df = spark.createDataFrame([(i, f"v{i}", None if i % 6 == 5 else f"p{i % 6}") for i in range(60)], SCHEMA)
    made = SharedPartitions(spark, fresh_path(spark, "shared"), df.schema, ["p"])
    made.create(df, NOON)
    return made


def folders(table, version):
    return {r.p: r.folder for r in table.folders(version).collect()}


def test_a_merge_writes_the_touched_partition_only(spark, table, rows):
    table.merge(spark.createDataFrame([(1, "new", "p1"), (601, "added", "p1")], SCHEMA), ["k"], NOON + timedelta(days=1))
    before, after = folders(table, 0), folders(table, 1)
    assert {p for p in after if after[p] != before[p]} == {"p1"}
    assert [r.n_folders_written for r in table.history().orderBy("version").collect()] == [6, 1]
    assert table.read().count() == 61 and table.read(version=0).count() == 60
    assert rows(table.read().filter("k in (1, 601)")) == [(1, "new", "p1"), (601, "added", "p1")]
    assert table.read(timestamp=NOON).filter("v = 'new'").isEmpty()
    assert table.read(where=F.col("p") == "p2").count() == 10
    assert len(table.read(where=F.col("p") == "p2").inputFiles()) < len(table.read().inputFiles())


def test_keys_that_move_and_partitions_that_empty(spark, table, rows):
    moved = table.read().filter("p = 'p2'").withColumn("p", F.lit(None).cast("string"))
    table.merge(moved, ["k"], NOON)
    assert "p2" not in folders(table, 1)
    assert table.read().groupBy("k").count().filter("count > 1").isEmpty()
    assert table.read().filter("p is null").count() == 20
    assert table.read(version=0).filter("p = 'p2'").count() == 10


def test_a_writer_that_stops_leaves_the_version_before(spark, table, monkeypatch):
    change = spark.createDataFrame([(1, "lost", "p1")], SCHEMA)
    monkeypatch.setattr(SharedPartitions, "folders", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        table._commit(change, None, NOON, "MERGE")
    monkeypatch.undo()
    assert table.version() == 0 and table.read().filter("v = 'lost'").isEmpty()
    table.merge(spark.createDataFrame([(1, "kept", "p1")], SCHEMA), ["k"], NOON)
    assert table.version() == 1 and table.read().filter("v = 'kept'").count() == 1 and table.read().count() == 60


def test_empty_tables(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    made = SharedPartitions(spark, fresh_path(spark, "shared"), schema, ["p"])
    with pytest.raises(ValueError, match="version"):
        made.read()
    made.create(spark.createDataFrame([], schema), NOON)
    assert made.read().count() == 0
    made.merge(spark.createDataFrame([(1, "a", None)], SCHEMA), ["k"], NOON)
    made.merge(spark.createDataFrame([], SCHEMA), ["k"], NOON)
    assert made.read().count() == 1 and made.version() == 2


# --- Z-order ---------------------------------------------------------------------------------


def share_of_groups(path, column, value):
    """Of all row groups below a path, those whose range of a column holds a value."""
    found = total = 0
    for part in sorted(path.rglob("*.parquet")):
        data = pq.ParquetFile(part)
        at = data.schema_arrow.names.index(column)
        for g in range(data.num_row_groups):
            stats = data.metadata.row_group(g).column(at).statistics
            total, found = total + 1, found + (stats.min <= value <= stats.max)
    return found / total


def test_z_order_prunes_by_every_column(spark, tmp_path):
    source = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("a"), F.pmod(F.xxhash64(F.col("id") + 1), F.lit(9)).alias("b0"), "id")
    source = source.select("a", F.concat(F.lit("name-"), F.pmod(F.xxhash64(F.col("id") * 7), F.lit(500)).cast("string")).alias("b"), "id")
    source.write.parquet(f"{tmp_path}/source")
    size = T.stored_bytes(spark, f"{tmp_path}/source")
    for curve in ("columns", "z"):
        T.compact(spark, f"{tmp_path}/source", f"{tmp_path}/{curve}", ["a", "b"], file_bytes=size // 64, curve=curve)
        assert spark.read.parquet(f"{tmp_path}/{curve}").exceptAll(spark.read.parquet(f"{tmp_path}/source")).isEmpty()
        assert spark.read.parquet(f"{tmp_path}/{curve}").columns == ["a", "b", "id"]
    by_z = [share_of_groups(tmp_path / "z", c, v) for c, v in (("a", 50_000), ("b", "name-250"))]
    assert max(by_z) < 0.35, by_z
    assert share_of_groups(tmp_path / "columns", "b", "name-250") > 0.9
    with pytest.raises(ValueError, match="curve"):
        T.compact(spark, f"{tmp_path}/source", f"{tmp_path}/x", ["a"], curve="h")


def test_places_on_the_curve(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    got = {(r.x, r.y): r.z for r in df.withColumn("z", T.z_order(df, ["x", "y"], bits=2)).collect()}
    assert got == {(x, y): sum((x >> b & 1) << (2 * b + 1) | (y >> b & 1) << (2 * b) for b in range(2)) for x in range(4) for y in range(4)}


# --- streaming upsert ---------------------------------------------------------------------------


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The query dies after its rows were committed and before the batch is checkpointed; the next one replays it."""
    rows = spark.createDataFrame([(i % 20, i, f"p{i % 3}") for i in range(90)], "k int, n int, p string")
    rows.repartition(4).write.parquet(f"{tmp_path}/landed")
    made = SharedPartitions(spark, fresh_path(spark, "stream"), rows.schema, ["p"])
    merge, calls = made.merge, []

    def dies_after_commit(*args, **options):
        done = merge(*args, **options)
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped between write and checkpoint")
        return done

    made.merge = dies_after_commit
    stream = lambda: ST.file_source(spark, f"{tmp_path}/landed", rows.schema, max_files=1)
    with pytest.raises(Exception, match="stopped between"):
        upsert_stream(stream(), made, ["k"], ["n"], f"{tmp_path}/check", "q", NOON).awaitTermination()
    versions = made.version()
    upsert_stream(stream(), made, ["k"], ["n"], f"{tmp_path}/check", "q", NOON).awaitTermination()
    assert len(calls) == 4 and made.version() == versions + 2
    assert sorted((r.k, r.n) for r in made.read().collect()) == sorted((k, max(i for i in range(90) if i % 20 == k)) for k in range(20))
    assert made.merge(rows.limit(1), ["k"], NOON, "q", 0) is None


# --- resumed totals ---------------------------------------------------------------------------------


def test_ten_increments_equal_one_run(spark, rows):
    rnd = random.Random(2)
    data = []
    for i in range(700):
        wallet, token = rnd.choice(["hot", "hot", "w1", "w2", "w3"]), rnd.choice(["x", "y", None])
        at = None if rnd.random() < 0.01 else DAY + timedelta(hours=i // 3 * 3)
        data.append((wallet, token, "s", i, at, rnd.choice(["BUY", "BUY", "SELL", "SWAP"]), float(rnd.randint(1, 9)), float(rnd.randint(1, 500)), min(9, i // 70 + (rnd.random() < 0.05) * 3)))
    schema = "wallet_address string, token_address string, token_symbol string, trade_id long, trade_time timestamp, side string, quantity double, usd double, step int"
    trades = spark.createDataFrame(data, schema).repartition(3)
    store = resume.RunningCost(spark, fresh_path(spark, "running"))
    with pytest.raises(ValueError, match="no trades"):
        store.results()
    for step in range(10):
        store.add(trades.filter(F.col("step") == step).drop("step"), NOON)
    names = [c for c in store.results().columns if c != "last_price"]
    close = lambda df: df.select(*[F.round(c, 6).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in names])
    assert rows(close(store.results())) == rows(close(pnl.running_cost_by_token(trades.drop("step"), include_unbought=True)))


def test_an_increment_on_time_reads_new_trades_only(spark, monkeypatch):
    schema = "wallet_address string, token_address string, token_symbol string, trade_id long, trade_time timestamp, side string, quantity double, usd double"
    day = lambda i, side, usd: ("w", "t", "s", i, DAY + timedelta(days=i), side, 2.0, usd)
    store = resume.RunningCost(spark, fresh_path(spark, "running"))
    store.add(spark.createDataFrame([day(1, "BUY", 10.0)], schema), NOON)
    read = []
    monkeypatch.setattr(resume.RunningCost, "_trades", lambda self, pairs, last, f=resume.RunningCost._trades: read.append(pairs.count()) or f(self, pairs, last))
    store.add(spark.createDataFrame([day(3, "SELL", 14.0)], schema), NOON)
    assert read == [] and store.results().first().realized_pnl == 4.0
    store.add(spark.createDataFrame([day(2, "BUY", 30.0)], schema), NOON)
    assert read == [1] and store.results().first().realized_pnl == -6.0


# --- alerts on a stream ---------------------------------------------------------------------------


def test_an_increment_is_stored_in_few_files(spark):
    """Files follow the partitions of pairs, not these times the tasks that deliver the trades."""
    start = datetime(2024, 1, 1)
    data = [(f"w{i % 40}", "t", "s", f"x{i}", start + timedelta(hours=i), "BUY", 1.0, 2.0) for i in range(640)]
    schema = "wallet_address string, token_address string, token_symbol string, trade_id string, trade_time timestamp_ntz, side string, quantity double, usd double"
    root = fresh_path(spark, "running")
    store = resume.RunningCost(spark, root)
    store.add(spark.createDataFrame(data, schema).repartition(8))
    stored = spark.read.parquet(f"{root}/trades")
    assert stored.count() == 640
    assert stored.select(F.col("_metadata.file_path")).distinct().count() <= resume.PARTS


def test_stream_alerts_equal_batch_alerts(spark, rows, tmp_path):
    rnd = random.Random(9)
    made = [
        (DAY + timedelta(minutes=rnd.randrange(3 * 24 * 60)), rnd.choice(["hot", "hot", "hot", "cold", None]), rnd.choice([1.0, 8.0, 64.0, 60000.0]), rnd.choice([0.0, 2.0, 4.0]))
        for _ in range(500)
    ]
    made += [(DAY, "rare", 1.0, 1.0), (DAY + timedelta(hours=30), "rare", 900.0, 1.0), (None, "hot", 7.0, 1.0)]
    made.sort(key=lambda r: r[0] or DAY)
    late = [(DAY + timedelta(hours=1), "hot", 1e9, 1.0)]
    closing = [(DAY + timedelta(days=5), "end", 1.0, 1.0)]
    schema = "trade_time timestamp, token_address string, usd double, quantity double"
    for part in (made[:200], made[200:], late, closing):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ST.file_source(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, max_files=1)
    ST.run_to_end(alerts.activity_alerts(stream, "1 hour", "30 minutes", "6 hours"), f"{tmp_path}/out", f"{tmp_path}/check")
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = events.activity_alerts(spark.createDataFrame(made, schema), "1 hour")
    # The late trade is in no window; gaps of over six hours have no window before.
    columns = ["window_start", "token_address", "volume", "price", "largest_trade", "whale_trade"]
    assert rows(got.filter("token_address = 'hot' or token_address is null")) == rows(batch.filter("token_address = 'hot' or token_address is null"))
    assert rows(got.filter("whale_trade"), *columns) == rows(batch.filter("whale_trade"), *columns)
    assert batch.filter("token_address = 'rare'").count() == 1 and got.filter("token_address = 'rare'").count() == 0


# --- comparison by digests of buckets -------------------------------------------------------------


def test_differences_equal_symmetric_difference(spark, rows):
    rnd = random.Random(4)
    value = lambda: rnd.choice([None, 1, 2, 3])
    a = [(value(), value(), [value(), value()], rnd.choice([0.0, -0.0, float("nan"), None])) for _ in range(300)]
    b = [r for r in a if rnd.random() > 0.2] + [(value(), None, [None, value()], 5.0) for _ in range(40)] + a[:5]
    schema = "bucket int, which int, c array<int>, d double"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    for names in (None, ["which", "bucket"], ["c"]):
        for x, y in ((left, right), (right, left), (left, left.limit(0)), (left.limit(0), left.limit(0))):
            plain = lambda df: sorted(str(r).replace("-0.0", "0.0") for r in rows(df))
            assert plain(differences(x, y, names, buckets=8)) == plain(symmetric_difference(x, y, names))


def test_nulls_that_change_columns_are_seen(spark):
    left = spark.createDataFrame([(None, 1, [None, 2])], "a int, b int, c array<int>")
    for other in ([(1, None, [None, 2])], [(None, 1, [2, None])], [(None, 1, [2])]):
        assert differences(left, spark.createDataFrame(other, left.schema)).count() == 2


def test_equal_tables_have_no_differing_bucket(spark):
    rows_ = spark.range(20_000).selectExpr("id % 700 as k", "cast(id as string) as t", "id / 3.0 as x", "if(id % 3 = 0, null, id) as n")
    assert differing_buckets(rows_, rows_.repartition(7, "t")).count() == 0
    one_less = rows_.filter("t <> '77'")
    assert differing_buckets(rows_, one_less).count() == 1
    found = differences(rows_, one_less).collect()
    assert [(r.t, r.which_diff) for r in found] == [("77", "a_minus_b")]

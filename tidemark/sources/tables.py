"""Named tables in bronze, silver and gold folders, their keys, partitions and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import moment as at_moment
from tidemark.operators.incremental import require_compatible, upsert
from tidemark.operators.ordered import sampled_bucket
from tidemark.session import cut_lineage, path_exists, remove_path, setting, stored_bytes

# Files that a task keeps open at once before it sorts its rows by partition.
OPEN_FILES = 16
# Size of a file that compaction aims at.
FILE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


# The tables of the two data flows with their partition and clustering columns.
TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("tokens", "bronze", ("token_address",), ("processing_date",), ("liquidity", "volume_24h_usd")),
        TableSpec("holders", "bronze", ("wallet_address", "token_address"), ("rank_date",), ("ui_amount", "rank")),
        TableSpec("swaps", "bronze", ("transaction_hash", "base_address"), ("transaction_date",), ("wallet_address", "timestamp")),
        TableSpec("webhooks", "bronze", ("webhook_id",), ("processing_date",)),
        TableSpec("tracked_tokens", "silver", ("token_address",), (), ("liquidity", "token_address")),
        TableSpec("tracked_holders", "silver", ("whale_id",), (), ("ui_amount", "whale_id")),
        TableSpec("wallet_pnl", "silver", ("wallet_address", "token_address", "calculation_date"),
                  ("calculation_year", "calculation_month"), ("total_pnl", "trade_count")),
        TableSpec("traders", "gold", ("wallet_address",), ("performance_tier",), ("smart_trader_score", "overall_rank")),
    )
}


class Lake:
    """Reads and writes the named tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, TableSpec] = TABLES):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables

    def spec(self, name: str) -> TableSpec:
        if name not in self.tables:
            raise ValueError(f"unknown table {name!r}")
        return self.tables[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{self.spec(name).layer}/{name}"

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; with a ``schema`` no file footer is read, else the schemas of all files are merged."""
        reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", "true")
        return reader.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def write(self, name: str, df: DataFrame, mode: str = "append") -> None:
        """Partitioned write; an append must fit the stored schema (new columns are fine)."""
        if mode == "append" and self.exists(name):
            require_compatible(self.read(name).schema, df.schema)
        write_partitioned(df, self.path(name), self.spec(name).partition_by, mode)

    def merge(self, name: str, source: DataFrame, **options) -> None:
        """Upsert on the table's keys that rewrites only the partitions it touches.

        Touched are the partitions of the source and those that now hold its keys, so a
        key may change its partition; nulls in keys and partitions are compared like
        values.  A partition that loses all rows is removed.  The merged rows are
        written aside first, since a partition cannot be read and replaced at once.
        """
        spec = self.spec(name)
        if not self.exists(name):
            self.write(name, source, "overwrite")
            return
        stored = self.read(name)
        require_compatible(stored.schema, source.schema)
        source = cut_lineage(source)  # read several times below
        parts = list(spec.partition_by)
        if not parts:
            write_partitioned(cut_lineage(upsert(stored, source, spec.keys, **options)), self.path(name), parts, "overwrite")
            return
        placed = stored.withColumn("__folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
        own = placed.join(source.select(*spec.keys).distinct(), _all_same(placed, source, spec.keys), "left_semi").select(*parts)
        touched = cut_lineage(own.unionByName(source.select(*parts)).distinct())
        affected = placed.join(touched, _all_same(placed, touched, parts), "left_semi")
        merged = cut_lineage(upsert(affected.drop("__folder"), source, spec.keys, **options))
        left = merged.select(*parts).distinct()
        folders = affected.select(*parts, "__folder").distinct()
        emptied = folders.join(left, _all_same(folders, left, parts), "left_anti").select("__folder").distinct().collect()
        write_partitioned(merged, self.path(name), parts, "overwrite", {"partitionOverwriteMode": "dynamic"})
        for row in emptied:  # one row per partition that lost all its rows
            remove_path(self.spark, row["__folder"])

    def compact(self, name: str, target: str, **options) -> None:
        """Rewrite a table elsewhere in files of even size, partitions kept and rows clustered as its spec says."""
        spec = self.spec(name)
        compact(self.spark, self.path(name), target, spec.cluster_by, spec.partition_by, **options)


def _all_same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


# --- scans -----------------------------------------------------------------------------


def read_files(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> DataFrame:
    """Parquet files or globs, columns matched by name over all files."""
    reader = spark.read.option("mergeSchema", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(*paths)


def read_partition(spark: SparkSession, root: str, column: str, value, schema: T.StructType | None = None) -> DataFrame:
    """One partition of a table; an absent table gives an empty frame of ``schema``."""
    if schema is not None and not path_exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(root).filter(F.col(column) == F.lit(value))


def recent_partitions(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Partition dates of the last ``days`` days that exist."""
    recent = F.col(column) >= F.date_sub(as_of, days)
    return df.filter(recent & (F.col(column) <= as_of)).select(column).distinct()


# --- writes -----------------------------------------------------------------------------


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append", options: Mapping[str, str] | None = None
) -> None:
    """Parquet write clustered by the partition columns, so a partition gets few files.

    The rebalance hint lets Spark merge small partitions into one task and split a
    partition value that holds most rows over several, by the sizes it finds.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode(mode).options(**(options or {})).partitionBy(*partition_by).parquet(path)


def write_file_per_partition(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Parquet write with one file per partition.

    A file has one writer, so that each partition is one task's; that task streams its rows into the open files and
    holds what the files buffer.  Sorting them by partition first, as Spark does by default, would hold them all.
    """
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        df.repartition(*partition_by).write.partitionBy(*partition_by).parquet(path)


def append_batch(df: DataFrame, path: str, status_path: str, batch_id: str, moment: datetime, partition_by: Sequence[str] = ()) -> None:
    """Append a batch and one status row with its size, which the write itself counts."""
    spark = df.sparkSession
    written = Observation()
    batch = df.withColumn("batch_id", F.lit(batch_id)).observe(written, F.count(F.lit(1)).alias("n_rows"))
    write_partitioned(batch, path, partition_by)
    status = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(written.get["n_rows"]).cast("bigint").alias("n_rows"),
        at_moment(moment).alias("written_at"),
        F.lit(df.schema.simpleString()).alias("schema_text"),
        F.lit("completed").alias("status"),
    )
    status.write.mode("append").parquet(status_path)


def write_run_metadata(df: DataFrame, path: str, aggregates: Mapping[str, Column]) -> None:
    """One JSON line with figures about a written table."""
    df.agg(*[c.alias(n) for n, c in aggregates.items()]).write.mode("overwrite").json(path)


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
    curve: str = "columns",
) -> None:
    """Rewrite a table into files of about ``file_bytes``, partitions kept and rows clustered on the given columns.

    With ``curve="columns"`` rows are sorted by the first column, then the next; with ``"z"`` along a Z-order
    curve, so that a filter on any one of the columns leaves most files unread.
    """
    if curve not in ("columns", "z"):
        raise ValueError(f"curve must be 'columns' or 'z', got {curve!r}")
    rows = spark.read.parquet(source)
    files = max(1, -(-stored_bytes(spark, source) // file_bytes))
    along = list(cluster_by)
    if curve == "z":
        rows, along = rows.withColumn("__z", z_order(rows, cluster_by)), ["__z"]
    order = [*partition_by, *along]
    clustered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order, *[c for c in cluster_by if c not in order])
    clustered.select(*[c for c in rows.columns if c != "__z"]).write.mode("overwrite").partitionBy(*partition_by).parquet(target)


# Bits of each column in a Z-order: its rank among 2 ** Z_BITS stretches of equally many rows.
Z_BITS = 5


def z_order(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> Column:
    """Place of a row on the Z-order curve through the columns: the bits of their ranks, taken in turn.

    Ranks are those of stretches between cuts sampled from the rows, so values may be of any type and range;
    nulls come first.  The last bits of the first columns are the finest.
    """
    if not 0 < bits * len(columns) < 64:
        raise ValueError("too many bits for one number")
    place = F.lit(0).cast("long")
    for at, column in enumerate(columns):
        rank = sampled_bucket(df, [column], 1 << bits).cast("long")
        for bit in range(bits):
            shift = bit * len(columns) + (len(columns) - 1 - at)
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), shift))
    return place


# --- snapshots ------------------------------------------------------------------------------

_MANIFEST = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


class SnapshotTable:
    """A Parquet table kept as numbered full snapshots.

    A snapshot is written to its own folder first and becomes visible with its
    manifest row.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def history(self) -> DataFrame:
        path = f"{self.root}/manifest"
        if path_exists(self.spark, path):
            return self.spark.read.schema(_MANIFEST).parquet(path)
        return self.spark.createDataFrame([], _MANIFEST)

    def exists(self) -> bool:
        return self._resolve(None, None) is not None

    def _resolve(self, version: int | None, timestamp: datetime | None) -> int | None:
        rows = self.history()
        if version is not None:
            rows = rows.filter(F.col("snapshot_id") == version)
        if timestamp is not None:
            rows = rows.filter(F.col("committed_at") <= at_moment(timestamp))
        return rows.agg(F.max("snapshot_id")).first()[0]

    def read(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        found = self._resolve(version, timestamp)
        if found is None:
            raise ValueError("no such snapshot")
        return self.spark.read.parquet(f"{self.root}/data/snapshot_id={found}")

    def commit(self, df: DataFrame, moment: datetime, operation: str, partition_by: Sequence[str] = ()) -> int:
        latest = self._resolve(None, None)
        number = 0 if latest is None else latest + 1
        path = f"{self.root}/data/snapshot_id={number}"
        written = Observation()
        write_partitioned(df.observe(written, F.count(F.lit(1)).alias("n_rows")), path, partition_by, "overwrite")
        row = self.spark.createDataFrame([(number, moment, operation, written.get["n_rows"])], _MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return number

    def health(self, last: int = 5) -> DataFrame:
        """Latest version, its row count and the latest operations, newest first."""
        rows = self.history()
        newest = rows.agg(
            F.max("snapshot_id").alias("version"),
            F.max_by("n_rows", "snapshot_id").alias("record_count"),
            F.max("committed_at").alias("committed_at"),
        )
        recent = rows.orderBy(F.desc("snapshot_id")).limit(last)
        names = recent.agg(F.reverse(F.array_sort(F.collect_list(F.struct("snapshot_id", "operation")))).alias("ops"))
        operations = names.first()["ops"]
        return newest.select(
            F.col("version").isNotNull().alias("readable"),
            "version",
            "record_count",
            "committed_at",
            F.array(*[F.lit(o["operation"]) for o in operations]).cast("array<string>").alias("recent_operations"),
        )

"""Tables whose versions share the partitions that did not change.

A version is a list of partition folders.  A change writes the folders of the partitions it touches and a new
list, and becomes visible with one small row, the head; until then readers see the version before, and a writer that fails leaves
folders that no list names.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import moment as at_moment
from tidemark.operators.incremental import require_compatible, upsert
from tidemark.session import cut_lineage, path_exists
from tidemark.sources.tables import write_partitioned

_HEAD = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_folders_written", T.LongType()),
    ]
)


class SharedPartitions:
    """A table of a fixed schema with ``partition_by`` columns, which its files hold too."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: Sequence[str]):
        self.spark, self.root, self.schema, self.partition_by = spark, root.rstrip("/"), schema, list(partition_by)

    # --- reading

    def history(self) -> DataFrame:
        """One row per version."""
        path = f"{self.root}/heads"
        if path_exists(self.spark, path):
            return self.spark.read.schema(_HEAD).parquet(path)
        return self.spark.createDataFrame([], _HEAD)

    def version(self, timestamp: datetime | None = None) -> int | None:
        rows = self.history()
        if timestamp is not None:
            rows = rows.filter(F.col("committed_at") <= at_moment(timestamp))
        return rows.agg(F.max("version")).first()[0]

    def folders(self, version: int) -> DataFrame:
        """The partition columns, folder and number of rows of each partition of a version."""
        return self.spark.read.schema(self._listed()).parquet(f"{self.root}/lists/version={version}")

    def read(self, version: int | None = None, timestamp: datetime | None = None, where: Column | None = None) -> DataFrame:
        """A version (the last one, or the last until ``timestamp``); ``where`` over partition columns leaves other folders unread."""
        if version is None:
            version = self.version(timestamp)
        if version is None:
            raise ValueError("no such version")
        listed = self.folders(version)
        rows = self._read((listed if where is None else listed.filter(where)).select("folder"))
        return rows if where is None else rows.filter(where)

    def done(self, source: str, batch: int) -> bool:
        """Whether a version holds this batch of this source."""
        return not self.history().filter((F.col("source") == source) & (F.col("batch") == batch)).isEmpty()

    # --- writing

    def create(self, df: DataFrame, moment: datetime) -> int:
        """First version, or one that replaces all rows."""
        return self._commit(df, None, moment, "CREATE")

    def merge(
        self, rows: DataFrame, keys: Sequence[str], moment: datetime, source: str | None = None, batch: int | None = None, **options
    ) -> int | None:
        """Upsert on ``keys`` that writes the touched partitions only and shares all others with the version before.

        Touched are the partitions of the new rows and those that hold their keys now, so a key may change its
        partition.  A batch number of a ``source`` that some version already holds changes nothing (None).
        """
        if source is not None and self.done(source, batch):
            return None
        require_compatible(self.schema, rows.schema)
        rows = cut_lineage(rows)
        current = self.version()
        if current is None or self.folders(current).isEmpty():
            return self._commit(upsert(self.spark.createDataFrame([], self.schema), rows, keys, **options), None, moment, "MERGE", source, batch)
        listed = self.folders(current)
        # Folders that hold a key, found with the key columns alone.
        stored = self._read(listed.select("folder")).withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
        holding = stored.join(rows.select(*keys).distinct(), _same(stored, rows, keys), "left_semi").select(F.regexp_extract("folder", "data/.*$", 0).alias("folder"))
        own = listed.join(rows.select(*self.partition_by).distinct(), _same(listed, rows, self.partition_by), "left_semi").select("folder")
        touched = cut_lineage(holding.unionByName(own).distinct())
        affected = self._read(touched)
        kept = cut_lineage(listed.join(touched, "folder", "left_anti"))
        return self._commit(upsert(affected, rows, keys, **options), kept, moment, "MERGE", source, batch)

    def _listed(self) -> T.StructType:
        kinds = [self.schema[c] for c in self.partition_by]
        return T.StructType([*kinds, T.StructField("folder", T.StringType()), T.StructField("n_rows", T.LongType())])

    def _read(self, folders: DataFrame) -> DataFrame:
        paths = [f"{self.root}/{r.folder}" for r in folders.collect()]  # one path per partition
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _commit(self, df: DataFrame, kept: DataFrame | None, moment: datetime, operation: str, source: str | None = None, batch: int | None = None) -> int:
        current = self.version()
        number = 0 if current is None else current + 1
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        # A folder's name says nothing; the list says what is in it.  Left over folders of a failed writer are replaced.
        name = F.sha2(F.to_json(F.struct(*self.partition_by)), 256)
        path = f"{self.root}/data/version={number}"
        write_partitioned(df.withColumn("__folder", name), path, ["__folder"], "overwrite")
        if path_exists(self.spark, path) and not df.isEmpty():
            written = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(path)
            found = F.regexp_extract("_metadata.file_path", "(data/version=[0-9]+/__folder=[0-9a-f]+)/", 1)
            fresh = written.groupBy(*self.partition_by, found.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))
        else:
            fresh = self.spark.createDataFrame([], self._listed())
        whole = fresh if kept is None else kept.select(*fresh.columns).unionByName(fresh)
        whole.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/lists/version={number}")
        listed = self.folders(number)
        mine = F.count_if(F.startswith("folder", F.lit(f"data/version={number}/")))
        totals = listed.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), mine.alias("written")).first()
        row = (number, moment, operation, source, batch, totals["n"], totals["written"])
        self.spark.createDataFrame([row], _HEAD).coalesce(1).write.mode("append").parquet(f"{self.root}/heads")
        return number


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[c])
    return same


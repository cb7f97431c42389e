"""Keeping tables current: upserts, status columns, refetch windows, high-water marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings as S
from tidemark.functions.market import first_label
from tidemark.functions.scalars import moment

# --- upsert ------------------------------------------------------------------------------


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | Mapping[str, Column] | None = None,
    insert: bool = True,
    only_if: Column | None = None,
    check_source: bool = True,
) -> DataFrame:
    """The target after merging the source on ``keys``.

    ``update`` names the columns matched rows take from the source (default: all
    shared ones) or maps columns to expressions over the aliases ``t`` and ``s``.
    Unmatched source rows are added when ``insert``.  ``only_if`` limits which
    matched rows change.  A key that occurs twice in the source is an error.
    Keys are compared null-safe, so a key with nulls matches its like and is not
    added again by a second run.
    """
    if check_source:
        twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        if not twice.limit(1).isEmpty():
            raise ValueError(f"source rows are not unique on {list(keys)}")
    if update is None:
        update = [c for c in target.columns if c in source.columns and c not in keys]
    changes = update if isinstance(update, Mapping) else {c: F.col(f"s.{c}") for c in update}

    # Left join and semi join instead of a full join: a small source is broadcast and
    # the target stays where it is, and a key with many target rows can be split.
    t, s = target.alias("t"), source.withColumn("__hit", F.lit(True)).alias("s")
    joined = t.join(s, _same("t", "s", keys), "left")
    matched = F.col("s.__hit").isNotNull()
    if only_if is not None:
        matched = matched & F.coalesce(only_if, F.lit(False))
    kinds = {f.name: f.dataType for f in target.schema}
    columns = [
        (F.when(matched, changes[c]).otherwise(F.col(f"t.{c}")) if c in changes else F.col(f"t.{c}")).cast(kind).alias(c)
        for c, kind in kinds.items()
    ]
    merged = joined.select(*columns)
    if not insert:
        return merged
    present = target.select(*keys).alias("t").join(source.select(*keys).alias("s"), _same("t", "s", keys), "left_semi").distinct()
    added = source.alias("s").join(present.alias("t"), _same("t", "s", keys), "left_anti")
    missing = {c: F.lit(None) for c in kinds if c not in source.columns}
    fresh = added.withColumns(missing).select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])
    return merged.unionByName(fresh)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def update_status(target: DataFrame, done: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Set status columns on the rows whose key occurs in ``done``."""
    return upsert(target, done.select(*keys).distinct(), keys, values, insert=False, check_source=False)


def reset_status(df: DataFrame, values: Mapping[str, Column | None]) -> DataFrame:
    """Set status columns on all rows; None clears a column."""
    return df.withColumns({c: (F.lit(None) if v is None else v).cast(df.schema[c].dataType) for c, v in values.items()})


def new_and_updated(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many source keys are new and how many exist already."""
    known = target.select(*keys).distinct().withColumn("__known", F.lit(True))
    marked = source.select(*keys).distinct().join(known, list(keys), "left")
    return marked.agg(
        F.count_if(F.col("__known").isNull()).alias("new_records"),
        F.count_if(F.col("__known").isNotNull()).alias("updated_records"),
    )


# --- selection --------------------------------------------------------------------------------


def due_for_refetch(df: DataFrame, status: str, fetched_at: str, as_of: Column, days: int, open_states: Sequence[str] = ("pending",)) -> DataFrame:
    """Rows never fetched, still open, or fetched at least ``days`` days ago."""
    stale = F.datediff(as_of, F.col(fetched_at)) >= days
    due = F.col(status).isNull() | F.col(status).isin(*open_states) | stale
    return df.filter(F.coalesce(due, F.lit(False)))


def next_for_refetch(df: DataFrame, stage: str, key: str, as_of: Column, limit: int) -> DataFrame:
    """The ``limit`` rows of a stage that are due, never fetched ones first, then the longest waiting."""
    status, fetched_at, days = S.REFETCH_STAGES[stage]
    due = due_for_refetch(df, status, fetched_at, as_of, days)
    return due.orderBy(F.asc_nulls_first(fetched_at), F.asc(key)).limit(limit)


def latest_activity(df: DataFrame, key: str, time_column: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(time_column).alias("latest_activity"), F.count(F.lit(1)).alias("n_rows"))


def above_high_water(df: DataFrame, column: str, existing: DataFrame, include_equal: bool = False) -> DataFrame:
    """Rows beyond the largest value already processed; all rows when there is none.

    The mark is a literal in the plan, so partition and row-group pruning apply.
    ``include_equal`` re-reads the mark itself, for late rows of the same value
    (deduplicate afterwards).
    """
    mark = existing.agg(F.max(column)).first()[0]
    if mark is None:
        return df
    kind = df.schema[column].dataType
    literal = moment(mark) if isinstance(kind, T.TimestampNTZType) else F.lit(mark).cast(kind)
    return df.filter(F.col(column) >= literal if include_equal else F.col(column) > literal)


def pending_dates(df: DataFrame, column: str, log: DataFrame, log_column: str = "processed_date") -> DataFrame:
    """Dates with data that the processing log does not list."""
    dates = df.select(F.col(column).alias(log_column)).distinct()
    return dates.join(log.select(log_column).distinct(), log_column, "left_anti")


def log_of(df: DataFrame, column: str, batch_id: str) -> DataFrame:
    """Log rows for the dates in ``df``: rows per date under a batch id."""
    counted = df.groupBy(F.col(column).alias("processed_date")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("batch_id", F.lit(batch_id))


# --- schemas --------------------------------------------------------------------------------------


def schema_diff(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, change, old type, new type)`` with change added, removed, retyped or same."""
    before = {f.name: f.dataType.simpleString() for f in old}
    after = {f.name: f.dataType.simpleString() for f in new}

    def change(name: str) -> str:
        if name not in before:
            return "added"
        if name not in after:
            return "removed"
        return "same" if before[name] == after[name] else "retyped"

    return [(n, change(n), before.get(n), after.get(n)) for n in sorted(before.keys() | after.keys())]


def schema_diff_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.sparkSession.createDataFrame(
        schema_diff(old.schema, new.schema), "column_name string, change string, old_type string, new_type string"
    )


def require_compatible(old: T.StructType, new: T.StructType) -> None:
    """Refuse an append that changes the type of a stored column."""
    retyped = [row for row in schema_diff(old, new) if row[1] == "retyped"]
    if retyped:
        raise ValueError(f"column types changed: {retyped}")


def dataset_kind(columns: Sequence[str]) -> str:
    """Raw swap legs, processed trades or unknown, told by the column names."""
    names = set(columns)
    if {"base_address", "quote_address"} <= names:
        return "raw"
    if {"from_address", "transaction_type"} <= names:
        return "processed"
    return "unknown"


# --- storage age ------------------------------------------------------------------------------------


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file below a path, from the file listing alone; no data is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return listed.select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at")
    )


def age_report(files: DataFrame, layer: str, as_of: Column) -> DataFrame:
    """Files and bytes per age band with the number due for each retention step."""
    age = F.datediff(as_of, F.col("modified_at"))
    bands = first_label([(age <= days, name) for days, name in S.AGE_BANDS], S.AGE_REST)
    steps = S.RETENTION[layer]
    return (
        files.withColumns({"layer": F.lit(layer), "age_band": bands})
        .groupBy("layer", "age_band")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("file_size").alias("bytes"),
            *[F.count_if(age > days).alias(f"{step}_due") for step, days in steps.items()],
        )
    )


def saving_estimate(report: DataFrame) -> DataFrame:
    """Rough savings in MB: 0.3 per compressible file, 0.7 per archivable file, the size share of files to delete."""
    size = F.sum("bytes") / (1024 * 1024)
    return report.groupBy("layer").agg(
        F.round(F.sum("compress_due") * 0.3, 2).alias("compress_mb"),
        F.round(F.sum("archive_due") * 0.7, 2).alias("archive_mb"),
        F.round(F.try_divide(size * F.sum("delete_due"), F.sum("files")), 2).alias("delete_mb"),
    )

"""Generic table transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import slugify_name
from tidemark.operators.ordered import keep_latest
from tidemark.session import cut_lineage

_COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


# --- pivot and unpivot -------------------------------------------------------------


def pivot_columns(
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | float | str = 1,
    else_value: Column | float | None = 0,
    distinct: bool = False,
    slugs: bool = False,
) -> list[Column]:
    """One aggregate per value, for use in ``groupBy(...).agg(*...)``.

    Unlike ``groupBy().pivot()`` a group without matching rows gets the aggregate
    over ``else_value`` and not null.  ``then_value`` may be a column.
    """
    test = _COMPARE[cmp]

    def as_column(x) -> Column:
        return x if isinstance(x, Column) else F.lit(x)

    out = []
    for value in values:
        case = F.when(test(F.col(column), F.lit(value)), as_column(then_value)).otherwise(as_column(else_value))
        if distinct:
            total = {"sum": F.sum_distinct, "count": F.count_distinct}[agg](case)
        else:
            total = getattr(F, agg)(case)
        name = f"{prefix}{value}{suffix}"
        out.append(total.alias(slugify_name(name) if slugs else name))
    return out


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per (row, column) of the columns neither kept (``exclude``) nor removed."""
    skip = {c.lower() for c in (*exclude, *remove)}
    values = [c for c in df.columns if c.lower() not in skip]
    cast = df.select(*exclude, *[F.col(c).cast(cast_to).alias(c) for c in values])
    return cast.unpivot(list(exclude), values, field_name, value_name)


# --- union ----------------------------------------------------------------------------


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """All rows of all relations over the superset of their columns, missing ones null."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}

    def chosen(name: str) -> bool:
        return name.lower() in wanted if wanted else name.lower() not in unwanted

    types: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema:
            if chosen(field.name):
                types.setdefault(field.name, field.dataType.simpleString())
    if not types:
        raise ValueError("no columns left to union")
    types |= {c: t for c, t in (column_override or {}).items() if c in types}

    parts = []
    for name, df in relations.items():
        rows = df.filter(where) if where else df
        columns = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in types.items()
        ]
        if source_column_name:
            columns.insert(0, F.lit(name).alias(source_column_name))
        parts.append(rows.select(*columns))
    return reduce(DataFrame.unionByName, parts)


def tables_like(
    spark: SparkSession, pattern: str, exclude: str | None = None, database: str | None = None
) -> list[str]:
    """Names of catalog tables and views matching an SQL LIKE pattern, any letter case."""
    names = spark.createDataFrame(
        [(t.name,) for t in spark.catalog.listTables(database)], T.StructType([T.StructField("name", T.StringType())])
    )
    kept = names.filter(F.col("name").ilike(pattern))
    if exclude:
        kept = kept.filter(~F.col("name").ilike(exclude))
    return sorted(r["name"] for r in kept.distinct().collect())


def union_tables_like(spark: SparkSession, pattern: str, exclude: str | None = None, **options) -> DataFrame:
    names = tables_like(spark, pattern, exclude)
    return union_relations({n: spark.table(n) for n in names}, **options)


def union_tables_with_prefix(spark: SparkSession, prefix: str, exclude: str | None = None, **options) -> DataFrame:
    return union_tables_like(spark, f"{prefix}%", exclude, **options)


# --- series --------------------------------------------------------------------------------


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    if upper < 1:
        raise ValueError("upper bound must be at least 1")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


_STEP_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
_STEP_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """One row per ``datepart`` from ``start`` up to, not including, ``end``."""
    first, last = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    if datepart in _STEP_SECONDS:
        width = _STEP_SECONDS[datepart]
        gap = F.ceil(F.timestamp_diff("SECOND", first, last) / width)
        step = F.make_dt_interval(secs=(F.col("id") * width).cast("decimal(18,6)"))
    elif datepart in _STEP_MONTHS:
        months = _STEP_MONTHS[datepart]
        gap = F.ceil(F.months_between(last, first) / months)
        step = F.make_ym_interval(F.lit(0), (F.col("id") * months).cast("int"))
    else:
        raise ValueError(f"unknown date part {datepart!r}")
    intervals = spark.range(1).select(gap.cast("bigint").alias("n")).first()["n"]
    if intervals is None or intervals < 1:
        raise ValueError("end must lie after start")
    whole_days = datepart in ("day", "week", "month", "quarter", "year")
    return spark.range(intervals).select((first + step).cast("date" if whole_days else "timestamp_ntz").alias(f"date_{datepart}"))


# --- rows and columns ------------------------------------------------------------------------


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key; rows with nulls are kept."""
    return keep_latest(df, partition_by, order_by)


def star(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "", alias: str | None = None) -> list[Column]:
    """All columns but some, renamed with prefix and suffix."""
    skip = {c.lower() for c in exclude}
    owner = f"{alias}." if alias else ""
    return [F.col(f"{owner}{c}").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in skip]


def column_values(
    df: DataFrame, column: str, order_by: Sequence[Column] | None = None, max_records: int | None = None, where: str | None = None
) -> DataFrame:
    """Distinct values with their number of rows, most frequent first."""
    rows = df.filter(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    ordered = counted.orderBy(*(order_by or [F.desc("n_rows"), F.asc("value")]))
    return ordered if max_records is None else ordered.limit(max_records)


def column_value_list(df: DataFrame | None, column: str, max_records: int, default: list | None = None, **options) -> list:
    """At most ``max_records`` values as a Python list, e.g. to feed ``pivot_columns``."""
    if df is None:
        if default is None:
            raise ValueError("no table and no default given")
        return default
    found = [r["value"] for r in column_values(df, column, max_records=max_records, **options).collect()]
    return found or (default if default is not None else [])


def single_value(df: DataFrame, default=None):
    """First cell of the first row, or ``default``."""
    row = df.select(df.columns[0]).first()
    return default if row is None or row[0] is None else row[0]


def group_by_first(df: DataFrame, n: int):
    """``GROUP BY 1..n``."""
    return df.groupBy(*df.columns[:n])


# --- set operations ------------------------------------------------------------------------------


def symmetric_difference(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found in only one of the two, marked with the side they miss from."""
    names = list(columns or a.columns)
    left, right = a.select(*names), b.select(*names)
    return (
        left.subtract(right).withColumn("which_diff", F.lit("a_minus_b"))
        .unionByName(right.subtract(left).withColumn("which_diff", F.lit("b_minus_a")))
    )


def differing_buckets(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, buckets: int = 16_384) -> DataFrame:
    """Numbers of the hash buckets whose rows, repeats counted, are not the same in both tables.

    Each bucket has a digest that does not depend on the order of rows: the count, the sum of one 64-bit row hash
    and the exclusive or of another.  Only these partial digests are shuffled.  Different rows with equal digests would
    pass as equal, which for hashes that behave as random numbers takes a chance of about 2^-64 or less a bucket.
    """
    both = _hashed(a, columns or a.columns, buckets, 1).unionByName(_hashed(b, columns or a.columns, buckets, -1))
    digests = both.groupBy("bucket").agg(
        F.sum("side").alias("rows"), F.sum("signed").alias("total"), F.bit_xor("other").alias("mixed")
    )
    return digests.filter("rows != 0 or total != 0 or mixed != 0").select("bucket")


def differences(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, buckets: int = 16_384) -> DataFrame:
    """The rows of ``symmetric_difference``, comparing row by row only where digests of whole buckets differ.

    Tables that are nearly equal so shuffle few rows, and equal ones none.  There are ``buckets`` bucket
    numbers at most, so their broadcast is bounded.
    """
    names = list(columns or a.columns)
    unlike = F.broadcast(cut_lineage(differing_buckets(a, b, names, buckets).withColumnRenamed("bucket", "__unlike")))

    def suspects(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(*names, _bucket(df, names, buckets).alias("__bucket"))
        return rows.join(unlike, F.col("__bucket") == F.col("__unlike"), "left_semi").drop("__bucket").withColumn("__side", F.lit(side))

    # Column names come from the left table, as in a set operation.
    rows = suspects(a, "a_minus_b").union(suspects(b, "b_minus_a"))
    sides = rows.groupBy(*names).agg(F.min("__side").alias("which_diff"), F.max("__side").alias("__last"))
    return sides.filter(F.col("which_diff") == F.col("__last")).drop("__last")


def _row_hash(df: DataFrame, names: Sequence[str], seed: int) -> Column:
    """A hash of the row that tells at which columns nulls stand (plain hashes skip nulls)."""
    kinds = {f.name: f.dataType for f in df.select(*names).schema}
    plain = lambda n: F.to_json(F.struct(n), {"ignoreNullFields": "false"}) if isinstance(kinds[n], (T.StructType, T.ArrayType)) else F.col(n)
    return F.xxhash64(F.lit(seed), *[part for n in names for part in (F.col(n).isNull(), plain(n))])


def _bucket(df: DataFrame, names: Sequence[str], buckets: int) -> Column:
    return F.pmod(_row_hash(df, names, 1), F.lit(buckets)).cast("int")


def _hashed(df: DataFrame, names: Sequence[str], buckets: int, side: int) -> DataFrame:
    # A decimal total: a row that repeats often enough would overflow a long one.
    total = _row_hash(df, names, 2).cast("decimal(20,0)")
    return df.select(
        _bucket(df, names, buckets).alias("bucket"),
        F.lit(side).cast("long").alias("side"),
        (total if side > 0 else -total).alias("signed"),
        _row_hash(df, names, 3).alias("other"),
    )

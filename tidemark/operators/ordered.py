"""Ordered operators that stay distributed when one group holds most of the rows.

``scan`` gives running sums, minima, carried values, neighbours and positions inside
groups, by one plan for groups of any size: rows are windowed inside
(group, bucket), a bucket being a stretch of the order between two cuts sampled from the rows, and the
buckets of a group are stitched together with one small row each.  The input is computed once: its
rows are written, and sample, buckets and rows are read from there.  Null keys are kept apart like any
other value.

``global_position`` numbers all rows of a frame in a total order without moving
them to one task; the rank functions are built on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, parallelism

# Buckets per shuffle partition, and sampled rows per bucket.
BUCKETS_PER_PART = 4
ROWS_PER_CUT = 32

_AT = "__at"
_BUCKET = "__bucket"
_SLOT = "__slot"
_ROWS = "__rows_here"
_BEFORE = "__rows_before"
_PART = "__part"


def sampled_bucket(df: DataFrame, order: Sequence[str], n: int | None = None) -> Column:
    """Number of the stretch of ``order`` that a row lies in, stretches holding about equally many rows of ``df``.

    Cuts are taken from a sample of rows, so that any type and any range of values is split where the rows
    are; of a group with a share of all rows, one stretch holds as much as of the whole frame at most.  There are ``n``
    stretches at most, by default ``BUCKETS_PER_PART`` for each shuffle partition; the driver holds ``ROWS_PER_CUT`` sampled rows for each.
    """
    n = n or BUCKETS_PER_PART * parallelism(df.sparkSession)
    wanted, total = n * ROWS_PER_CUT, df.count()
    sample = df.select(*order) if total <= wanted else df.select(*order).sample(wanted / total, seed=7)
    rows = [tuple(r) for r in sample.repartition(1).sortWithinPartitions(*order).collect()]
    cuts = list(dict.fromkeys(rows[len(rows) * i // n] for i in range(1, n))) if rows else []
    if not cuts:
        return F.lit(0)
    # Structs compare field by field with nulls first, as the order does.  A row's place is searched by halves in one array of all cuts.
    bounds = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, cut, strict=True)]) for cut in cuts])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    def place(row: Column) -> Column:
        return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(bounds, at + half - 1) <= row, at + half).otherwise(at))

    # Inside the one-element array the row's struct is made once, not for every half.
    return F.get(F.transform(F.array(F.struct(*order)), place), F.lit(0))


def _plus(here: Column, before: Column, kind: T.DataType) -> Column:
    """The sum of a total and what came before; a decimal of most digits gives one up, so that its scale stays."""
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(min(kind.precision, 37), kind.scale)
    return here.cast(kind) + F.coalesce(before.cast(kind), F.lit(0).cast(kind))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: Mapping[str, Column] | None = None,
    tied_sums: Mapping[str, Column] | None = None,
    least: Mapping[str, Column] | None = None,
    least_before: Mapping[str, Column] | None = None,
    carry: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    preceding: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    position: str | None = None,
    bucket: Column | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add running columns per group, rows taken in ascending ``order``.

    Without ``keys`` the whole frame is one group.  ``order`` must be unique inside
    a group except for ``tied_sums``, which are running totals up to and including all
    rows with the same first order column.  ``sums`` are running totals up to and
    including the row, ``least`` running minima, ``least_before`` without the row, ``carry`` the last non-null value
    so far, ``following`` and ``preceding`` the neighbouring row's value,
    ``totals`` sums over the group, ``position`` the 1-based index.

    The input is computed once and written, unless it is ``stored``, a table read without joins or
    aggregates.  Buckets come from cuts that are sampled from it, along keys and order, so that only groups with a cut inside lie in
    several buckets: there are as many (group, bucket) pairs as groups and cuts at most.  A ``bucket`` of one's own must not fall when
    the order rises (with ``tied_sums``: must follow from the first order column), and nothing is written or run while the plan is built.
    Buckets of a group meet in one task with one row each, and so do the rows of one bucket; with ``tied_sums`` that
    includes all rows of one moment.
    """
    sums, tied_sums, least, least_before = sums or {}, tied_sums or {}, least or {}, least_before or {}
    carry, following, preceding, totals = carry or {}, following or {}, preceding or {}, totals or {}
    if bucket is None:
        df = df if stored else cut_lineage(df)
        bucket = sampled_bucket(df, [*keys, *(order[:1] if tied_sums else order)])
    # A struct is never null itself and its null fields are equal, so null keys join like others.
    # The bucket also stands beside it: sorts compare that number first.
    rows = df.withColumn(_BUCKET, bucket).withColumn(_AT, F.struct(*keys, _BUCKET))
    here = [_BUCKET, _AT]

    every_sum = {**sums, **tied_sums}
    every_least = {**least, **least_before}
    at = F.struct(*order)
    per_bucket = [F.count(F.lit(1)).alias(_ROWS)]
    per_bucket += [F.sum(x).alias(f"__p_{n}") for n, x in [*every_sum.items(), *totals.items()]]
    per_bucket += [F.min(x).alias(f"__p_{n}") for n, x in every_least.items()]
    per_bucket += [F.max_by(x, F.when(x.isNotNull(), at)).alias(f"__p_{n}") for n, x in carry.items()]
    per_bucket += [F.min_by(x, at).alias(f"__p_{n}") for n, x in following.items()]
    per_bucket += [F.max_by(x, at).alias(f"__p_{n}") for n, x in preceding.items()]
    parts = rows.groupBy(*here).agg(*per_bucket)

    group = [F.col(_AT)[k] for k in keys]
    across = Window.partitionBy(*group).orderBy(F.asc_nulls_first(_BUCKET))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = {_BEFORE: F.sum(_ROWS).over(before)}
    edges |= {f"__e_{n}": F.sum(f"__p_{n}").over(before) for n in every_sum}
    edges |= {f"__e_{n}": F.min(f"__p_{n}").over(before) for n in every_least}
    edges |= {f"__e_{n}": F.last(f"__p_{n}", ignorenulls=True).over(before) for n in carry}
    edges |= {f"__e_{n}": F.lead(f"__p_{n}").over(across) for n in following}
    edges |= {f"__e_{n}": F.lag(f"__p_{n}").over(across) for n in preceding}
    edges |= {f"__e_{n}": F.sum(f"__p_{n}").over(Window.partitionBy(*group)) for n in totals}
    stitches = parts.withColumns(edges).select(*here, _ROWS, *edges)

    inner = Window.partitionBy(*here).orderBy(*order)
    so_far = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = {n: F.sum(x).over(so_far) for n, x in sums.items()}
    inside |= {n: F.sum(x).over(Window.partitionBy(*here).orderBy(order[0])) for n, x in tied_sums.items()}
    inside |= {n: F.min(x).over(so_far) for n, x in least.items()}
    inside |= {n: F.min(x).over(inner.rowsBetween(Window.unboundedPreceding, -1)) for n, x in least_before.items()}
    inside |= {n: F.last(x, ignorenulls=True).over(so_far) for n, x in carry.items()}
    inside |= {n: F.lead(x).over(inner) for n, x in following.items()}
    inside |= {n: F.lag(x).over(inner) for n, x in preceding.items()}
    inside[_SLOT] = F.row_number().over(inner).cast("bigint")
    joined = rows.withColumns(inside).join(stitches, here)

    edge = lambda n: F.col(f"__e_{n}")
    kinds = {n: joined.schema[n].dataType for n in every_sum}
    out = {n: F.when(F.col(n).isNull(), edge(n)).otherwise(_plus(F.col(n), edge(n), kinds[n])).cast(kinds[n]) for n in every_sum}
    out |= {n: F.least(n, edge(n)) for n in every_least}
    out |= {n: F.coalesce(F.col(n), edge(n)) for n in carry}
    out |= {n: F.when(F.col(_SLOT) == F.col(_ROWS), edge(n)).otherwise(F.col(n)) for n in following}
    out |= {n: F.when(F.col(_SLOT) == 1, edge(n)).otherwise(F.col(n)) for n in preceding}
    out |= {n: edge(n) for n in totals}
    if position:
        out[position] = F.col(_SLOT) + F.coalesce(F.col(_BEFORE), F.lit(0))
    return joined.select(*[c for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def global_position(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str,
    within: Mapping[str, Sequence[str]] | None = None,
    percent: Mapping[str, str] | None = None,
) -> DataFrame:
    """1-based position of every row in the total order ``order``.

    Range-partition, sort each part, number rows by (part, slot) and add the part
    offsets.  The offsets are one number per shuffle partition.  ``within`` adds
    positions inside groups under the same order, from one more count per part and group.
    ``percent`` adds ``percent_rank`` ascending by a column that ``order`` puts largest first: the rows
    below a value are those behind its last position, which is known per part and value.  Rows
    meet their part's row only, so a value that nearly all rows share is joined part by part.
    """
    spark = df.sparkSession
    columns = df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()))
    # The generated id holds the partition number above bit 33 and the row slot below it.
    part, slot = F.shiftrightunsigned("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r[_PART]):
        offsets.append((row[_PART], total))
        total += row["n"]
    schema = T.StructType([T.StructField(_PART, T.LongType()), T.StructField("__before", T.LongType())])
    lookup = F.broadcast(spark.createDataFrame(offsets, schema))
    placed = numbered.withColumn(_PART, part.cast("bigint")).join(lookup, _PART)
    placed = placed.withColumn(name, F.col("__before") + slot + 1)
    for inner_name, groups in (within or {}).items():
        at = F.struct(_PART, *groups)
        counts = placed.groupBy(at.alias(_AT)).agg(F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy(*[F.col(_AT)[g] for g in groups]).orderBy(F.col(_AT)[_PART]).rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(_AT, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))
        rows = placed.withColumn(_AT, at).withColumn("__here", F.row_number().over(Window.partitionBy(_AT).orderBy("__id")))
        placed = rows.join(starts, _AT).withColumn(inner_name, F.col("__start") + F.col("__here")).drop(_AT, "__start", "__here")
    for share, column in (percent or {}).items():
        at = F.struct(_PART, column)
        lasts = placed.groupBy(at.alias(_AT)).agg(F.max(name).alias("__here"))
        lasts = lasts.select(_AT, F.max("__here").over(Window.partitionBy(F.col(_AT)[column])).alias("__last"))
        below = (F.lit(total) - F.col("__last")) / F.lit(float(total - 1)) if total > 1 else F.lit(0.0)
        placed = placed.withColumn(_AT, at).join(lasts, _AT).withColumn(share, below).drop(_AT, "__last")
    return placed.select(*columns, name, *(within or {}), *(percent or {}))


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``order``.

    The ``= 1`` filter lets Spark keep one row per key and map task before the
    shuffle (WindowGroupLimit), so a key with many copies stays cheap.
    """
    return top_n_per_group(df, keys, order, 1).drop("row_rank")


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, name: str = "row_rank"
) -> DataFrame:
    """The first ``n`` rows of every group, with their rank.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows (1000) the cut
    happens on the map side too.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ranked)).filter(F.col(name) <= n)


def top_n(df: DataFrame, order: Sequence[Column], n: int, name: str = "row_rank") -> DataFrame:
    """The first ``n`` rows of the whole frame, numbered.  Only ``n`` rows reach the last task."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order)))

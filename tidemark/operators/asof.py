"""As-of join: each row with the last row of another table at or before its moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import sampled_bucket, scan
from tidemark.session import cut_lineage


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    tolerance: Column | None = None,
    ties: Sequence[str] = (),
    how: str = "left",
    right_on: str | None = None,
) -> DataFrame:
    """``left`` with the columns of the last ``right`` row that has the same ``by`` and an ``on`` that is not later.

    Both sides are stacked and walked once in order, the last right row carried along, so rows are never
    joined with earlier rows and a group with most of the rows is split like any other (``ordered.scan``).

    * ``by`` columns, of the same names on both sides, are compared null-safe; without any, all rows are one group.
    * A right row at the very moment of a left row counts.  Of right rows with one moment the last in
      ascending ``ties`` counts, then in all its other columns.
    * A null moment matches nothing; left rows with one stay.  With ``tolerance``, an interval or a number, older right rows do not count.
    * ``how="inner"`` drops left rows without a match.  The moment of the right row is called ``right_on``, by default
      ``<on>_right``; other columns may not have the same name on both sides.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    by, right_on = list(by), right_on or f"{on}_right"
    own = [c for c in left.columns if c not in by]
    other = [c for c in right.columns if c not in [*by, on]]
    if clash := sorted({right_on, *other} & set(left.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    late = [*ties, *[c for c in other if c not in ties]]
    known = right.filter(F.col(on).isNotNull())
    payload = F.struct(F.col(on).alias(right_on), *other)
    tie = F.struct(*late) if late else F.lit(0)
    rights = known.select(*by, F.col(on).alias("__on"), F.lit(0).alias("__side"), tie.alias("__tie"), payload.alias("__right"))
    lefts = left.select(*by, F.col(on).alias("__on"), F.lit(1).alias("__side"), F.struct(*own).alias("__left"))
    both = cut_lineage(rights.unionByName(lefts, allowMissingColumns=True))
    # Right rows stand before left rows of their moment.
    order = ["__on", "__side", "__tie"]
    carried = scan(both, by, order, carry={"__last": F.when(F.col("__side") == 0, F.col("__right"))}, bucket=sampled_bucket(both, order[:2]))
    found = F.col("__last")
    if tolerance is not None:
        found = F.when(F.col(f"__last.{right_on}") >= F.col("__on") - tolerance, found)
    walked = carried.filter(F.col("__side") == 1).withColumn("__last", F.when(F.col("__on").isNotNull(), found))
    if how == "inner":
        walked = walked.filter(F.col("__last").isNotNull())
    shown = [F.col(c) if c in by else F.col(f"__left.{c}").alias(c) for c in left.columns]
    return walked.select(*shown, *[F.col(f"__last.{c}").alias(c) for c in (right_on, *other)])

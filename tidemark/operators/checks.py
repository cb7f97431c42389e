"""Data tests.  Each returns the failing rows; an empty frame means passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import scan
from tidemark.operators.relational import symmetric_difference


def _rows() -> Column:
    return F.count(F.lit(1))


def _named(df: DataFrame, columns: Sequence[str], tag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_{tag}") for c in columns], *[c for c in df.columns if c not in columns])


# --- columns -------------------------------------------------------------------------


def not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return (df.filter(where) if where else df).filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(_rows().alias("n_records"))
    return counted.filter(~F.col("value_field").isin(*values))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.select(F.col(column).alias("value_field")).distinct().filter(F.col("value_field").isin(*values))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    value, outside = F.col(column), F.lit(False)
    if low is not None:
        outside = outside | ((value < low) if inclusive else (value <= low))
    if high is not None:
        outside = outside | ((value > high) if inclusive else (value >= high))
    return df.filter(outside)


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    text = F.trim(F.col(column)) if trim else F.col(column)
    return df.withColumn(column, text).filter(F.col(column) == "")


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where the expression is false; with ``column`` it is the part after the column name."""
    return df.filter(~F.expr(f"{column} {expression}" if column else expression))


# --- columns, possibly per group --------------------------------------------------------


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the whole table) without any non-null value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("n_values")).filter(F.col("n_values") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value.  Least and greatest value decide; no distinct is needed."""
    spread = df.groupBy(*group_by).agg(F.min(column).alias("least"), F.max(column).alias("greatest"))
    return spread.filter(F.col("least") == F.col("greatest")).select(*group_by, F.lit(1).cast("bigint").alias("n_distinct"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = df.groupBy(*group_by).agg(F.try_divide(F.count(column), _rows()).alias("not_null_proportion"))
    return share.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame, column: str, datepart: str, interval: int, now: Column, ignore_time: bool = False, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups whose newest value lies before ``now`` minus the interval."""
    kind = "date" if ignore_time else "timestamp_ntz"
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now).cast(kind)
    newest = df.groupBy(*group_by).agg(F.max(column).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", limit).filter(F.col("most_recent") < F.col("threshold"))


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Values that do not follow the previous one by exactly ``interval``; ``stored`` as in ``ordered.scan``."""
    previous = f"previous_{column}"
    rows = df.select(*group_by, column).filter(F.col(column).isNotNull())
    paired = scan(rows, list(group_by), [column], preceding={previous: F.col(column)}, stored=stored)
    if datepart:
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), F.col(previous)).cast("timestamp_ntz")
        return paired.filter(F.col(column).cast("timestamp_ntz") != expected)
    return paired.filter(F.col(column) != F.col(previous) + interval)


_GAP_RULES: dict[str, Callable[[Column, Column], Column]] = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: Sequence[str] = (), gaps: str = "allowed", zero_length: bool = False, stored: bool = False
) -> DataFrame:
    """Ranges that are empty or reversed, or that clash with the next range; ``stored`` as in ``ordered.scan``."""
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(_GAP_RULES)}, got {gaps!r}")
    rows = df.select(*partition_by, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    walked = scan(
        rows,
        list(partition_by),
        ["lower_bound", "upper_bound"],
        following={"next_lower_bound": F.col("lower_bound"), "__has_next": F.lit(True)},
        stored=stored,
    )
    low, high, ahead = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ordered = F.coalesce((low <= high) if zero_length else (low < high), F.lit(False))
    is_last = F.when(F.col("__has_next").isNull(), True)
    apart = F.coalesce(_GAP_RULES[gaps](high, ahead), is_last, F.lit(False))
    return walked.filter(~(ordered & apart)).drop("__has_next")


# --- tables ---------------------------------------------------------------------------------


def unique_combination(df: DataFrame, columns: Sequence[str], where: str | None = None) -> DataFrame:
    counted = (df.filter(where) if where else df).groupBy(*columns).agg(_rows().alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, child_where: str | None = None, parent_where: str | None = None
) -> DataFrame:
    """Non-null child keys without parent; both sides may be filtered first."""
    children = (child.filter(child_where) if child_where else child).select(F.col(column).alias("id"))
    parents = (parent.filter(parent_where) if parent_where else parent).select(F.col(parent_column).alias("id")).distinct()
    return children.filter(F.col("id").isNotNull()).join(parents, "id", "left_anti")


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, other: str) -> DataFrame:
    """Values that occur a different number of times in the two tables."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(name).alias("value")).agg(_rows().alias("num_rows"))

    return symmetric_difference(counts(a, column), counts(b, other)).drop("which_diff")


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows that only one table has."""
    return symmetric_difference(a, b, columns)


def equality_failures(differences: DataFrame) -> DataFrame:
    """Failure count of ``equality``: rows plus the imbalance between the two sides."""
    step = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return differences.agg((_rows() + F.coalesce(F.abs(F.sum(step)), F.lit(0))).alias("failures"))


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str]) -> DataFrame:
    if not group_by:
        marked = a.select(F.lit(True).alias("of_a")).unionByName(b.select(F.lit(False).alias("of_a")))
        return marked.agg(F.count_if("of_a").alias("count_a"), F.count_if(~F.col("of_a")).alias("count_b"))
    left = _named(a.groupBy(*group_by).agg(_rows().alias("count_a")), group_by, "a")
    right = _named(b.groupBy(*group_by).agg(_rows().alias("count_b")), group_by, "b")
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by])
    return left.join(right, same, "full")


def row_counts_compared(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts of both tables per group with their absolute difference (null for a one-sided group)."""
    return _paired_counts(a, b, group_by).withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    return row_counts_compared(a, b, group_by).filter(F.coalesce(F.col("diff_count"), F.lit(0)) > 0)


def row_surplus(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts per group with the surplus of ``a``: the difference, 1 when equal, 0 when fewer."""
    extra = F.col("count_a") - F.col("count_b")
    delta = F.when(extra > 0, extra).when(extra == 0, F.lit(1)).otherwise(F.lit(0))
    return _paired_counts(a, b, group_by).withColumn("row_count_delta", delta.cast("bigint"))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    return row_surplus(a, b, group_by).filter(F.col("row_count_delta") > 0)


def columns_match(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns that are missing or unexpected, any letter case."""
    have, want = {c.lower() for c in df.columns}, {c.lower() for c in expected}
    rows = [(c, "missing") for c in sorted(want - have)] + [(c, "unexpected") for c in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")


def null_profile(df: DataFrame, id_column: str) -> DataFrame:
    """Null count and share of every column, and repeated ids, from one aggregation."""
    counts = [F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    totals = df.agg(_rows().alias("n"), F.count_distinct(id_column).alias("ids"), *counts)
    missing = [
        F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    lines = totals.select(F.col("n").alias("total"), (F.col("n") - F.col("ids")).alias("duplicates"), F.inline(F.array(*missing)))
    return lines.withColumn("null_pct", F.round(F.try_divide(F.col("null_count") * 100.0, "total"), 2))


# --- suites -------------------------------------------------------------------------------------


def run_suite(tests: Mapping[str, DataFrame]) -> DataFrame:
    """``[test, failures]`` for named frames of failing rows.  Only the counts leave the executors."""
    counted = [df.agg(_rows().alias("failures")).select(F.lit(name).alias("test"), "failures") for name, df in tests.items()]
    return reduce(DataFrame.unionByName, counted)


@dataclass(frozen=True)
class TableProfile:
    """What a table must look like: columns, value rules and row counts."""

    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    rules: Mapping[str, str] = field(default_factory=dict)
    min_rows: int = 1


PROFILES = {
    "tokens": TableProfile(("token_address", "symbol", "market_cap", "liquidity"), (), {"positive_market_cap": "market_cap > 0"}),
    "holders": TableProfile(("wallet_address", "token_address", "rank"), (), {"valid_rank": "rank >= 1", "positive_holding": "ui_amount > 0"}),
    "swaps": TableProfile(
        ("wallet_address", "transaction_hash", "timestamp", "tx_type"),
        ("transaction_hash", "base_address"),
        {"amount_present": "base_ui_change_amount <> 0"},
    ),
    "wallet_pnl": TableProfile(
        ("wallet_address", "total_pnl", "realized_pnl", "unrealized_pnl"),
        ("wallet_address", "token_address"),
        {
            "pnl_adds_up": "abs(total_pnl - realized_pnl - unrealized_pnl) < 0.011",
            "positive_trade_count": "trade_count > 0",
        },
    ),
    "gold_traders": TableProfile(
        ("wallet_address", "performance_tier", "total_pnl", "overall_rank"),
        ("wallet_address",),
        {"rank_positive": "overall_rank >= 1"},
    ),
}


def validate(df: DataFrame, profile: TableProfile) -> DataFrame:
    """Failure counts of a profile: columns, nulls, key uniqueness, rules and size.

    Everything that looks at single rows is counted in one pass over the table.
    """
    present = [c for c in profile.required if c in df.columns]
    wrong_columns = len(set(profile.required) - set(present))
    failing = {f"not_null_{c}": F.col(c).isNull() for c in present}
    failing |= {name: ~F.expr(rule) for name, rule in profile.rules.items()}
    counts = {name: F.count_if(test) for name, test in failing.items()}
    counts["columns"] = F.lit(wrong_columns).cast("bigint")
    counts["row_count"] = F.when(_rows() < profile.min_rows, 1).otherwise(0).cast("bigint")
    totals = df.agg(*[c.alias(n) for n, c in counts.items()])
    lines = [F.struct(F.lit(n).alias("test"), F.col(n).alias("failures")) for n in counts]
    results = totals.select(F.inline(F.array(*lines)))
    if profile.keys:
        results = results.unionByName(run_suite({"unique_key": unique_combination(df, profile.keys)}))
    return results


def rank_gaps(df: DataFrame, rank: str, score: str) -> DataFrame:
    """Ranked rows that leave a gap, repeat a rank or come after a lower score."""
    walked = scan(
        df.select(rank, score), [], [rank], preceding={"rank_before": F.col(rank), "score_before": F.col(score)}
    )
    first_wrong = F.col("rank_before").isNull() & (F.col(rank) != 1)
    step_wrong = (F.col(rank) != F.col("rank_before") + 1) | (F.col(score) > F.col("score_before"))
    return walked.filter(first_wrong | F.coalesce(step_wrong, F.lit(False)))


def success_gate(df: DataFrame, valid: Column, minimum: float) -> float:
    """Share of valid rows; raises below ``minimum``."""
    row = df.agg(F.try_divide(F.count_if(valid), _rows()).alias("rate")).first()
    rate = 0.0 if row["rate"] is None else float(row["rate"])
    if rate < minimum:
        raise ValueError(f"only {rate:.2%} of the rows are valid, {minimum:.0%} needed")
    return rate

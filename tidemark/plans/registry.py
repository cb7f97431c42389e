"""Registry of runnable queries and the SQL that states their expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same result on the plain tables."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Named columns rounded, for comparison with another engine."""
    return df.withColumns({c: F.round(c, places) for c in columns})

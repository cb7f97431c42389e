"""Running-cost results that are carried on from one increment of trades to the next."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pnl import PAIR, running_ratios, running_totals
from tidemark.session import cut_lineage
from tidemark.sources.snapshots import SharedPartitions
from tidemark.sources.tables import write_partitioned

# Pairs are dealt to so many partitions by hash.
PARTS = 32

# How the totals of earlier and later trades of a pair combine.
_ADDED = ("realized_pnl", "cost_of_sold", "profitable_sells", "bought_usd", "bought_tokens", "buy_count", "sold_usd", "sold_tokens", "sell_count")
_FIRST = ("first_buy", "first_sell")
_LAST = ("token_symbol", "last_buy", "last_sell", "last_trade")


class RunningCost:
    """Totals per wallet and token, kept between runs.

    ``add`` takes the trades of one increment.  Pairs whose new trades are all later than those before go on from the
    stored totals: their bought tokens and money are the opening balance of the new trades, which are
    the only ones read.  Pairs with a late trade, or one at the last stored moment, are worked out again from their
    own trades, read from their partitions only.  Totals and the number of increments they
    contain are committed together, so an increment that fails half-way leaves no trace and can be added again.
    Trades must not repeat between increments; a null moment counts as late.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._totals: SharedPartitions | None = None

    def add(self, trades: DataFrame, moment: datetime | None = None) -> None:
        part = F.pmod(F.xxhash64(*PAIR), F.lit(PARTS)).cast("int")
        arrived = trades.filter(F.col("side").isin("BUY", "SELL")).withColumn("part", part)
        number = 0 if self._totals is None else self._totals.version() + 1
        path = f"{self.root}/trades/increment={number}"
        write_partitioned(arrived, path, ["part"], "overwrite")
        new = self.spark.read.schema(arrived.schema).parquet(path)
        if self._totals is None:
            found = running_totals(new)
        else:
            before = self._totals.read().drop("part")
            pairs = new.groupBy(*PAIR).agg(F.min("trade_time").alias("first_new"), F.count_if(F.col("trade_time").isNull()).alias("undated"))
            met = cut_lineage(pairs.alias("n").join(before.alias("b"), _pair("n", "b"), "left").select("n.*", *[F.col(f"b.{c}").alias(f"b_{c}") for c in before.columns if c not in PAIR]))
            # A pair that has only undated trades so far has no last trade: its next ones are not compared with anything.
            seen = F.col("b_buy_count").isNotNull()
            late = seen & ~F.coalesce((F.col("first_new") > F.col("b_last_trade")) & (F.col("undated") == 0), F.lit(False))
            again = cut_lineage(met.filter(late).select(*PAIR, part.alias("part")))
            anew = None if again.isEmpty() else running_totals(self._trades(again, number))
            opening = met.filter(seen & ~late).select(*PAIR, F.col("b_bought_tokens").alias("open_tokens"), F.col("b_bought_usd").alias("open_usd"))
            on_time = new.alias("x").join(again.alias("n"), _pair("x", "n"), "left_anti")
            more = running_totals(on_time, opening).alias("m").join(met.filter(seen & ~late).alias("n"), _pair("m", "n"), "left")
            found = more.select(*[_combined(c) for c in before.columns])
            found = found if anew is None else found.unionByName(anew.select(*before.columns))
        found = found.withColumn("part", part)
        if self._totals is None:
            self._totals = SharedPartitions(self.spark, f"{self.root}/totals", found.schema, ["part"])
        self._totals.merge(found, PAIR, moment or datetime.now(), check_source=False)

    def results(self) -> DataFrame:
        """Per wallet and token, as ``pnl.running_cost_by_token`` gives for all trades together."""
        if self._totals is None:
            raise ValueError("no trades were added")
        return running_ratios(self._totals.read().drop("part", "last_trade"))

    def _trades(self, pairs: DataFrame, last: int) -> DataFrame:
        """All stored trades of some pairs, up to an increment."""
        parts = [r.part for r in pairs.select("part").distinct().collect()]  # PARTS numbers at most
        stored = self.spark.read.parquet(f"{self.root}/trades").filter(F.col("increment") <= last).drop("increment")
        return stored.filter(F.col("part").isin(parts)).alias("x").join(pairs.alias("n"), _pair("x", "n"), "left_semi")


def _pair(left: str, right: str):
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in PAIR]
    return same[0] & same[1]


def _combined(name: str):
    new, old = F.col(f"m.{name}"), F.col(f"n.b_{name}")
    if name in PAIR:
        return new.alias(name)
    if name in _ADDED:
        return (new + F.coalesce(old, F.lit(0))).alias(name)
    if name in _FIRST:
        return F.least(old, new).alias(name)
    if name in _LAST:
        return F.greatest(old, new).alias(name)
    return F.coalesce(new, old).alias(name)

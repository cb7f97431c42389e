"""The two batch flows as chains of whole-table steps over snapshot tables.

Each step reads the latest snapshots, computes all wallets or messages in one
plan and commits the result.  Running a flow again on the same input changes no
row.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions.scalars import moment
from tidemark.operators import events as E
from tidemark.operators import incremental as I
from tidemark.operators import pnl, tokens, traders
from tidemark.operators.ordered import keep_latest
from tidemark.session import cut_lineage
from tidemark.sources.tables import SnapshotTable


class Flow:
    """Snapshot tables below one root, written by one run at a time."""

    def __init__(self, spark: SparkSession, root: str, run_at: datetime, batch_id: str):
        self.spark, self.root, self.run_at, self.batch_id = spark, root.rstrip("/"), run_at, batch_id

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")

    def merge(self, name: str, source: DataFrame, keys: list[str], **options) -> DataFrame:
        """Upsert into a table, or create it, and return the stored rows.

        The new rows are worked out once, before they are checked and merged.
        """
        table, source = self.table(name), cut_lineage(source)
        if table.exists():
            table.commit(I.upsert(table.read(), source, keys, **options), self.run_at, "MERGE")
        else:
            table.commit(source, self.run_at, "CREATE")
        return table.read()


class TraderFlow(Flow):
    """Tokens, holders and swaps to wallet results and ranked traders."""

    def track_tokens(self, bronze: DataFrame) -> DataFrame:
        """A token's flags are reset only by a newer row."""
        newer = F.col("s.processing_date") > F.col("t.processing_date")
        return self.merge("tracked_tokens", tokens.tracked_tokens(bronze), ["token_address"], only_if=newer)

    def track_holders(self, bronze: DataFrame) -> DataFrame:
        rows = tokens.tracked_holders(bronze).withColumns(
            {"pnl_processing_status": F.lit("pending"), "pnl_last_processed_at": F.lit(None).cast("timestamp_ntz")}
        )
        return self.merge("tracked_holders", rows, ["whale_id"], only_if=F.col("s.rank_date") > F.col("t.rank_date"))

    def wallet_results(self, swaps: DataFrame) -> DataFrame:
        by_token = pnl.running_cost_by_token(pnl.trades_from_swaps(swaps))
        portfolios = pnl.running_cost_portfolio(by_token)
        rows = portfolios.withColumns(
            {
                "calculation_date": F.lit(self.run_at.date()),
                "batch_id": F.lit(self.batch_id),
                "processed_at": moment(self.run_at),
                "moved_to_gold": F.lit(False),
            }
        )
        keys = ["wallet_address", "token_address", "calculation_date"]
        # A rerun of the day that changes a figure makes the wallet due for gold again.
        audit = ("batch_id", "processed_at", "moved_to_gold")
        figures = [c for c in rows.columns if c not in (*keys, *audit)]
        changed = reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in figures])
        update = {c: F.col(f"s.{c}") for c in (*figures, "batch_id", "processed_at")}
        update["moved_to_gold"] = F.when(changed, F.lit(False)).otherwise(F.col("t.moved_to_gold"))
        return self.merge("wallet_pnl", rows, keys, update=update)

    def mark_holders(self, results: DataFrame) -> DataFrame:
        table = self.table("tracked_holders")
        values = {"pnl_processing_status": F.lit("completed"), "pnl_last_processed_at": moment(self.run_at)}
        table.commit(I.update_status(table.read(), results, ["wallet_address"], values), self.run_at, "STATUS")
        return table.read()

    def gold(self, results: DataFrame) -> DataFrame:
        """Traders out of results not moved yet; ranks are taken over the merged table."""
        todo = results.filter(~F.coalesce("moved_to_gold", F.lit(False)))
        todo = keep_latest(todo, ["wallet_address"], [F.desc("calculation_date")])
        columns = [c for c in results.columns if c != "moved_to_gold"]
        self.merge("qualified", todo.select(*columns), ["wallet_address"])
        ranked = traders.gold_traders(self.table("qualified").read())
        self.table("traders").commit(ranked, self.run_at, "REPLACE", ["performance_tier"])
        done = I.reset_status(results, {"moved_to_gold": F.lit(True)})
        self.table("wallet_pnl").commit(done, self.run_at, "STATUS")
        return self.table("traders").read()

    def run(self, bronze_tokens: DataFrame, bronze_holders: DataFrame, swaps: DataFrame) -> DataFrame:
        self.track_tokens(bronze_tokens)
        self.track_holders(bronze_holders)
        results = self.wallet_results(swaps)
        self.mark_holders(results)
        return self.gold(results)

    def publish(self) -> DataFrame:
        """Addresses to watch, best traders first."""
        rated = traders.simple_traders(self.table("qualified").read())
        return traders.publish_list(rated, S.TOP_TRADERS_KEPT)


class EventFlow(Flow):
    """Landed messages to clean events, transaction details and daily quality figures."""

    def run(self, messages: DataFrame) -> DataFrame:
        """Messages whose (id, processing time) is not stored yet; their dates are counted anew.

        Late messages and those of the newest stored moment are found like any other.
        A message without an id gets one made of its content, so none is lost or read twice.
        """
        content = F.concat(F.lit("unnamed_"), F.sha2(F.to_json(F.struct(*messages.columns)), 256))
        named = messages.withColumn("message_id", F.coalesce("message_id", content))
        table, todo = self.table("events"), named
        if table.exists():
            known = table.read().select("message_id", F.col("processed_at").alias("stored_at"))
            newer = (named["message_id"] == known["message_id"]) & (known["stored_at"] >= named["processed_at"])
            todo = cut_lineage(named.join(known, newer, "left_anti"))
        fresh = cut_lineage(E.silver_events(todo))
        events = self.merge("events", fresh, ["message_id"])
        self.merge("transaction_details", E.transaction_details(fresh), ["message_id"])
        touched = todo.select("processing_date").distinct()
        quality = E.quality_by_date(events.join(touched, "processing_date", "left_semi"))
        return self.merge("quality", quality, ["processing_date"])

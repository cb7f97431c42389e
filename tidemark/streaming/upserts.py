"""Streams that keep one row per key in a table of shared partitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import keep_latest
from tidemark.sources.snapshots import SharedPartitions


def upsert_stream(
    stream: DataFrame, table: SharedPartitions, keys: Sequence[str], newest_by: Sequence[str], checkpoint: str, name: str, moment: datetime | None = None
) -> StreamingQuery:
    """Merge each micro-batch into ``table``, the row of a key that is last in ``newest_by`` staying.

    A batch may hold a key several times and batches may come in any order.  The number of the batch is committed in the
    same row as its rows, under ``name``, so a batch that is replayed after a stop between write and
    checkpoint changes nothing.  Handles what is there and stops; ``moment`` is the commit time, by default the clock.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if table.done(name, number):
            return
        single = keep_latest(batch, keys, [F.desc_nulls_last(c) for c in newest_by])
        at = [F.struct(*[F.col(f"{side}.{c}") for c in newest_by]) for side in ("s", "t")]
        table.merge(single, keys, moment or datetime.now(), name, number, only_if=at[0] >= at[1], check_source=False)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Connected components as repeated edge contraction, distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list with long columns ``a`` and ``b``.

    Each round every node moves to that node at most two edges away, itself
    included, which has the lowest random rank of the round, and edges are
    rewritten to the new nodes.  Two edges, since a hub draws all its neighbours
    to one node then, whatever its own rank; with one, those that rank below it
    would stay.  The number of nodes falls by a constant factor in expectation,
    long chains included; a hub is only ever the key of a partial minimum or of a
    join that adaptive execution can split.  Rounds are written to the shared folder.
    """
    current = cut_lineage(_normal(edges.select("a", "b")))
    moves: list[DataFrame] = []
    while not current.isEmpty():
        rank = F.xxhash64(F.col("b"), F.lit(len(moves)))
        both = current.union(current.select("b", "a"))
        own = current.select(F.col("a"), F.col("a").alias("b")).union(current.select(F.col("b"), F.col("b")))
        near = both.union(own)
        # Written, so that both sides of the join are dealt anew and a hub can be split.
        lowest = cut_lineage(near.groupBy("a").agg(F.min_by("b", rank).alias("b")))
        second = near.join(lowest.select(F.col("a").alias("b"), F.col("b").alias("low")), "b").select("a", F.col("low").alias("b"))
        move = cut_lineage(second.groupBy(F.col("a").alias("node")).agg(F.min_by("b", rank).alias("to")))
        moves.append(move)
        left = current.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        right = left.join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        current = cut_lineage(_normal(right.select(F.col("x").alias("a"), F.col("y").alias("b"))))
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    place = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), "to")
        place = place.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return cut_lineage(place)


def _normal(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()

"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits.  The bits are grouped in parts so that correlated bits
stand together, and each part i gets a threshold t_i with sum(t) = distance -
parts + 1 (-1 leaves a part out): any two fingerprints within ``distance`` agree up to t_i
in at least one part.  The thresholds come from a dynamic programme over the
candidate counts estimated from all distinct fingerprints.  Each fingerprint is
filed under its own value of a part and probes all values within t_i; what meets
in a bucket is verified bit by bit.

Buckets of more than ``CROWDED`` entries are not compared in pairs.  Their
members are probed around their whole fingerprint instead: fingerprints at most
two bits apart have a common point within one bit of both, at most 65
fingerprints lie around one point, and any two of them are at most two bits
apart.  So each fingerprint costs at most 65 rows however many are alike, and no
link is lost.

Defined cases: null and empty texts have no words and fingerprint zero, linked
like any other; a null id never names a group unless the group has no other;
repeated rows get equal results; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, ship
from tidemark.llm.graph import components
from tidemark.session import cut_lineage

SHINGLE = 3
DISTANCE = 2
PARTS = 3
CROWDED = 64
_SEED = 42
_SLICE = 50_000  # shingles whose bits are counted at once


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text's bytes as an unsigned 64-bit number."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    pieces = zip(starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], _SEED) for a, b in pieces], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, print): the fingerprint's bits as a long, and a hash that tells texts with one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = raw_texts(batch.column("text"))
            prints = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            values = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), values], names=["doc_id", "mark", "print"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, print long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """One row per document: doc_id, mark, print, component (a number) and component_id, its smallest doc_id."""
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("print").agg(F.min("doc_id").alias("first_doc")))
    roots = components(links(distinct.select("print"), distance, parts)).withColumnRenamed("node", "print")
    placed = cut_lineage(distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")))
    groups = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = cut_lineage(placed.select("print", "root").join(groups, "root").select("print", F.col("root").alias("component"), "component_id"))
    return prints.join(named, "print").select("doc_id", "mark", "print", "component", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last), of rows with that id the lowest text hash."""
    found = near_duplicates(docs, shingle, distance, parts)
    kept = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("kept"))
    # One struct as the key: its null fields match, and the join and the removal of repeated rows share one shuffle,
    # provided that the same fields may be null on both sides.
    mark = F.coalesce("kept.mark", F.lit(0).cast("long")).alias("mark")
    kept = kept.select(F.struct(F.col("kept.doc_id").alias("doc_id"), mark).alias("__key")).distinct()
    marked = docs.withColumn("__key", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark")))
    return marked.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def links(prints: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct fingerprints within ``distance`` bits."""
    if not 0 <= distance <= 2:
        raise ValueError("distances of 0, 1 and 2 bits are supported")
    together, n = bit_counts(prints)
    masks = group_bits(together, n, parts)
    thresholds = allocate(_estimates(prints, masks, together, n, distance), distance)
    entries = cut_lineage(_entries(prints, masks, thresholds))
    sizes = entries.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = cut_lineage(sizes)
    close = F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) <= distance
    few = entries.join(sizes.filter(F.col("n") <= CROWDED).select("part", "key"), ["part", "key"], "left_semi")
    meet = [F.col("x.part") == F.col("y.part"), F.col("x.key") == F.col("y.key"), F.col("x.print") < F.col("y.print"), close]
    pairs = few.filter("own").alias("x").join(few.alias("y"), meet).select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))
    crowd = entries.join(sizes.filter(F.col("n") > CROWDED).select("part", "key"), ["part", "key"], "left_semi")
    return pairs.union(_around(crowd.select("print").distinct(), distance))


def bit_counts(prints: DataFrame) -> tuple[np.ndarray, int]:
    """How often each pair of bits is set together, over all rows, and the number of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            values = batch.column("print").to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(values), _SLICE):
                part = values[at : at + _SLICE]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(part)
        i, j = np.divmod(np.arange(64 * 64), 64)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "c": total.ravel().astype(np.int64), "n": np.full(4096, n)})

    ship(prints.sparkSession)
    summed = prints.mapInArrow(count, "i int, j int, c long, n long").groupBy("i", "j").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    together, n = np.zeros((64, 64)), 0
    for row in summed.collect():  # 64 x 64 rows
        together[row.i, row.j], n = row.c, row.n
    return together, n


def group_bits(together: np.ndarray, n: int, parts: int) -> list[int]:
    """Bit masks of ``parts`` parts of nearly equal width; each grows by the bit most correlated with it."""
    share = together.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    free, masks = list(range(64)), []
    for width in [64 // parts + (i < 64 % parts) for i in range(parts)]:
        inside = correlation[np.ix_(free, free)]
        members = [free[int(inside.sum(axis=1).argmax())]]
        while len(members) < width:
            rest = [b for b in free if b not in members]
            members.append(rest[int(correlation[np.ix_(rest, members)].sum(axis=1).argmax())])
        free = [b for b in free if b not in members]
        masks.append(sum(1 << b for b in members))
    return masks


def _estimates(prints: DataFrame, masks: list[int], together: np.ndarray, n: int, distance: int) -> list[list[float]]:
    """For each part, estimated cost at thresholds 0 to ``distance``.

    Pairs that agree in a part are counted over all rows; pairs that differ in one
    or two of its bits follow from the share of set bits.  Each probe adds a row.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    sizes = prints.select(F.explode(keys).alias("k")).groupBy("k.part", "k.key").agg(F.count(F.lit(1)).cast("double").alias("n"))
    same = {row.part: row.pairs for row in sizes.groupBy("part").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()}
    share = together.diagonal() / max(n, 1)
    odds = 2 * share * (1 - share) / np.maximum(share**2 + (1 - share) ** 2, 1e-9)
    costs = []
    for i, mask in enumerate(masks):
        own = odds[_bits(mask)]
        one = own.sum()
        two = (one**2 - (own**2).sum()) / 2
        width = len(own)
        reach, rows, cost = 1.0, 1.0, []
        for t in range(distance + 1):
            if t == 1:
                reach, rows = reach + one, rows + width
            if t == 2:
                reach, rows = reach + two, rows + width * (width - 1) / 2
            cost.append(same.get(i, 0.0) * reach + n * rows)
        costs.append(cost)
    return costs


def allocate(costs: list[list[float]], distance: int) -> list[int]:
    """Thresholds of least total cost with sum distance - parts + 1, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t in range(-1, distance + 1):
                candidate = (total + (cost[t] if t >= 0 else 0.0), [*chosen, t])
                if used + t not in following or candidate < following[used + t]:
                    following[used + t] = candidate
        best = following
    return best[distance - len(costs) + 1][1]


def _entries(prints: DataFrame, masks: list[int], thresholds: list[int]) -> DataFrame:
    """Rows (part, key, own, print): the own value of each used part and all values probed around it."""
    entries = []
    for i, (mask, threshold) in enumerate(zip(masks, thresholds, strict=True)):
        ones = [1 << int(b) for b in _bits(mask)]
        flips = [0] if threshold >= 0 else []
        flips += ones if threshold >= 1 else []
        flips += [a | b for k, a in enumerate(ones) for b in ones[:k]] if threshold >= 2 else []
        entries += [(i, _signed(mask), _signed(flip)) for flip in flips]
    probes = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).alias("mask"), F.lit(f).alias("flip")) for i, m, f in entries])
    key = F.col("print").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip"))
    return prints.select("print", F.explode(probes).alias("p")).select("p.part", key.alias("key"), (F.col("p.flip") == 0).alias("own"), "print")


def _around(prints: DataFrame, distance: int) -> DataFrame:
    """Edges among fingerprints of crowded buckets through shared points, at most 65 members to a point."""
    bits = [_signed(1 << b) for b in range(64)]
    if distance == 0:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    if distance == 1:
        points = [F.struct(F.lit(b).alias("bit"), F.col("print").bitwiseAND(F.lit(~b)).alias("at")) for b in bits]
    else:
        points = [F.struct(F.lit(0).cast("long").alias("bit"), F.col("print").bitwiseXOR(F.lit(b)).alias("at")) for b in [0, *bits]]
    around = prints.select("print", F.explode(F.array(*points)).alias("point")).groupBy("point").agg(F.collect_set("print").alias("members"))
    many = around.filter(F.size("members") > 1).select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return many.filter("a < b").distinct()


def _bits(mask: int) -> np.ndarray:
    return np.array([b for b in range(64) if mask >> b & 1])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def hex_print(column: str = "print"):
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


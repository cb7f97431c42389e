"""MinHash near-duplicates from bottom-k sketches of one hash function.

A document is the set of its distinct shingles, hashed once.  Equal sets form one class, so
copies cost one row each.  A class retains its ``SKETCH`` lowest hashes.

* Inverted lists of retained values give the overlapping classes.  Lists of up to ``LIST`` classes
  give pairs and how many values each pair shares; pairs that share too few go, values of longer lists taken as shared.
* The lowest values of both sketches together are a bottom-k sketch of the union; the share of
  them that both have estimates the similarity and filters the pairs.
* Pairs that pass are confirmed on their full sets.

Two linked classes share at least ``least_shared(SKETCH)`` retained values, but for a chance below
``RISK``; sets of up to ``SKETCH`` shingles are retained whole, so nothing is left to chance there.  Hence
longer lists matter only for classes with that many retained values in them.  These meet in crowds.  A crowd
of up to ``MEMBERS`` classes and ``VALUES`` values is compared whole inside one task, which returns connecting edges.  A larger one is compared
with its consensus, the values that more than half of it have.  With D(x) the values in which x differs from it, the symmetric difference of x and y has |D(x)| + |D(y)| - 2 |D(x) & D(y)| values.  So

* x and y are linked whenever their slacks, size * (100 - percent) - |D| * (100 + percent), have a sum of 0 or more, and
  then both are linked in this way to the class of most slack: one row per class;
* otherwise they must share values of D, so those left over by that class meet in inverted lists of D, which are crowds again.
  D(x) without D(y) lies inside the symmetric difference of x and y, which is bounded for linked classes, so that the rarest values of D, one more
  than the bound, suffice, and fewer where the slacks leave no room for the needed overlap.  At most half of a crowd is in such a list, so that this ends.

No pair inside a crowd is written, no list is capped and no link is lost.  A consensus has less than twice as many values as the
average set of its crowd.

Defined cases: null texts and texts without words are empty, linked with nothing, and their own component; rows
with equal sets are one class, whatever their ids, so repeated rows get equal results; rows with one id and other texts are classes
of their own; a null id never names a component unless it has no other, and a row without id is kept only then;
other columns are not carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Words, range_hashes, raw_texts, ship, text_blocks
from tidemark.llm.graph import components
from tidemark.session import cut_lineage

SHINGLE = 4
PERCENT = 80
SKETCH = 64
LIST = 8
RISK = 1e-10
# Values of long lists by which a class finds its crowds.
GUIDES = 20
# So many times a crowd goes on into a larger one.
HOPS = 4
# A crowd of up to so many classes, with so many values together, is compared inside one task.
MEMBERS = 512
VALUES = 1 << 22
# Values of fewer sets of a crowd are counted pair by pair, the others by products of so many columns.
FEW = 12
_COLUMNS = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def least_shared(k: int, percent: int = PERCENT, risk: float = RISK) -> int:
    """The most values c that two sketches of ``k`` values share but for a chance of ``risk``, at a similarity of ``percent``."""
    chance, total = percent / 100, 0.0
    for c in range(k + 1):
        total += math.comb(k, c) * chance**c * (1 - chance) ** (k - c)
        if total > risk:
            return c
    return k


def sets_of(words: Words, shingle: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles; the whole sequence if it has fewer words."""
    hashes = words.hashes()
    counts = np.diff(words.first)
    starts = np.arange(len(hashes))
    whole = range_hashes(hashes, starts, np.minimum(starts + shingle, len(hashes))).view(np.int64)
    for first, n in zip(words.first[:-1].tolist(), counts.tolist(), strict=True):
        if 0 < n < shingle:
            yield range_hashes(hashes[first : first + n], np.array([0]), np.array([n])).view(np.int64)
        else:
            yield np.unique(whole[first : first + max(0, n - shingle + 1)])


def _lowered(block: pa.RecordBatch) -> Words:
    offsets, data = raw_texts(block.column("text"))
    return Words(offsets - offsets[0], _LOWER[data[offsets[0] : offsets[-1]]])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def sketches(docs: DataFrame, shingle: int = SHINGLE, size: int = SKETCH) -> DataFrame:
    """(doc_id, mark, n_shingles, d1, d2, sketch): set size, digest of the set and its lowest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                sizes, digests, lowest = [], [], []
                for values in sets_of(_lowered(block), shingle):
                    sizes.append(len(values))
                    digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                    lowest.append(values[:size])
                both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                columns = [block.column("doc_id"), block.column("mark"), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), _lists(lowest)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_shingles", "d1", "d2", "sketch"])

    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(run, "doc_id long, mark long, n_shingles long, d1 long, d2 long, sketch array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    parsed = cut_lineage(sketches(docs, shingle))
    full = parsed.filter("n_shingles > 0")
    classes = full.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "mark")).alias("row"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = cut_lineage(classes.withColumn("uid", F.monotonically_increasing_id()))
    edges = _links(docs, classes, shingle, percent)
    roots = components(edges).withColumnRenamed("node", "uid")
    placed = cut_lineage(classes.select("uid", "d1", "d2", "first_doc").join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid")))
    named = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = placed.join(named, "root").select("d1", "d2", "component_id")
    linked = full.join(named, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    alone = parsed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


# --- candidates ------------------------------------------------------------------------------


def _links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Edges (a, b) of classes whose components are those of all linked pairs."""
    postings = classes.select("uid", "n", F.explode("sketch").alias("value"))
    lengths = postings.groupBy("value").agg(F.count(F.lit(1)).alias("length"), F.min("uid").alias("head")).filter("length > 1")
    # Written, so that both sides of the join are dealt anew and a crowded value can be split.
    listed = cut_lineage(postings.join(cut_lineage(lengths), "value"))
    long = listed.filter(F.col("length") > LIST).select("uid", "n", "value", "head")
    pairs = _overlapping(listed.filter(F.col("length") <= LIST), classes, long, percent)
    pairs = cut_lineage(_likely(pairs, classes, percent))
    crowds = _crowds(long, percent)
    sets = _sets(docs, classes.select("uid", "row"), pairs, crowds, shingle)
    found, small = [_confirmed(pairs, sets, percent)], []
    while True:
        small.append(crowds.filter("small").select(F.lit(len(small)).alias("level"), "crowd", "uid"))
        large = crowds.filter("not small")
        if large.isEmpty():
            break
        star, crowds = _split(large, sets, percent)
        found.append(star)
    # The bounded crowds of all levels are compared at once.
    found.append(_compared(reduce(DataFrame.unionByName, small), sets, percent))
    return reduce(DataFrame.unionByName, found)


def _needed(n: Column, percent: int) -> Column:
    """How many retained values two linked classes share, the larger with ``n`` shingles; known sets leave nothing to chance."""
    return F.least(F.lit(least_shared(SKETCH, percent)), F.ceil(n * F.lit(percent) / 100))


def _overlapping(lists: DataFrame, classes: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) that share enough retained values, those in long lists taken as shared wherever both have some."""
    members = lists.groupBy("value").agg(F.array_sort(F.collect_list("uid")).alias("members"))
    members = members.groupBy("members").agg(F.count(F.lit(1)).alias("values"))
    first = members.select("members", "values", F.posexplode("members").alias("at", "a"))
    both = first.select("values", "a", F.explode(F.slice("members", F.col("at") + 2, F.size("members"))).alias("b"))
    shared = both.groupBy("a", "b").agg(F.sum("values").alias("shared"))
    in_long = long.groupBy("uid").agg(F.count(F.lit(1)).alias("in_long"))
    own = classes.select("uid", "n").join(in_long, "uid", "left").fillna(0, ["in_long"])
    of = lambda side: own.select(F.col("uid").alias(side), F.col("n").alias(f"n_{side}"), F.col("in_long").alias(f"long_{side}"))
    joined = shared.join(of("a"), "a").join(of("b"), "b").filter(_sizes_fit(percent))
    enough = F.col("shared") + F.least("long_a", "long_b") >= _needed(F.greatest("n_a", "n_b"), percent)
    return joined.filter(enough).select("a", "b")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch does not rule out the similarity."""
    own = lambda side: classes.select(F.col("uid").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n").alias(f"n_{side}"))
    joined = pairs.join(own("a"), "a").join(own("b"), "b").filter(_sizes_fit(percent))
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union))
    # A union of fewer values than a sketch holds is known whole.
    enough = F.when(F.size(union) < SKETCH, 100 * shared >= percent * F.size(union)).otherwise(shared >= least_shared(SKETCH, percent))
    return joined.filter(enough).select("a", "b")


def _sizes_fit(percent: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that are linked by their full sets."""
    own = lambda side: sets.select(F.col("uid").alias(side), F.col("values").alias(f"values_{side}"))
    both = pairs.join(own("a"), "a").join(own("b"), "b")
    shared = F.size(F.array_intersect("values_a", "values_b"))
    union = F.size("values_a") + F.size("values_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _sets(docs: DataFrame, rows: DataFrame, pairs: DataFrame, crowds: DataFrame, shingle: int) -> DataFrame:
    """(uid, values): the full sets of the classes that need them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([block.column("uid"), _lists(list(sets_of(_lowered(block), shingle)))], names=["uid", "values"])

    needed = pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).union(crowds.select("uid")).distinct()
    wanted = rows.join(needed, "uid", "left_semi").select("uid", F.struct("row.doc_id", "row.mark").alias("row"))
    texts = _texts(docs).select(F.struct("doc_id", "mark").alias("row"), "text")
    # A row has one class, so that the join and the removal of repeated rows share a shuffle.
    found = texts.join(wanted, "row").dropDuplicates(["row"]).select("uid", "text")
    return cut_lineage(found.mapInArrow(run, "uid long, values array<long>"))


def _compared(crowds: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges that connect the linked members of each crowd of bounded size of a level, one less than there are members at most."""

    def run(group: pa.Table) -> pa.Table:
        uids = group.column("uid").to_numpy()
        lists = group.column("values").combine_chunks()
        root = linked_rows(np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), percent)
        other = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": uids[root[other]], "b": uids[other]})

    rows = crowds.join(sets, "uid").select("level", "crowd", "uid", "values")
    return rows.groupBy("level", "crowd").applyInArrow(run, "a long, b long")


def linked_rows(sizes: np.ndarray, values: np.ndarray, percent: int) -> np.ndarray:
    """For each of some sets, one behind the other in ``values``, the first set that it is connected with."""
    n = len(sizes)
    of = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    of, values = of[order], values[order]
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(heads, len(values)))
    shared = np.zeros((n, n), dtype=np.int64)
    for c in range(2, FEW):  # values that few sets have: their pairs
        at = heads[counts == c]
        for i in range(c if len(at) else 0):
            for j in range(i):
                shared += np.bincount(of[at + j] * n + of[at + i], minlength=n * n).reshape(n, n)
    common = np.flatnonzero(counts >= FEW)
    for start in range(0, len(common), _COLUMNS):  # the others: products of columns
        some = common[start : start + _COLUMNS]
        column = np.repeat(np.arange(len(some)), counts[some])
        at = np.repeat(heads[some] - (np.cumsum(counts[some]) - counts[some]), counts[some]) + np.arange(len(column))
        has = np.zeros((n, len(some)), dtype=np.float32)
        has[of[at], column] = 1
        shared += np.triu(has @ has.T, 1).astype(np.int64)
    shared += shared.T
    near = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    root = np.full(n, -1)
    for first in range(n):
        front = np.array([first]) if root[first] < 0 else np.zeros(0, np.int64)
        while len(front):
            root[front] = first
            front = np.flatnonzero(near[front].any(axis=0) & (root < 0))
    return root


# --- crowds -----------------------------------------------------------------------------------


def _crowd(least: Column, size: Column, digest: Column) -> Column:
    return F.struct(least.alias("least"), size.alias("size"), digest.alias("digest")).alias("crowd")


def _crowds(long: DataFrame, percent: int) -> DataFrame:
    """(crowd, uid, n, open, small) of the classes that long lists could link without any short one.

    Such a class takes part with its ``GUIDES`` lowest values of long lists; two linked ones share at least one of
    theirs but for a chance below ``RISK``.  The lists whose smallest class is the same form one crowd, and a crowd
    goes into the one that is the largest for most of its classes, so that lists of nearly the same classes count once.
    That one may go on into a larger one; ``HOPS`` steps are followed, and any number keeps the classes of a list together.
    """
    own = Window.partitionBy("uid")  # at most a sketch
    counted = long.withColumns({"in_long": F.count(F.lit(1)).over(own), "place": F.row_number().over(own.orderBy("value"))})
    guides = counted.filter((F.col("in_long") >= _needed(F.col("n"), percent)) & (F.col("place") <= GUIDES))
    placed = cut_lineage(guides.select("uid", "n", "head").distinct())
    into = cut_lineage(_inside(placed))
    step, merged = into.select(F.col("a").alias("b"), F.col("b").alias("next")), into
    for _ in range(HOPS - 1):
        merged = merged.join(step, "b", "left").select("a", F.coalesce("next", "b").alias("b"))
    merged = merged.select(F.col("a").alias("head"), F.col("b").alias("root"))
    named = placed.join(merged, "head", "left").select("uid", "n", F.coalesce("root", "head").alias("head")).distinct()
    named = cut_lineage(named)
    sizes = cut_lineage(named.groupBy("head").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).filter("size > 1"))
    crowd = _crowd(F.col("head"), F.col("size"), F.lit(0).cast("long"))
    return cut_lineage(named.join(sizes, "head").select(crowd, "uid", "n", F.lit(True).alias("open"), _small().alias("small")))


def _small() -> Column:
    return (F.col("size") <= MEMBERS) & (F.col("total") <= VALUES)


def _inside(placed: DataFrame) -> DataFrame:
    """(a, b): heads of crowds more than half of whose classes have crowd b as their largest."""
    sizes = cut_lineage(placed.groupBy("head").agg(F.count(F.lit(1)).alias("size")))
    largest = F.max(F.struct("size", "head")).over(Window.partitionBy("uid"))  # at most a class's guides
    votes = placed.join(sizes, "head").withColumn("into", largest["head"]).groupBy("head", "size", "into").agg(F.count(F.lit(1)).alias("votes"))
    return votes.filter((F.col("votes") * 2 > F.col("size")) & (F.col("into") != F.col("head"))).select(F.col("head").alias("a"), F.col("into").alias("b"))


def _split(crowds: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Edges to the class of most slack of each crowd, and the crowds in which those left over meet."""
    rows = cut_lineage(crowds.select("crowd", "uid").join(sets, "uid"))
    middle = cut_lineage(_consensus(rows))
    # Without a consensus, all values of a set are unlike it.
    unlike = F.coalesce(F.concat(F.array_except("values", "middle"), F.array_except("middle", "values")), "values")
    apart = rows.join(middle, "crowd", "left").select("crowd", "uid", F.size("values").alias("n"), F.array_sort(unlike).alias("unlike"))
    slack = (100 - percent) * F.col("n") - (100 + percent) * F.size("unlike")
    apart = cut_lineage(apart.withColumn("slack", slack.cast("long")))
    best = apart.groupBy("crowd").agg(F.max(F.struct("slack", "uid")).alias("best"), F.min("slack").alias("worst"), F.max("n").alias("longest"))
    rated = cut_lineage(apart.join(cut_lineage(best), "crowd").withColumn("open", F.col("slack") + F.col("best.slack") < 0))
    star = rated.filter(~F.col("open") & (F.col("uid") != F.col("best.uid"))).select(F.col("best.uid").alias("a"), F.col("uid").alias("b"))
    rest = rated.filter(F.col("worst") + F.col("best.slack") < 0)
    postings = _prefixes(rest, percent)
    digest = F.bit_xor(F.xxhash64("uid"))
    lists = postings.groupBy("crowd", "value").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"), F.min("uid").alias("least"), digest.alias("digest"), F.max("open").alias("any")
    )
    following = _crowd(F.col("least"), F.col("size"), F.col("digest")).alias("next")
    lists = cut_lineage(lists.filter("any and size > 1").select(F.struct("crowd", "value").alias("list"), following, _small().alias("small")))
    member = postings.select(F.struct("crowd", "value").alias("list"), "uid", "n", "open").join(lists, "list")
    members = member.groupBy(F.col("next").alias("crowd"), "uid").agg(F.first("n").alias("n"), F.max("open").alias("open"), F.first("small").alias("small"))
    return star, cut_lineage(members)


def _prefixes(rest: DataFrame, percent: int) -> DataFrame:
    """(crowd, uid, n, open, value): of each class the rarest values of D, of as many that two linked classes share one.

    Values that no other class of the crowd has come first and fill a prefix without a row.
    """
    most = F.when(F.col("open"), -F.col("slack") - F.col("best.slack")).otherwise(F.col("best.slack") - F.col("slack") + 1)
    overlap = F.ceil(most / F.lit(2 * (100 + percent)))
    # D without the other's D lies inside the symmetric difference of both sets.
    other = F.least("longest", F.floor(F.col("n") * 100 / F.lit(percent)))
    apart = F.floor((F.col("n") + other) * (100 - percent) / F.lit(100 + percent))
    room = F.least(F.size("unlike") - overlap + 1, apart + 1)
    own = rest.select("crowd", "uid", "n", "open", F.size("unlike").alias("d"), room.alias("room"), F.explode("unlike").alias("value")).filter("room > 0")
    seen = cut_lineage(own.groupBy("crowd", "value").agg(F.count(F.lit(1)).alias("seen")).filter("seen > 1"))
    common = own.join(seen, ["crowd", "value"]).groupBy("crowd", "uid").agg(
        F.first("n").alias("n"), F.first("open").alias("open"), F.first("d").alias("d"), F.first("room").alias("room"), F.array_sort(F.collect_list(F.struct("seen", "value"))).alias("common")
    )
    left = F.greatest(F.col("room") - F.col("d") + F.size("common"), F.lit(0)).cast("int")
    # Written: the lists are built from three passes over it.
    return cut_lineage(common.select("crowd", "uid", "n", "open", F.explode(F.slice("common.value", F.lit(1), left)).alias("value")))


def _consensus(rows: DataFrame) -> DataFrame:
    """(crowd, middle): the values that more than half of the sets of a crowd have; no row for a crowd without any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crowd, lists = batch.column("crowd"), batch.column("values")
            keys = np.stack([crowd.field(f).to_numpy(zero_copy_only=False) for f in ("least", "size", "digest")])
            _, rows_first, of = np.unique(keys, axis=1, return_index=True, return_inverse=True)
            of = np.repeat(of.ravel(), np.diff(lists.offsets.to_numpy()))
            values = lists.flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((values, of))
            of, values = of[order], values[order]
            new = np.ones(len(values), dtype=bool)
            new[1:] = (of[1:] != of[:-1]) | (values[1:] != values[:-1])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(values)))
            yield pa.RecordBatch.from_arrays([crowd.take(pa.array(rows_first[of[at]])), pa.array(values[at]), pa.array(counts.astype(np.int64))], names=["crowd", "value", "seen"])

    schema = "crowd struct<least:long,size:long,digest:long>, value long, seen long"
    counted = rows.select("crowd", "values").mapInArrow(count, schema).groupBy("crowd", "value").agg(F.sum("seen").alias("seen"))
    common = counted.filter(F.col("seen") * 2 > F.col("crowd.size"))
    return common.groupBy("crowd").agg(F.collect_list("value").alias("middle"))

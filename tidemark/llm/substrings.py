"""Substring dedup by anchored phrase hashing, in place of relative Lempel-Ziv parsing, against an index of all documents.

The reference is every document with a smaller id.  Its index is cut in blocks by
anchor: in each window of ``window`` words the ``GRAM``-word gram of lowest hash
is the anchor, so equal windows have equal anchors wherever they stand.  The windows
of a document that share one anchor occurrence form a phrase.

* Each phrase is looked up in every block through one shuffle.  A phrase holds at least ``window``
  words, so one found is long enough to be a duplicate span.  ``factors`` joins found phrases that continue
  the same stretch of a reference document; they do not decide what is removed.
* At the boundaries of copied stretches a phrase is found only in part: there the windows of all
  phrases with that anchor are looked up one by one, against the first owner of each distinct
  phrase.

Both look-ups compare 128-bit hashes and take the smallest owner by a partial
minimum, so a passage in any number of documents costs each of them its own few rows.
The result is exact: a word goes if and only if it lies in a window whose word
sequence also starts in a document with a smaller id.

Defined cases: null and empty texts have no words; documents without an id are
never a reference and lose nothing; rows with the same id are the same document
to each other and each gets its own result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, range_hashes, raw_texts, sha256_hex, ship, text_blocks
from tidemark.session import cut_lineage

WINDOW = 50
GRAM = 10
_SECOND_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

KEY = ["doc_id", "mark"]
_PHRASE = pa.struct([("start", pa.int32()), ("windows", pa.int32()), ("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_PHRASE_SQL = "array<struct<start:int,windows:int,anchor:long,h1:long,h2:long>>"
_FACTOR_SQL = "array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"
_SPAN_SQL = "array<struct<start:int,end:int>>"


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, factors and removed word spans, one row per document."""
    ship(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text")
    )
    parsed = cut_lineage(texts.mapInArrow(_phrases(window), f"doc_id long, mark long, n_words long, sha string, phrases {_PHRASE_SQL}"))
    crossed = cut_lineage(_crossed(texts, parsed.filter("doc_id is not null"), window))
    spans = _spans(crossed, _window_hits(crossed, window), window)
    whole = parsed.select(*KEY, "n_words", "sha").join(spans, KEY, "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
        F.coalesce("factors", F.array().cast(_FACTOR_SQL)).alias("factors"),
        F.coalesce("removed", F.array().cast(_SPAN_SQL)).alias("removed"),
    )


def _phrases(window: int):
    """Task function: number and digest of the words and the phrases of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                words = Words(*raw_texts(block.column("text")))
                shas = [sha256_hex(words.joined(i)) for i in range(b - a)]
                doc, columns = phrases_of(words, window)
                firsts = np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_PHRASE))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        block.column("mark"),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(shas),
                        pa.ListArray.from_arrays(pa.array(firsts), flat),
                    ],
                    names=["doc_id", "mark", "n_words", "sha", "phrases"],
                )

    return run


def phrases_of(words: Words, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Text number of each phrase and its start, number of windows, anchor and two hashes."""
    gram = min(GRAM, window)
    counts = np.diff(words.first)
    n, long_enough = int(words.first[-1]), counts >= window
    none = np.zeros(0, np.int64)
    if not long_enough.any():
        return none, [none.astype(np.int32), none.astype(np.int32), none, none, none]
    hashes = words.hashes()
    places = np.arange(n - gram + 1)
    grams = range_hashes(hashes, places, places + gram)
    lowest = _lowest_places(grams, window - gram + 1)
    docs = np.flatnonzero(long_enough)
    per_doc = counts[docs] - window + 1
    doc = np.repeat(docs, per_doc)
    starts = np.arange(per_doc.sum()) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc) + np.repeat(words.first[docs], per_doc)
    anchors = lowest[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(starts)))
    begin = starts[heads]
    finish = begin + lengths - 1 + window
    h1, h2 = (range_hashes(hashes, begin, finish, base).view(np.int64) for base in (_SECOND_BASE, np.uint64(0x9E3779B97F4A7C15)))
    local = (begin - words.first[doc[heads]]).astype(np.int32)
    return doc[heads], [local, lengths.astype(np.int32), grams[anchors[heads]].view(np.int64), h1, h2]


def _lowest_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the lowest of values[i:i + width], the first on ties; by doubling."""
    low, place, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        take = low[step:] < low[:-step]
        place = np.where(take, place[step:], place[:-step])
        low = np.where(take, low[step:], low[:-step])
        span += step
    return place


def _crossed(texts: DataFrame, parsed: DataFrame, window: int) -> DataFrame:
    """Texts that share an anchor with another document, with their found phrases and the phrases to probe."""
    phrases = parsed.select(*KEY, F.explode("phrases").alias("p")).select(*KEY, "p.*")
    anchors = phrases.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    # Written, so that both sides of the join are dealt anew and a crowded anchor can be split.
    shared = cut_lineage(phrases.join(cut_lineage(anchors.select("anchor")), "anchor", "left_semi"))
    owners = shared.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start", "anchor")).alias("owner"))
    owners = cut_lineage(owners.select("h1", "h2", "owner.anchor", F.col("owner.doc_id").alias("ref_doc"), F.col("owner.start").alias("ref_start")))
    # Anchors whose phrases differ between documents stand at factor boundaries.
    open_anchors = owners.groupBy("anchor").agg(F.min("ref_doc").alias("lo"), F.max("ref_doc").alias("hi")).filter("lo < hi")
    open_anchors = cut_lineage(open_anchors.select("anchor"))
    placed = shared.join(owners.drop("anchor"), ["h1", "h2"])
    found = placed.filter("ref_doc < doc_id").select(*KEY, "start", (F.col("windows") + window - 1).alias("length"), "ref_doc", "ref_start")
    probed = placed.filter("ref_doc = doc_id").join(open_anchors, "anchor", "left_semi")
    probed = probed.select(*KEY, "start", F.col("windows").alias("length"), F.lit(None).cast("long").alias("ref_doc"), F.lit(None).cast("int").alias("ref_start"))
    pieces = found.unionByName(probed).groupBy(*KEY).agg(F.collect_list(F.struct("start", "length", "ref_doc", "ref_start")).alias("pieces"))
    is_found = lambda p: p["ref_doc"].isNotNull()
    return texts.dropDuplicates(KEY).join(pieces, KEY).select(
        *KEY, "text", F.array_sort(F.filter("pieces", is_found)).alias("found"), F.filter("pieces", lambda p: ~is_found(p)).alias("probed")
    )


def _window_hits(crossed: DataFrame, window: int) -> DataFrame:
    """Windows of probed phrases that also start in a document with a smaller id: key and ``starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                words = Words(*raw_texts(block.column("text")))
                hashes = words.hashes()
                lists = block.column("probed")
                flat = lists.flatten()
                doc = np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                first, count = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "length"))
                starts = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                doc = np.repeat(doc, count)
                begin = starts + words.first[doc]
                h1, h2 = (range_hashes(hashes, begin, begin + window, x).view(np.int64) for x in (_SECOND_BASE, np.uint64(0x9E3779B97F4A7C15)))
                keys = [block.column(k).take(pa.array(doc)) for k in KEY]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(starts.astype(np.int32)), pa.array(h1), pa.array(h2)], names=[*KEY, "start", "h1", "h2"])

    probed = crossed.filter(F.size("probed") > 0).select(*KEY, "text", "probed")
    windows = cut_lineage(probed.mapInArrow(run, "doc_id long, mark long, start int, h1 long, h2 long"))
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi")
    hits = windows.join(cut_lineage(first), ["h1", "h2"]).filter("lo < doc_id")
    return hits.groupBy(*KEY).agg(F.collect_list("start").alias("starts"))


def _spans(crossed: DataFrame, hits: DataFrame, window: int) -> DataFrame:
    """Factors, removed spans and the digest of what is left, for the texts in question."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = raw_texts(batch.column("text"))
            out = {"n_removed": [], "kept": [], "factors": [], "removed": []}
            for i, (found, starts) in enumerate(zip(batch.column("found").to_pylist(), batch.column("starts").to_pylist(), strict=True)):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                words = raw.split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                for piece in found:
                    change[piece["start"]] += 1
                    change[piece["start"] + piece["length"]] -= 1
                at = np.array(starts or [], dtype=np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(sha256_hex(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])))
                out["factors"].append(factors(found))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                out["removed"].append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)])
            frame = pa.RecordBatch.from_arrays([batch.column(k) for k in KEY], names=KEY)
            types = [pa.int64(), pa.string(), _FACTORS, _SPANS]
            for (name, values), kind in zip(out.items(), types, strict=True):
                frame = frame.append_column(name, pa.array(values, type=kind))
            yield frame

    joined = crossed.select(*KEY, "text", "found").join(hits, KEY, "left")
    return joined.mapInArrow(run, f"doc_id long, mark long, n_removed long, kept string, factors {_FACTOR_SQL}, removed {_SPAN_SQL}")


_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def factors(found: list[dict]) -> list[dict]:
    """Found phrases in order, each joined to the factor that it continues in the same reference document."""
    out: list[dict] = []
    for piece in found:
        last = out[-1] if out else None
        shift = piece["ref_start"] - piece["start"]
        if last and piece["ref_doc"] == last["ref_doc"] and shift == last["ref_start"] - last["start"] and piece["start"] <= last["start"] + last["length"]:
            last["length"] = max(last["length"], piece["start"] + piece["length"] - last["start"])
        else:
            out.append(dict(piece))
    return out

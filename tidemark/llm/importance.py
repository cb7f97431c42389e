"""Target-distribution importance resampling by bit-sliced sums.

Every run of 1 to ``GRAMS`` consecutive words is a feature and falls into one of ``BUCKETS`` hashed
buckets.  How much likelier a bucket is in the target (``benchmark``) than in the
source (``documents``), smoothed by one count per bucket, is its gain: a whole number of thousandths of a
natural logarithm.  A document's weight is the sum of the gains of its features.

* One pass counts buckets over all documents and all target texts: each task sends at most one row per
  bucket, and ``BUCKETS`` totals reach the driver, whatever the input.
* The gains become bit planes: plane k has bit b set if bit k of bucket b's gain is set, positive and negative gains in planes
  of their own.  The bucket counts of a document become planes in the same way.  For each pair of
  planes the bits of ``counts[j] AND gains[k]`` are counted and weigh 2^(j+k); their signed sum is the weight, exactly.
* Scores add Gumbel noise drawn from a hash of the document id, so the highest scores are a sample
  without replacement in proportion to the exponentials of the weights.  Ranks come from one range partitioning of
  (score, doc_id) by ``ordered.global_position``.

Defined cases: null texts and texts without words have no features and weight 0; a document without id has
a null score and is never drawn nor counted; repeated rows are counted and drawn each by itself, equal ones in any order;
an empty target or source leaves the smoothing alone; other columns are not carried.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, ship, text_blocks
from tidemark.operators.ordered import global_position
from tidemark.session import cut_lineage

BUCKETS = 10_000
GRAMS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Bytes of a feature that are hashed for all features at once; longer ones are hashed one by one.
_SHORT = 32
# Documents whose planes are held at once.
_ROWS = 256

# Words are runs of letters, digits and bytes above 0x7F; A-Z are lower-cased.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[s:e] for each range, byte after byte for all short ranges together."""
    lengths = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(-np.minimum(lengths, _SHORT + 1), kind="stable")
    n_long = int((lengths > _SHORT).sum())
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    order = order[n_long:]
    at, length = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    reach = len(order) - np.searchsorted(length[::-1], np.arange(_SHORT), side="right")
    for k in range(_SHORT):
        n = int(reach[k])  # ranges with more than k bytes stand first
        if not n:
            break
        part = crc[:n]
        crc[:n] = _CRC[(part ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features(block: pa.RecordBatch, grams: int = GRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text, and text number and bucket of each feature."""
    offsets, data = raw_texts(block.column("text"))
    raw, bounds = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = _LETTER[raw]
    edge = np.ones(len(raw) + 1, dtype=bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[bounds] = True  # a word ends with its text
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    first = np.searchsorted(starts, bounds)
    words = np.diff(first)
    # Words of each text joined by one space, so that a run of words is a range of bytes.
    lengths = ends - starts + 1
    places = np.concatenate([[0], np.cumsum(lengths)])
    joined = np.full(int(places[-1]), 0x20, dtype=np.uint8)
    shift = np.repeat(starts - places[:-1], lengths)
    inner = np.ones(len(joined), dtype=bool)
    inner[places[1:] - 1] = False
    joined[inner] = _LOWER[raw[(np.arange(len(joined)) + shift)[inner]]]
    text = np.repeat(np.arange(len(words)), words)
    last = first[1:][text] if len(text) else text
    of, out = [], []
    for n in range(1, grams + 1):
        at = np.flatnonzero(np.arange(len(text)) + n <= last)
        of.append(text[at])
        out.append(crc32s(joined, places[at], places[at + n] - 1) % np.uint32(buckets))
    return words, np.concatenate(of), np.concatenate(out).astype(np.int64)


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                total += np.bincount(features(batch.slice(a, b - a), grams, buckets)[2], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    ship(texts.sparkSession)
    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, in doubles, rounded down."""
    n = len(source)
    all_source, all_target = float(source.sum() + n), float(target.sum() + n)
    ratio = [(t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of a row of counts: plane k holds bit k of every count, packed in 64-bit words."""
    n = max(1, int(values.max(initial=0)).bit_length())
    bits = (values[None, :] >> np.arange(n)[:, None] & 1).astype(np.uint8)
    packed = np.packbits(np.pad(bits, ((0, 0), (0, -len(values) % 64))), axis=1, bitorder="little")
    return packed.view("<u8")


def weights(text: np.ndarray, bucket: np.ndarray, n_texts: int, signed: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """Sum of the gains of each text's features: AND of count and gain planes, bits counted, powers of two summed."""
    out = np.zeros(n_texts, dtype=np.int64)
    width = (buckets + 63) // 64
    key, counts = np.unique(text * buckets + bucket, return_counts=True)
    text, bucket = np.divmod(key, buckets)
    cuts = np.searchsorted(text, np.arange(0, n_texts + _ROWS, _ROWS))
    for number, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        low = number * _ROWS
        rows, here, count = text[a:b] - low, bucket[a:b], counts[a:b]
        sums = np.zeros(min(_ROWS, n_texts - low), dtype=np.int64)
        for j in range(int(count.max(initial=0)).bit_length()):
            some = np.flatnonzero(count >> j & 1)
            plane = np.zeros((len(sums), width), dtype=np.uint64)
            # Only rows with a bit in this plane are read; each bit is set once, so adding it sets it.
            np.add.at(plane, (rows[some], here[some] >> 6), np.uint64(1) << (here[some] & 63).astype(np.uint64))
            used = np.unique(rows[some])
            plane = plane[used]
            for sign, gain in signed:
                for k in range(len(gain)):
                    sums[used] += (sign << (j + k)) * np.bitwise_count(plane & gain[k]).sum(axis=1, dtype=np.int64)
        out[low : low + len(sums)] = sums
    return out


def weighed(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    buckets = len(gain)
    signed = [(1, planes(np.maximum(gain, 0))), (-1, planes(np.maximum(-gain, 0)))]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                words, text, bucket = features(block, grams, buckets)
                numbers = [words.astype(np.int64), np.bincount(text, minlength=b - a), weights(text, bucket, b - a, signed, buckets)]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *map(pa.array, numbers)], names=["doc_id", "n_words", "n_features", "weight"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int) -> Column:
    """Thousandths of a Gumbel deviate made from the document id."""
    name = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, *, grams: int = GRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every document."""
    gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = cut_lineage(weighed(docs, gain, grams).withColumn("score", F.col("weight") + _noise(seed)))
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    able = scored.filter(fit)
    drawn = percent * able.count() // 100
    ranked = global_position(able, [F.desc("score"), F.asc("doc_id")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", "rank")

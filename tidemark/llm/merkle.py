"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut, byte for byte, into paragraphs.  Cuts may stand after each line break, after every word where the
hash of the ``GRAM`` words up to it is a multiple of ``WORDS``, and, inside words of over ``LONG`` bytes, as in scripts without
spaces, before code points where the hash of the ``WINDOW`` bytes before is a multiple of ``POINTS``.  Of such places
less than ``LEAST`` bytes behind the one before, as in runs of one word, none is taken; where none comes
for ``MOST`` bytes, as in passages that repeat, a cut is forced.  So paragraphs of all texts have sizes of one order, and
a half of a text has a like share of them.  A section
ends after a paragraph whose hash is a multiple of ``PARAGRAPHS``.  Cuts depend on
content alone, so an edit moves only the cuts beside it.  A section's hash covers its
paragraphs' hashes, the root covers the sections.

The fingerprint is the tree as text: root, colon, sections joined by ``.``, each the
section's hash followed by its paragraphs' hashes (8 digits each).  Equal roots are
equal texts.  ``likeness`` and ``differing`` walk two trees from the root and open only
branches that differ.

The next document in order of ids comes from a range cut by ids: buckets begin at
ids found by percentiles, the first document of each bucket also goes to the bucket
before it, and each task reads its buckets in order.  Texts are shuffled once.

Defined cases: null texts are empty and have no paragraphs; two empty texts are alike (1);
rows without an id come first, rows with the same id follow each other by text; a
single document is its own next; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import _BYTE_VALUES, Words, range_hashes, ship
from tidemark.session import parallelism

GRAM, WORDS = 3, 8
LEAST, MOST = 16, 96  # bytes
PARAGRAPHS = 8
LONG, WINDOW, POINTS = 64, 16, 32

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def trees(texts: list[bytes]) -> list[str]:
    """Fingerprints of texts."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    whole = b"".join(texts)
    if not whole:
        return [_tree([]) for _ in texts]
    data = np.frombuffer(whole, np.uint8)
    words = Words(offsets, data)
    cuts = _forced(_spread(offsets, np.concatenate([_word_cuts(words, len(data)), _inner_cuts(words), np.flatnonzero(data == 0x0A) + 1])), data)
    edges = np.searchsorted(cuts, offsets)
    places = cuts.tolist()
    digest = hashlib.blake2b
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        out.append(_tree([digest(whole[places[i] : places[i + 1]], digest_size=8).digest() for i in range(a, b)]))
    return out


def _word_cuts(words: Words, end: int) -> np.ndarray:
    """Beginnings of words behind a run of ``GRAM`` words of their text whose hash says so."""
    hashes = words.hashes()
    if len(hashes) <= GRAM:
        return np.zeros(0, np.int64)
    runs = np.zeros(len(hashes) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(runs) + i]
    runs ^= runs >> np.uint64(29)
    chosen = np.flatnonzero(runs * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40) & np.uint64(WORDS - 1) == 0) + GRAM - 1
    # The run and the next word lie in one text.
    text = np.searchsorted(words.first, chosen, side="right") - 1
    inside = (chosen - GRAM + 1 >= words.first[text]) & (chosen + 1 < words.first[1:][text])
    return np.append(words.starts, end)[chosen[inside] + 1]


def _spread(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``offsets`` and the places that stand ``LEAST`` bytes or more behind the place or offset before."""
    every = np.unique(np.concatenate([offsets, places]))
    far = np.diff(every, prepend=-LEAST) >= LEAST
    return every[far | np.isin(every, offsets)]


def _forced(cuts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``cuts`` with one more every ``MOST`` bytes in longer gaps, at beginnings of code points."""
    more = (np.diff(cuts) - 1) // MOST
    begins = np.cumsum(more) - more
    extra = np.repeat(cuts[:-1], more) + MOST * (np.arange(more.sum()) - np.repeat(begins, more) + 1)
    for _ in range(3):
        extra = extra - (data[extra] & 0xC0 == 0x80)
    return np.unique(np.concatenate([cuts, extra]))


def _inner_cuts(words: Words) -> np.ndarray:
    """Places inside long words where the bytes before say so."""
    lengths = words.ends - words.starts
    sizes = lengths[lengths > LONG]
    if not len(sizes):
        return np.zeros(0, np.int64)
    begins = np.cumsum(sizes) - sizes
    since = np.arange(sizes.sum()) - np.repeat(begins, sizes)
    places = np.repeat(words.starts[lengths > LONG], sizes) + since
    data = words.data[places]
    at = np.flatnonzero((since >= WINDOW) & (data & 0xC0 != 0x80))
    at = at[range_hashes(_BYTE_VALUES[data], at - WINDOW, at) % np.uint64(POINTS) == 0]
    return places[at]


def _tree(leaves: list[bytes]) -> str:
    sections, start = [], 0
    for i, leaf in enumerate(leaves):
        if leaf[0] % PARAGRAPHS == 0 or i == len(leaves) - 1:
            sections.append(leaves[start : i + 1])
            start = i + 1
    hashes = [hashlib.blake2b(b"".join(s), digest_size=16).digest() for s in sections]
    root = hashlib.blake2b(b"".join(hashes), digest_size=16).hexdigest()
    return f"{root}:{'.'.join(h[:4].hex() + ''.join([x[:4].hex() for x in s]) for h, s in zip(hashes, sections, strict=True))}"


def _sections(fingerprint: str) -> list[str]:
    body = fingerprint.partition(":")[2]
    return body.split(".") if body else []


def _paragraphs(section: str) -> list[str]:
    return [section[i : i + 8] for i in range(8, len(section), 8)]


def likeness(left: str, right: str) -> float:
    """Share of paragraphs in common, 0 to 1: equal roots decide at once, equal sections count whole, others are opened."""
    if left[:32] == right[:32]:
        return 1.0
    a, b = Counter(_sections(left)), Counter(_sections(right))
    total = sum((len(s) // 8 - 1) * n for side in (a, b) for s, n in side.items())
    both = a & b
    common = sum((len(s) // 8 - 1) * n for s, n in both.items())
    x, y = (Counter(p for s, n in (side - both).items() for p in _paragraphs(s) * n) for side in (a, b))
    common += (x & y).total()
    return 2 * common / total if total else 1.0


def differing(left: str, right: str) -> list[tuple[int, int]]:
    """(section, paragraph) numbers of ``left`` that ``right`` does not have: where the edits are."""
    if left[:32] == right[:32]:
        return []
    theirs = Counter(_sections(right))
    opened = Counter(p for s, n in (theirs - Counter(_sections(left))).items() for p in _paragraphs(s) * n)
    out = []
    for i, section in enumerate(_sections(left)):
        if theirs[section] > 0:
            theirs[section] -= 1
            continue
        for j, paragraph in enumerate(_paragraphs(section)):
            if opened[paragraph] > 0:
                opened[paragraph] -= 1
            else:
                out.append((i, j))
    return out


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likenesses to these and to the next document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tasks = parallelism(docs.sparkSession)
    shares = [i / (4 * tasks) for i in range(1, 4 * tasks)]
    # One number per bucket, however large the table.
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("cuts"), F.min("doc_id").alias("least"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("unnamed")).first()
    cuts = sorted({c for c in found.cuts or [] if c > found.least})
    first = None if found.unnamed else found.least
    place = _placer(cuts, first)
    dealt = rows.withColumn("place", F.explode(place(F.col("doc_id")))).select("place.bucket", "place.follows", "doc_id", "text")
    dealt = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket", "follows", F.asc_nulls_first("doc_id"), "text")
    return dealt.mapInArrow(_pair_up, RESULT)


def _placer(cuts: list[int], first: int | None):
    """Bucket of an id, and where a bucket's first document is needed as the follower of the bucket before."""
    bounds, count = np.array(cuts, dtype=np.int64), len(cuts)

    @F.pandas_udf("array<struct<bucket:int,follows:boolean>>")
    def place(ids: pd.Series) -> pd.Series:
        out = []
        there = ids.notna().to_numpy()
        values = ids.fillna(0).astype("int64").to_numpy()
        own = np.where(there, np.searchsorted(bounds, values, side="right"), 0)
        for known, value, bucket in zip(there.tolist(), values.tolist(), own.tolist(), strict=True):
            row = [{"bucket": bucket, "follows": False}]
            if known and bucket and cuts[bucket - 1] == value:
                row.append({"bucket": bucket - 1, "follows": True})
            if (known and value == first) or (not known and first is None):
                row.append({"bucket": count, "follows": True})
            out.append(row)
        return pd.Series(out)

    return place


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the one after it in its bucket; a bucket's last row is a follower only."""
    before = None  # bucket, follows, doc_id, text and fingerprint of the row before
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            block = batch.slice(at, 200)
            rows = list(zip(*(block.column(c).to_pylist() for c in ("bucket", "follows", "doc_id", "text")), strict=True))
            known = trees([text.encode() for _, _, _, text in rows])
            run = [(*row, tree) for row, tree in zip(rows, known, strict=True)]
            chain = run if before is None else [before, *run]
            before = chain[-1]
            # Followers beyond the first of a bucket repeat its id and pair with nobody.
            pairs = [(x, y) for x, y in zip(chain[:-1], chain[1:], strict=True) if x[0] == y[0] and not x[1]]
            edited = [_edited(x[3], y[3]).encode() for x, y in pairs]
            out = [
                (x[2], len(x[3]), hashlib.sha256(e).hexdigest(), x[4], tree, likeness(x[4], tree), likeness(x[4], y[4]))
                for (x, y), e, tree in zip(pairs, edited, trees(edited), strict=True)
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_FIELDS)


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]

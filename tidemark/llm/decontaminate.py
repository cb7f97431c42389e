"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan of each text.

Texts and items are normalised alike: A-Z in lower case, words are runs of
letters, digits and non-ASCII characters, one space between words.  Every window
of ``window`` consecutive item words (a shorter item is one window) is a pattern
with a space at either end, so matches begin and end at words.  The automaton
reports every occurrence, overlapping ones included, and places in the
normalised text lead back to words and characters of the original.

The item table is a stated test set.  Its patterns are cut in blocks of at most
``block_bytes`` of pattern text (an automaton takes 40 to 60 bytes for each byte) and ``block_windows``
patterns, and each block is one broadcast automaton.  The blocks are applied one after the other to
the same rows, without a shuffle; between two blocks the rows are written, so that a task holds one
automaton at a time and the driver one block.  A test set beyond one block costs one more pass over the texts
for each further block.

Defined cases: null and empty texts have no words; an item without words
matches nothing; repeated items and documents are kept as they come; other
columns pass through untouched, except those named like an output column,
which the output replaces.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship
from tidemark.session import cut_lineage

WINDOW = 10
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 1 << 20

# Bytes above 0x7F belong to non-ASCII characters, which are all part of words.
_WORD_BYTE = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(x if x in _WORD_BYTE else 0x20 for x in (b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)
_HITS = T.StructType([T.StructField("words", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))])


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def item_windows(text: str | None, window: int = WINDOW) -> set[bytes]:
    words = normal_words(text or "")
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def mark(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with word counts, hit words, matched items and the hit spans in the original text.

    ``spans`` are character places of maximal runs of hit words.
    """
    spark = docs.sparkSession
    ship(spark)
    nothing = F.struct(F.array().cast(T.ArrayType(T.IntegerType())).alias("words"), F.array().cast(T.ArrayType(T.StringType())).alias("items"))
    found, last = docs.withColumn("__hits", nothing), None
    for block in _pattern_blocks(items, window, block_windows, block_bytes):
        if last is not None:
            found = cut_lineage(found.withColumn("__hits", _scanner(last)(F.col("text"), F.col("__hits"))))
        last = spark.sparkContext.broadcast(block)
    found = found.withColumn("__result", _judge(last)(F.col("text"), F.col("__hits")))
    out = {field.name: F.col("__result")[field.name] for field in RESULT.fields}
    return found.withColumns(out).drop("__hits", "__result")


def _pattern_blocks(items: DataFrame, window: int, block_windows: int, block_bytes: int) -> Iterator[bytes]:
    """Pickled pattern tables within both limits, read item by item; a pattern may stand in several blocks with other items."""
    patterns: dict[bytes, set[str]] = {}
    size = 0
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null").distinct()
    for row in rows.toLocalIterator():
        for pattern in item_windows(row.text, window):
            if pattern not in patterns:
                if patterns and (len(patterns) >= block_windows or size + len(pattern) > block_bytes):
                    yield pickle.dumps({k: sorted(v) for k, v in patterns.items()})
                    patterns, size = {}, 0
                size += len(pattern)
            patterns.setdefault(pattern, set()).add(row.item_id if row.item_id is not None else "")
    if patterns:
        yield pickle.dumps({k: sorted(v) for k, v in patterns.items()})


_built: dict[str, ahocorasick.Automaton] = {}


def _automaton(raw: bytes) -> ahocorasick.Automaton:
    """The automaton of a block; a worker holds one at a time."""
    key = hashlib.md5(raw).hexdigest()
    if key not in _built:
        _built.clear()
        built = ahocorasick.Automaton()
        for pattern, ids in pickle.loads(raw).items():
            built.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, len(pattern) + 2, ids))
        built.make_automaton()
        _built[key] = built
    return _built[key]


def _scanner(block):
    """Adds the hits of one block of patterns."""

    @F.pandas_udf(_HITS)
    def scan(texts: pd.Series, hits: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_more_hits(_automaton(block.value), texts, hits), columns=["words", "items"])

    return scan


def _more_hits(automaton: ahocorasick.Automaton, texts: pd.Series, hits: pd.DataFrame) -> Iterator[tuple[np.ndarray, list[str]]]:
    for text, words, items in zip(texts, hits["words"], hits["items"], strict=True):
        new_words, new_items = _scan(automaton, text or "")
        yield np.union1d(np.asarray(words, dtype=np.int32), new_words) if len(new_words) else words, sorted({*items, *new_items})


def _scan(automaton: ahocorasick.Automaton, text: str) -> tuple[np.ndarray, set[str]]:
    """Numbers of the hit words and the items found."""
    raw = f" {b' '.join(normal_words(text)).decode('latin-1')} "
    found = list(automaton.iter(raw))
    if not found:
        return np.zeros(0, np.int32), set()
    spaces = np.flatnonzero(np.frombuffer(raw.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(spaces, [end for end, _ in found])
    counts = np.array([value[0] for _, value in found])
    change = np.zeros(len(spaces) + 1, dtype=np.int64)
    np.add.at(change, last - counts, 1)
    np.add.at(change, last, -1)
    return np.flatnonzero(np.cumsum(change) > 0).astype(np.int32), {i for _, value in found for i in value[2]}


def _judge(block):
    """Adds the hits of the last block and derives the result, so that one block needs one Python worker."""

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series, hits: pd.DataFrame) -> pd.DataFrame:
        found = zip(hits["words"], hits["items"], strict=True) if block is None else _more_hits(_automaton(block.value), texts, hits)
        rows = []
        for text, (words, items) in zip(texts, found, strict=True):
            text = text or ""
            digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
            spans = _char_spans(text, np.asarray(words)) if len(words) else []
            rows.append((len(normal_words(text)), len(words), len(items), digest, len(words) > 0, spans))
        return pd.DataFrame(rows, columns=RESULT.names)

    return judge


def _char_spans(text: str, words: np.ndarray) -> list[dict]:
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw.translate(_NORMAL), np.uint8)
    inside = np.concatenate([[False], data != 0x20, [False]])
    starts = np.flatnonzero(~inside[:-1] & inside[1:])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    characters = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    breaks = np.flatnonzero(np.diff(words) > 1)
    heads, tails = words[np.concatenate([[0], breaks + 1])], words[np.concatenate([breaks, [len(words) - 1]])]
    return [{"start": int(characters[starts[a]]), "end": int(characters[ends[b]])} for a, b in zip(heads, tails, strict=True)]

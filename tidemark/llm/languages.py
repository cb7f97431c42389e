"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``ORDER`` bytes.  In a context a
seen byte is coded with its frequency; an unseen one costs an escape (method C)
and is coded in the context one byte shorter, bytes seen in the longer one
excluded, down to a uniform code.  Statistics are frozen after learning, so the cost
of a byte depends on its context alone and is tabulated: one automaton over
the contexts of all languages gives, per byte, its exact code length in every
language.  Texts are cut in segments whose context is recovered from the ``ORDER`` bytes
before them, and all segments of a batch advance together.

The score is the share of the best language when each language's probability of
the whole text is weighed equally.

Learning takes ``SAMPLE_ROWS`` labelled documents per language at most (lowest
hash of the id first) and keeps the ``MAX_CONTEXTS`` most frequent contexts; scoring
covers every whole text.

Defined cases: texts that are null or without a letter are ``und`` with score 0, and
so is everything when nothing could be learned; ties go to the first language by
name; rows without an id are never learned from; other columns pass
through, except those named like an output column, which the output replaces.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.session import cut_lineage

ORDER = 3
SAMPLE_ROWS = 400
MAX_CONTEXTS = 8192
SEGMENT = 512
BLOCK_BYTES = 4_000_000


def held_out(doc_id) -> F.Column:
    """Documents kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, order: int = ORDER, max_contexts: int = MAX_CONTEXTS) -> dict:
    """Frozen tables from labelled documents that are not held out."""
    ship(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return build(pd.DataFrame({"lang": [], "size": [], "context": [], "byte": [], "n": []}), order)
    # Ids below a share of the hash range that leaves more than enough, then the lowest of these.
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 2 * sample_rows / n + 1e-3)])
    unit = F.xxhash64("doc_id") / F.lit(float(1 << 64)) + 0.5
    few = labelled.select("doc_id", "lang", unit.alias("unit")).filter(F.col("unit") <= share[F.col("lang")]).distinct()
    by_hash = Window.partitionBy("lang").orderBy("unit", "doc_id")
    ids = few.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= sample_rows).select("doc_id", "lang")
    # At most sample_rows rows per language, so small by construction.
    chosen = labelled.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    chosen = chosen.dropDuplicates(["doc_id", "lang"]).select("lang", F.col("text").cast("binary").alias("text"))
    grams = chosen.mapInArrow(_gram_counter(order), "lang string, size int, gram long, n long")
    grams = cut_lineage(grams.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    # A context is a gram without its last byte; the most frequent ones make up the tree.
    size, context = (F.col("size") - 1).alias("size"), F.shiftrightunsigned("gram", 8).alias("context")
    contexts = grams.groupBy(size, context).agg(F.sum("n").alias("n"))
    kept = contexts.orderBy(F.desc("n"), "size", "context").limit(max_contexts).select("size", "context")
    counted = grams.select("lang", size, context, (F.col("gram") % 256).alias("byte"), "n")
    # As Arrow batches: a row object for each count would take the driver several times as much.
    rows = counted.join(F.broadcast(kept), ["size", "context"], "left_semi").toArrow()
    return build(rows.to_pandas(), order)


def _gram_counter(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = np.frombuffer(text, np.uint8).astype(np.int64)
                for size in range(1, order + 2):
                    gram = np.zeros(max(0, len(data) - size + 1), np.int64)
                    for k in range(size):
                        gram = gram << 8 | data[k : k + len(gram)]
                    found, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(found), pa.string()), "size": np.full(len(found), size, np.int32), "gram": found, "n": n})

    return run


def build(rows: pd.DataFrame, order: int) -> dict:
    """Automaton and code lengths from counts of (lang, size, context, byte)."""
    langs = sorted(rows["lang"].unique())
    seen = np.sort(rows["byte"].unique()).astype(np.int64)
    classes = np.full(256, len(seen), dtype=np.int64)  # bytes never seen share one class
    classes[seen] = np.arange(len(seen))
    width, unseen = len(seen) + 1, max(1, 256 - len(seen))
    names = {(int(s), int(c)) for s, c in zip(rows["size"], rows["context"], strict=True)} | {(0, 0)}
    # Shorter contexts first; a context stays only with its suffix, which is at least as frequent.
    place: dict[tuple[int, int], int] = {}
    for size, context in sorted(names):
        if size == 0 or _suffix(size, context) in place:
            place[size, context] = len(place)
    at = [place.get((int(s), int(c)), -1) for s, c in zip(rows["size"], rows["context"], strict=True)]
    at, lang = np.array(at, dtype=np.int64), np.searchsorted(langs, rows["lang"]) if len(rows) else np.zeros(0, np.int64)
    symbol, n = classes[rows["byte"].to_numpy(np.int64)], rows["n"].to_numpy(float)
    by_state = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[by_state], np.arange(len(place) + 1))
    uniform = np.tile(np.append(np.ones(len(seen)), unseen) / 256, (len(langs), 1))
    cost, move = np.zeros((len(place), width, len(langs)), np.float32), np.zeros((len(place), width), np.int32)
    # One context at a time, so that the table of all contexts is only held as code lengths; longer ones look up shorter ones.
    probability: dict[int, np.ndarray] = {}
    for (size, context), state in place.items():
        own = by_state[edges[state] : edges[state + 1]]
        counts = np.zeros((len(langs), width))
        np.add.at(counts, (lang[own], symbol[own]), n[own])
        share = _blend(counts, probability[place[_suffix(size, context)]] if size else uniform)
        if size < order:
            probability[state] = share.copy()
        share[:, -1] /= unseen
        cost[state] = -np.log2(np.maximum(share, 1e-30)).T
        for byte, number in zip(seen.tolist(), range(len(seen)), strict=True):
            longer = (size + 1, context << 8 | byte)
            while longer[0] > order or longer not in place:
                longer = _suffix(*longer)
            move[state, number] = place[longer] * width
    return {"langs": langs, "classes": classes.astype(np.int32), "width": width, "order": order, "cost": cost.reshape(len(place) * width, len(langs)), "move": move.ravel()}


def _suffix(size: int, context: int) -> tuple[int, int]:
    return size - 1, context & ((1 << 8 * (size - 1)) - 1)


def _blend(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities in one context for each language: seen bytes by count, the rest by escape and exclusion."""
    total, distinct = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    free = np.where(counts > 0, 0, shorter)
    rest = free.sum(axis=1, keepdims=True)
    escape = np.where(rest > 1e-12, distinct, 0)
    known = counts / np.maximum(total + escape, 1)
    return np.where(total > 0, known + escape / np.maximum(total + escape, 1) * free / np.maximum(rest, 1e-12), shorter)


def code_lengths(model: dict, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Bits of each text in each language; texts are data[offsets[i]:offsets[i + 1]]."""
    symbols, order = model["classes"][data], model["order"]
    sizes = np.diff(offsets)
    per_text = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), per_text)
    inside = (np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * SEGMENT
    length = np.minimum(sizes[text] - inside, SEGMENT)
    by_length = np.argsort(-length, kind="stable")
    text, inside, length = text[by_length], inside[by_length], length[by_length]
    begin = offsets[text] + inside
    state = np.zeros(len(text), np.int32)
    move, cost = model["move"], model["cost"]
    for back in range(order, 0, -1):  # the context before a segment
        has = inside >= back
        state[has] = move[state[has] + symbols[begin[has] - back]]
    bits = np.zeros((len(text), len(model["langs"])))
    active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
    for step in range(int(length[0]) if len(length) else 0):
        n = active[step]
        at = state[:n] + symbols[begin[:n] + step]
        bits[:n] += cost.take(at, axis=0)
        state[:n] = move.take(at)
    out = np.zeros((len(sizes), len(model["langs"])))
    np.add.at(out, text, bits)
    return out


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if not model["langs"]:
        return docs.select(*names, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    guess = _guesser(held)(F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary")))
    return docs.withColumn("__guess", guess).select(*names, F.col("__guess.lang").alias("lang_pred"), F.col("__guess.score").alias("score"))


_models: dict[str, dict] = {}


def _guesser(held):
    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        key = hashlib.md5(held.value).hexdigest()
        if key not in _models:
            _models.clear()
            _models[key] = pickle.loads(held.value)
        model = _models[key]
        langs, scores = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
        there = texts.notna().to_numpy()
        values = [bytes(x) for x in texts[there]]
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        block = np.cumsum(sizes) // BLOCK_BYTES
        for a, b in _blocks(block):
            offsets = np.concatenate([[0], np.cumsum(sizes[a:b])])
            bits = code_lengths(model, offsets, np.frombuffer(b"".join(values[a:b]), np.uint8))
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            places = np.flatnonzero(there)[a:b]
            langs[places], scores[places] = np.array(model["langs"], dtype=object)[best], share
        return pd.DataFrame({"lang": langs, "score": scores})

    return guess


def _blocks(block: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]]) if len(block) else np.zeros(1, int)
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)

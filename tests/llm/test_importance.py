import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import importance


def words_of(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [w for w in re.split(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def buckets_of(text, grams=1, buckets=10_000):
    words = words_of(text)
    return [zlib.crc32(b" ".join(words[i : i + n])) % buckets for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, grams=1, least=20, percent=10, seed=2024, buckets=10_000):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(buckets_of(x, grams))
    for x in target:
        t.update(buckets_of(x, grams))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
    out = []
    for d, x in docs:
        features = buckets_of(x, grams)
        weight, score = sum(map(gain, features)), None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(features), weight, score, None, d is not None and len(words_of(x)) >= least])
    able = sorted([r for r in out if r[5]], key=lambda r: (-r[3], r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted([tuple(r[:5]) for r in out], key=repr)


def found(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r["score"], r["rank"]) for r in df.collect()], key=repr)


def sample():
    rnd = random.Random(4)
    pool = ["Alpha", "beta", "GAMMA", "x1", "9", "é", "ÉÉ", "long" * 20, "don't", "w-w"] + [f"v{i}" for i in range(200)]
    docs = [(i, rnd.choice([" ", ", ", "\n", " "]).join(rnd.choice(pool) for _ in range(rnd.choice([0, 1, 19, 20, 21, 60, 300])))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " .,;"), (None, "word " * 30), (None, None), (203, "same " * 70_000), (204, "z" * 100_000), (7, "a b " * 12), (7, "c d " * 12)]
    target = [" ".join(rnd.choice(pool[:40]) for _ in range(50)) for _ in range(20)] + [None, "", "unseen words only"]
    return docs, target


@pytest.mark.parametrize(("grams", "percent"), [(1, 10), (2, 100)])
def test_equals_brute_force(spark, documents, grams, percent):
    docs, target = sample()
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    df = documents(docs).withColumn("weight", F.lit("w")).withColumn("rank", F.lit(0)).withColumn("__id", F.lit(0))
    got = found(importance.resample(df, items, grams=grams, percent=percent))
    assert got == plain(docs, target, grams, percent=percent)
    assert sum(r[4] is not None for r in got) >= 7


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id string, text string")
    docs = [(1, "a b c"), (2, "word " * 25)]
    assert found(importance.resample(documents(docs), items, percent=100)) == plain(docs, [], percent=100)
    assert importance.resample(documents([]), items).count() == 0


def test_planes_give_exact_sums():
    rnd = np.random.default_rng(2)
    gain = rnd.integers(-9000, 9000, 1000)
    text, bucket = np.sort(rnd.integers(0, 600, 50_000)), rnd.integers(0, 1000, 50_000)
    bucket[:9000] = 5
    signed = [(1, importance.planes(np.maximum(gain, 0))), (-1, importance.planes(np.maximum(-gain, 0)))]
    want = np.bincount(text, weights=gain[bucket], minlength=601).astype(np.int64)
    assert (importance.weights(text, bucket, 601, signed, 1000) == want).all()


def test_hashes_of_ranges():
    data = np.frombuffer("some words and é of many lengths ".encode() * 9, dtype=np.uint8)
    rnd = np.random.default_rng(3)
    starts = rnd.integers(0, len(data) - 60, 500)
    ends = starts + rnd.integers(0, 60, 500)
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert importance.crc32s(data, starts, ends).tolist() == want


def test_words_end_with_their_text():
    block = pa.RecordBatch.from_pydict({"text": pa.array([b"one two", b"three", None, b"four"], pa.binary())})
    words, text, _ = importance.features(block, 2)
    assert words.tolist() == [2, 1, 0, 1]
    assert text.tolist() == [0, 0, 1, 3, 0]

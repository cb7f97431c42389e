import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic


def plain_runs(words, least=24, periods=3):
    """Runs by comparing every word with the one q further on, for every period q."""
    out = []
    n = len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, periods * q):
                stretch = words[i : i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    said = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def sample(rnd):
    """Noise over a small or large vocabulary with periodic stretches in it, some inside others."""
    pool = [f"w{i}" for i in range(rnd.choice([2, 3, 5, 40, 1000]))]
    noise = lambda n: [rnd.choice(pool) for _ in range(n)]
    words = noise(rnd.randrange(0, 40))
    for _ in range(rnd.randrange(0, 4)):
        unit = noise(rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))
        if rnd.random() < 0.3:
            unit = unit[:2] * rnd.randrange(1, 15) + unit
        words += unit * rnd.randrange(2, 6) + unit[: rnd.randrange(len(unit))]
        words += noise(rnd.randrange(0, 30))
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [sample(rnd) for _ in range(120)]
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    row = np.array([ids[w] for t in texts for w in t], dtype=np.uint64)
    bounds = np.cumsum([0, *map(len, texts)])
    got = [[tuple(r) for r in runs.tolist()] for runs in periodic.runs_of(row, bounds)]
    want = [plain_runs(t) for t in texts]
    assert got == want
    assert sum(map(len, want)) > 60
    got = [[tuple(r) for r in runs.tolist()] for runs in periodic.runs_of(row, bounds, least=12, periods=4)]
    assert got == [plain_runs(t, 12, 4) for t in texts]


def test_splitting_ends_where_all_words_are_frequent():
    words = np.array([1, 2] * 15 + [9] + [1, 2, 3] * 10 + [4] + [5] * 30 + [3] * 5)
    parts = periodic.split(words, np.array([[0], [len(words)]]))
    assert sorted(map(tuple, parts.T.tolist())) == [(0, 30), (31, 61), (62, 97)]
    # Words that are frequent in the whole but not in a part of it.
    words = np.array([7, 8, *range(100, 130), 7, 8, *range(200, 230), 7, 8])
    assert periodic.split(words, np.array([[0], [len(words)]])).shape == (2, 0)


def test_query_equals_brute_force(documents):
    rnd = random.Random(9)
    rows = [(i, "  ".join(sample(rnd))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n\x0b"), (None, "a " * 30), (None, None), (5, "x y " * 20), (5, "x y " * 20), (103, "é " * 25), (104, "A a " * 13), (-3, "q " * 24), (105, "q " * 23)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) >= 5
    df = documents(rows).withColumn("runs", F.lit(1)).withColumn("kept", F.lit("k"))
    got = [tuple(r) for r in periodic.digests(periodic.find_runs(df, planted=True)).collect()]
    assert sorted(got, key=repr) == sorted([plain(d, t) for d, t in rows], key=repr)
    assert periodic.digests(periodic.find_runs(documents([]))).count() == 0


def test_long_texts_take_time_in_proportion():
    rnd = np.random.default_rng(1)
    unit = rnd.integers(0, 50, 70_001)
    texts = [np.zeros(400_000), np.tile([1, 2, 3, 1, 2, 3, 3], 60_000), np.tile(unit, 4), rnd.integers(0, 30, 400_000), np.tile([0] * 5000 + [1], 60)]
    with pytest.raises(ValueError, match="three"):
        periodic.find_runs(None, periods=2)
    for text in texts:
        started = time.perf_counter()
        runs = periodic.runs_of(text.astype(np.uint64), np.array([0, len(text)]))[0]
        assert time.perf_counter() - started < 30
        for start, length, period in runs.tolist():
            assert (text[start : start + length - period] == text[start + period : start + length]).all()
    assert periodic.runs_of(np.tile(unit, 4).astype(np.uint64), np.array([0, 280_004]))[0].tolist() == [[0, 280_004, 70_001]]

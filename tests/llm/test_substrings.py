import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substrings
from tidemark.llm.common import Words


def plain(rows, window):
    """Brute force: owners of all windows, then word by word."""
    owner = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if d is not None:
                owner[key] = min(owner.get(key, d), d)
    out = []
    for d, words in split:
        gone = set()
        for s in range(len(words) - window + 1):
            if d is not None and owner[tuple(words[s : s + window])] < d:
                gone.update(range(s, s + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made_rows(seed, n=60, vocabulary=40):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [[rnd.choice(words) for _ in range(rnd.randint(8, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rnd.randint(0, 4)):
            if rnd.random() < 0.6:
                passage = list(rnd.choice(passages))
                if rnd.random() < 0.3:
                    passage[rnd.randrange(len(passage))] = "edit"
                cut = rnd.randint(0, 4)
                text += passage[cut:]
            else:
                text += [rnd.choice(words) for _ in range(rnd.randint(1, 30))]
        rows.append((i * 3 % n, " ".join(text)))
    return rows


def results(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed):
    rows = made_rows(seed)
    got = substrings.dedup(documents(rows, 5), window=12)
    assert results(got) == plain(rows, 12)
    assert any(r[2] for r in results(got))


def test_defined_cases(documents, spark):
    long = " ".join(f"a{i}" for i in range(70))
    rows = [(5, long), (2, long), (2, long), (None, long), (7, None), (8, ""), (9, " \t "), (1, "short text"), (3, f"x y {long}\n\tend"), (4, "z " * 300)]
    assert results(substrings.dedup(documents(rows))) == plain(rows, 50)
    assert substrings.dedup(documents([])).count() == 0
    extra = documents(rows).withColumnRenamed("source", "mark").withColumnRenamed("lang", "n_words")
    assert results(substrings.dedup(extra)) == plain(rows, 50)


def test_factors_and_spans(documents):
    first = " ".join(f"a{i}" for i in range(200))
    rows = [(1, first), (2, "new " + " ".join(f"a{i}" for i in range(20, 150)) + " tail words")]
    row = substrings.dedup(documents(rows)).filter("doc_id = 2").first()
    assert [(s.start, s.end) for s in row.removed] == [(1, 131)]
    assert row.factors and all(f.ref_doc == 1 and f.length >= 50 and f.ref_start - f.start == 19 for f in row.factors)


def test_words_follow_ascii_white_space():
    texts = ["a b\tc\x0bd", "", "   x", "no\x1cbreak \x85"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = Words(offsets, np.frombuffer(b"".join(raw), np.uint8))
    assert [words.joined(i).split(b" ") if r.split() else [] for i, r in enumerate(raw)] == [r.split() for r in raw]
    assert np.diff(words.first).tolist() == [len(r.split()) for r in raw]

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import languages

SYLLABLES = {"en": "the and ing ion th er on".split(), "fr": "le eau que é tion è ou".split(), "de": "der sch ung ß ein ü ch".split()}


def text_of(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def made(seed, n):
    rnd = random.Random(seed)
    return [(i, text_of(rnd, lang := rnd.choice(list(SYLLABLES)), rnd.randint(8, 60)), lang) for i in range(n)]


class PlainTree:
    """Prediction by partial matching one byte at a time: method C with exclusion."""

    def __init__(self, texts, kept, seen, order):
        self.counts, self.order, self.kept, self.seen = defaultdict(Counter), order, kept, seen
        for t in texts:
            for i in range(len(t)):
                for k in range(min(order, i) + 1):
                    self.counts[t[i - k : i]][t[i]] += 1

    def table(self, context):
        if len(context):
            shorter = self.table(context[1:])
        else:
            shorter = {b: 1 / 256 for b in range(256)}
        counts = self.counts.get(context) if context in self.kept else None
        if not counts:
            return shorter
        free = {b: p for b, p in shorter.items() if b not in counts}
        rest = sum(free.values())
        total, escape = sum(counts.values()), len(counts) if rest > 1e-12 else 0
        return {b: counts[b] / (total + escape) if b in counts else escape / (total + escape) * free[b] / rest for b in range(256)}

    def bits(self, text):
        total = 0.0
        for i in range(len(text)):
            context = b""
            for k in range(min(self.order, i), -1, -1):
                if text[i - k : i] in self.kept:
                    context = text[i - k : i]
                    break
            total -= math.log2(self.table(context)[text[i]])
        return total


@pytest.mark.parametrize("max_contexts", [60, 5000])
def test_code_lengths_equal_a_plain_tree(documents, max_contexts):
    rows = made(1, 30)
    model = languages.learn(documents(rows), max_contexts=max_contexts)
    learned = [(t.encode(), lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    contexts = Counter()
    for t, _ in learned:
        for i in range(len(t)):
            for k in range(min(languages.ORDER, i) + 1):
                contexts[t[i - k : i]] += 1
    ranked = sorted(contexts, key=lambda c: (-contexts[c], len(c), int.from_bytes(c, "big")))[:max_contexts]
    kept = {c for c in ranked}
    kept = {c for c in kept if all(c[k:] in kept or k == len(c) for k in range(len(c) + 1))} | {b""}
    texts = [b"the \xc3\xa9tion qqq", b"", b"x", (made(2, 1)[0][1] * 30).encode()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = languages.code_lengths(model, offsets, np.frombuffer(b"".join(texts), np.uint8))
    for j, lang in enumerate(model["langs"]):
        tree = PlainTree([t for t, own in learned if own == lang], kept, None, languages.ORDER)
        for i, t in enumerate(texts):
            assert got[i, j] == pytest.approx(tree.bits(t), rel=1e-4, abs=1e-3)


def test_probabilities_sum_to_one(documents):
    model = languages.learn(documents(made(4, 40)), max_contexts=300)
    width = model["width"]
    share = np.exp2(-model["cost"].astype(float)).reshape(-1, width, len(model["langs"]))
    share[:, -1] *= 256 - (width - 1)
    assert np.allclose(share.sum(axis=1), 1, atol=1e-4)


def test_building_a_model_takes_little_more_than_the_model():
    contexts = [(0, 0), *[(1, a) for a in range(40)], *[(2, a << 8 | b) for a in range(20) for b in range(20)], *[(3, a << 16 | b << 8 | c) for a in range(12) for b in range(12) for c in range(12)]]
    rows = pd.DataFrame([(f"l{k % 30:02}", *context, (7 * k) % 40, 1 + k % 5) for k, context in enumerate(contexts * 4)], columns=["lang", "size", "context", "byte", "n"])
    tracemalloc.start()
    model = languages.build(rows, languages.ORDER)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model["cost"]) == len(contexts) * model["width"]
    assert peak < 3 * (model["cost"].nbytes + model["move"].nbytes)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    guessed = languages.identify(docs, languages.learn(docs)).filter(languages.held_out(languages.F.col("doc_id"))).collect()
    right = sum(r.lang == r.lang_pred for r in guessed)
    assert guessed and right >= 0.97 * len(guessed)
    assert all(0 <= r.score <= 1 for r in guessed)


def test_predictions_use_text_alone_and_held_out_rows_are_never_learned(documents):
    rows = made(7, 60)
    out = lambda data: {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(documents(data), languages.learn(documents(data))).collect()}
    swapped = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert out(rows) == out(swapped)


def test_defined_cases(documents):
    rows = made(9, 40)
    model = languages.learn(documents([*rows, (None, "the", "en"), (500, None, "en"), (501, "the", None)]))
    odd = [(1, None), (2, ""), (3, "123 ... !!"), (4, "é"), (5, "the " * 50_000), (5, "the " * 50_000), (None, "und the")]
    frame = documents(odd).withColumnRenamed("source", "score")
    got = sorted([(r.doc_id, r.lang_pred) for r in languages.identify(frame, model).collect()], key=repr)
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert len(got) == len(odd) and all(x[1] != "und" for x in got if x[0] not in (1, 2, 3))
    nothing = languages.learn(documents([]))
    assert {(r.lang_pred, r.score) for r in languages.identify(documents(odd), nothing).collect()} == {("und", 0.0)}
    assert languages.identify(documents([]), model).count() == 0

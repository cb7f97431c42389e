import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path

PATH = tokenizer_path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x85\xa0'sStT<|>endoftextAÀà\u0301ΣΟς1"))), max_size=40), max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_encode_like_whole_texts(texts):
    table = packing._tables.setdefault(PATH, packing.WordTable(PATH))
    got = table.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in table.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|> X", "a\u0301 \u0301b", "don't DON'T 12 é\u2028x"])
def test_special_spellings(tokenizer, text):
    got = packing.WordTable(PATH).encode([text.encode()])[0]
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
@settings(max_examples=300, deadline=None)
def test_best_fit_and_bounds(sizes):
    sizes = np.array(sorted(sizes, reverse=True))
    bins, offsets, filled = packing.best_fit(sizes, 30)
    for b in range(len(filled)):
        inside = sorted(zip(offsets[bins == b], sizes[bins == b], strict=True))
        assert [o for o, _ in inside] == list(np.cumsum([0] + [s for _, s in inside])[:-1])
        assert sum(s for _, s in inside) == filled[b] <= 30
    least = packing.lower_bound(sizes, 30)
    assert -(-sizes.sum() // 30) <= least <= optimum(sizes.tolist(), 30) <= len(filled)


def optimum(sizes, capacity):
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_pieces_and_sequences(documents, tokenizer):
    rnd = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta's", "é", "42,", "zeta!!"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 40, 200])))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "long text " * 700), (None, "no id"), (3, "twice"), (3, "twice")]
    out = packing.pack(packing.pieces(documents(rows), PATH, sequence=128, with_ids=True), sequence=128, group_pieces=40).collect()
    want = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 128):
            part = ids[k : k + 128]
            want.append((doc, k // 128, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out], key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in sequences.values():
        inside.sort()
        assert [o for o, _ in inside] == list(np.cumsum([0] + [n for _, n in inside])[:-1])
        assert sum(n for _, n in inside) <= 128
    bound = packing.lower_bound(np.array([r.length for r in out]), 128)
    assert bound <= len(sequences) <= bound + 1


def test_gaps_are_exchanged(spark):
    """Sizes that leave gaps in small groups but not all together."""
    sizes = [60, 50, 40, 30, 20] * 80
    frame = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(frame.repartition(3), sequence=100, group_pieces=7).collect()
    assert len(out) == len(sizes)
    assert len({r.sequence_id for r in out}) <= sum(sizes) // 100 + 3
    assert packing.pack(frame.limit(0)).count() == 0

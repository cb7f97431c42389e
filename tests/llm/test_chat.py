import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat
from tidemark.llm.queries import tokenizer_path

HARD = st.text(alphabet=st.sampled_from(list("\\#</>turnh ### \n:ÄéA😀")), max_size=30)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "odd\n\\role ### "]), HARD), max_size=5))
@settings(max_examples=200, deadline=None)
def test_rendering_is_reversible(turns):
    text, spans = chat.render(turns)
    assert [(r, t) for r, t, _ in chat.parse(text)] == turns
    assert [s for _, _, s in chat.parse(text)] == spans
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for _, t in turns]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 6)), max_size=15), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=5))
def test_masks_equal_brute_force(tokens, turns):
    tokens = np.array(sorted((a, a + n) for a, n in tokens), dtype=np.int64).reshape(-1, 2)
    tokens[:, 1] = np.maximum.accumulate(tokens[:, 1]) if len(tokens) else tokens[:, 1]
    spans, at = [], 0
    for gap, n in turns:
        spans.append((at + gap, at + gap + n))
        at += gap + n + 1
    _, pieces = chat.masked(tokens, np.array(spans).reshape(-1, 2))
    covered = {i for a, b in tokens for i in range(a, b)}
    assert [i for a, b in pieces for i in range(a, b)] == [i for a, b in spans for i in range(a, b) if i in covered]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations(spark):
    says = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", "  leading\n\n"), (1, 1, "assistant", "<!!"), (1, 2, "assistant", "\n\n x 😀é"), (2, 0, "assistant", None), (3, 0, None, says),
        (3, 0, None, says), (3, None, "system", "first"), (-7, 0, "user", says), (-7, 1, "assistant", says), (None, 1, "assistant", "no id"),
        (9, 0, "assistant", "long " * 20_000),
    ]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema).withColumn("formatted", chat.F.lit(1)).repartition(3)
    out = chat.format_conversations(frame, tokenizer_path(chat.TOKENIZER))
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    tokens = {r.conv_id: r for r in out.collect()}
    assert len(tokens[2].loss_tokens) == 0 and 0 < len(tokens[1].loss_tokens) < tokens[1].n_tokens
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], schema), tokenizer_path(chat.TOKENIZER))).count() == 0

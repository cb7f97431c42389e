"""Chat formatting: whole conversations rendered and encoded once, loss masks from character offsets.

A turn is rendered as ``### role``, a line break, the text, a line break and
``</turn>`` with a line break.  Inside roles and texts the escape character and
both control strings are escaped, so a rendered conversation can be read back
without doubt.

The rendered text is encoded once with character offsets.  The mask is the
intersection of the sorted spans of the texts to learn from with the token spans,
found by binary search: ``loss_tokens`` are the tokens that touch such a span,
``loss_spans`` the characters of those tokens inside it.  A token that also
covers characters beside a span therefore never lets them into the loss.

Defined cases: null texts and roles are empty; turns are ordered by (turn, role,
text), nulls first, and repeated rows are repeated turns; rows without a
conversation id form one conversation; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

HEAD, CLOSE = "### ", "</turn>"
LEARNED_ROLES = ("assistant",)
TOKENIZER = "byte_bpe_50k.json"

FORMATTED = "conv_id long, formatted string, n_tokens long, loss_tokens array<int>, loss_spans array<struct<start:int,end:int>>"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace(HEAD, "\\h").replace(CLOSE, "\\t")


_PLAIN = {"\\\\": "\\", "\\h": HEAD, "\\t": CLOSE, "\\n": "\n"}


def unescaped(text: str) -> str:
    return re.sub(r"\\[\\htn]", lambda m: _PLAIN[m[0]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as text and the place of each turn's escaped text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{HEAD}{escaped(role).replace(chr(10), '\\n')}\n"
        body = escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}\n{CLOSE}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str, tuple[int, int]]]:
    """Roles, texts and text places read back from a rendered conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        close = formatted.index(f"\n{CLOSE}\n", line)
        turns.append((unescaped(formatted[at + len(HEAD) : line]), unescaped(formatted[line + 1 : close]), (line + 1, close)))
        at = close + len(CLOSE) + 2
    return turns


def masked(token_spans: np.ndarray, turn_spans: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Tokens touching a turn span, and their characters inside it, adjoining pieces joined.

    Both lists are sorted; each turn span finds its first and last token by binary search.
    """
    tokens, pieces = [], []
    for start, end in turn_spans:
        low = int(np.searchsorted(token_spans[:, 1], start, side="right"))
        high = int(np.searchsorted(token_spans[:, 0], end, side="left"))
        inside = np.clip(token_spans[low:high], start, end)
        inside = inside[inside[:, 1] > inside[:, 0]]
        if len(inside):
            reach = np.maximum.accumulate(inside[:, 1])
            gaps = np.flatnonzero(inside[1:, 0] > reach[:-1])
            heads, tails = inside[np.concatenate([[0], gaps + 1]), 0], reach[np.concatenate([gaps, [len(inside) - 1]])]
            pieces += list(zip(heads.tolist(), tails.tolist(), strict=True))
        tokens.append(np.arange(low, max(low, high)))
    return np.concatenate(tokens) if tokens else np.zeros(0, np.int64), pieces


def format_conversations(rows: DataFrame, tokenizer_path: str, roles: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """One row per conversation: rendered text, number of tokens, loss tokens and loss spans."""
    ship(rows.sparkSession)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.select(F.col("conv_id").cast("long"), "turns.role", "turns.text")
    held = []

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(_tokenizer(tokenizer_path))
        for batch in batches:
            out = []
            for a in range(0, len(batch), 64):
                part = batch.iloc[a : a + 64]
                turns = [list(zip(r, t, strict=True)) for r, t in zip(part["role"], part["text"], strict=True)]
                rendered = [render(x) for x in turns]
                encodings = held[0].encode_batch([x[0] for x in rendered], add_special_tokens=False)
                for conv_id, who, (text, spans), encoding in zip(part["conv_id"], turns, rendered, encodings, strict=True):
                    offsets = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2)
                    learned = [span for (role, _), span in zip(who, spans, strict=True) if role in roles]
                    tokens, pieces = masked(offsets, learned)
                    out.append((conv_id, text, len(offsets), tokens.astype(np.int32), [{"start": a, "end": b} for a, b in pieces]))
            frame = pd.DataFrame(out, columns=["conv_id", "formatted", "n_tokens", "loss_tokens", "loss_spans"])
            yield frame.astype({"conv_id": "Int64"})

    return whole.mapInPandas(encode, FORMATTED)


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


def digests(formatted: DataFrame) -> DataFrame:
    """Checks read back from the output alone: turns, text under the loss mask, length."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss_spans"], strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body, _ in turns)
                pieces = [(s["start"], s["end"]) for s in spans]
                loss = "".join(
                    unescaped("".join(text[max(a, x) : min(b, y)] for a, b in pieces if a < y and b > x)) for _, _, (x, y) in turns
                )
                out.append((conv_id, len(turns), _sha(said), len(loss), _sha(loss), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    ship(formatted.sparkSession)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(read, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

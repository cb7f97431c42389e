"""Best-fit packing with certified bin counts.

Texts are tokenised, ended by one separator, and cut in pieces only where they
are longer than a sequence.  Pieces are dealt at random to groups of about
``GROUP_PIECES``; each group is packed by best-fit decreasing and its number of
bins compared with the largest lower bound that dual feasible functions give: a
group that meets its bound is certified.  The same bound over the lengths of all pieces
certifies the whole.  While the groups together still have a gap to it, they keep
their full bins and exchange the pieces of all others, which are dealt to fewer
groups, of up to twice as many pieces, and packed again, until the gap is closed, one
group is left or ``ROUNDS`` rounds are done.  Groups stay of bounded size in every round.

The tokenizer always cuts at white space and between an ASCII letter and an ASCII sign, so the
tokens of a word between such places do not depend on its neighbours: each worker encodes
a word once and keeps its tokens in a bounded table.

Defined cases: null and empty texts are one separator; repeated rows are packed
each for itself; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, raw_texts, ship, text_blocks
from tidemark.session import cut_lineage

TOKENIZER = "word_bpe_49k.json"
SEQUENCE = 2048
SEPARATOR = 0
GROUP_PIECES = 20_000
ROUNDS = 5
KNOWN_WORDS = 1_500_000

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
_BITS_GROUP, _BITS_BIN = 32, 24


# Classes between which the tokenizer always cuts: ASCII letters, and ASCII signs other than the apostrophe.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x61, 0x7B)]] = 1
_KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class WordTable:
    """Token ids of words by 64-bit word hash, encoded on first sight, at most ``KNOWN_WORDS`` kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of each text as little-endian 32-bit bytes."""
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        kind = _KIND[data]
        cuts = np.zeros(len(data), dtype=bool)
        cuts[1:] = (kind[1:] + kind[:-1] == 3) & (kind[1:] != 0) & (kind[:-1] != 0)
        words = Words(offsets, data, cuts)
        codes, distinct = pd.factorize(words.hashes())
        place = self._places(distinct, codes, words)
        n = self.n[place][codes]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.at[place][codes] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[words.first]
        out = [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i, text in enumerate(texts):
            if b"<|" in text:  # special tokens are recognised in their exact spelling only
                out[i] = np.array(self._whole([text.decode("utf-8", "replace")])[0], "<u4").tobytes()
        return out

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _places(self, distinct: np.ndarray, codes: np.ndarray, words: Words) -> np.ndarray:
        """Where the table has each distinct hash; unknown words are encoded and added."""
        found = np.searchsorted(self.keys, distinct)
        known = found < len(self.keys)
        known[known] = self.keys[found[known]] == distinct[known]
        if known.all():
            return found
        if len(self.keys) > KNOWN_WORDS:
            self._forget()
            known[:] = False
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        first = first[~known]
        raw = words.data.tobytes()
        new = [raw[a:b].decode("utf-8", "replace") for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
        counts, ids = self._encode_new(new)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        order = np.argsort(distinct[~known])
        keys = distinct[~known][order]
        slots = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = (np.insert(x, slots, y) for x, y in ((self.keys, keys), (self.at, at[order]), (self.n, counts[order])))
        return np.searchsorted(self.keys, distinct)

    def _encode_new(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens and all token ids of words, in order.

        A word of letters ends with the only token marked as a word's end, so such words are encoded in
        long runs and told apart by those tokens; all others are encoded one by one.
        """
        counts, parts = np.zeros(len(new), np.int64), [None] * len(new)
        plain = [i for i, word in enumerate(new) if word.isalpha()]
        for at in range(0, len(plain), 2000):
            run = plain[at : at + 2000]
            ids = np.array(self._whole([" ".join([new[i] for i in run])])[0], np.uint32)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) == len(run):
                for i, a, b in zip(run, [0, *stops.tolist()], stops.tolist(), strict=False):
                    parts[i] = ids[a:b]
        rest = [i for i, part in enumerate(parts) if part is None]
        for i, ids in zip(rest, self._whole([new[i] for i in rest]), strict=True):
            parts[i] = np.array(ids, np.uint32)
        counts[:] = np.fromiter(map(len, parts), np.int64, len(parts))
        return counts, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


_tables: dict[str, WordTable] = {}


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Tokenised texts cut in pieces of at most ``sequence`` tokens; ``with_ids`` adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _tables:
            _tables[tokenizer_path] = WordTable(tokenizer_path)
        table, end, width = _tables[tokenizer_path], np.array([SEPARATOR], "<u4").tobytes(), 4 * sequence
        for batch in batches:
            for first, last in text_blocks(batch, "text"):
                block = batch.slice(first, last - first)
                offsets, data = raw_texts(block.column("text"))
                encoded = table.encode([data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
                out = [(i, p, ids[p : p + width]) for i, ids in enumerate(x + end for x in encoded) for p in range(0, len(ids), width)]
                row = pa.array([i for i, _, _ in out], pa.int64())
                columns = {
                    "doc_id": block.column("doc_id").take(row),
                    "piece": pa.array([p // width for _, p, _ in out], pa.int32()),
                    "start": pa.array([p // 4 for _, p, _ in out], pa.int64()),
                    "length": pa.array([len(x) // 4 for _, _, x in out], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for _, _, x in out], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for _, _, x in out], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = PIECES.removeprefix("uid long, ") + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(run, schema)


def pack(cut: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with ``sequence_id``, ``offset`` and ``certified`` (whether the group that packed them met its bound)."""
    ship(cut.sparkSession)
    waiting = cut_lineage(cut.withColumn("uid", F.monotonically_increasing_id()))
    counts = np.zeros(sequence + 1, dtype=np.int64)
    for row in waiting.groupBy("length").count().collect():  # as many rows as there are lengths
        counts[row["length"]] = row["count"]
    n, bound = int(counts.sum()), bound_of(counts, sequence)
    done: list[DataFrame] = []
    for turn in range(rounds):
        groups = max(1, -(-n // (group_pieces << turn)))
        dealt = waiting.select("uid", "length").withColumn("group", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)))
        placed = dealt.groupBy("group").applyInPandas(_packer(turn, sequence), "uid long, sequence_id long, offset long, certified boolean, full boolean")
        placed = cut_lineage(waiting.join(placed, "uid"))
        if groups == 1 or turn == rounds - 1 or placed.filter("offset = 0").count() == bound:
            done.append(placed)
            break
        done.append(placed.filter("full"))
        bound -= placed.filter("full and offset = 0").count()
        waiting = placed.filter("not full").select(*waiting.columns)
        n = waiting.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("uid", "full")


def _packer(turn: int, sequence: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        sizes = rows["length"].to_numpy()
        bins, offsets, filled = best_fit(sizes, sequence)
        certified = len(filled) == lower_bound(sizes, sequence)
        number = (turn << (_BITS_GROUP + _BITS_BIN)) | (int(key[0]) << _BITS_BIN)
        return pd.DataFrame(
            {"uid": rows["uid"], "sequence_id": number + bins, "offset": offsets, "certified": certified, "full": (filled == sequence)[bins]}
        )

    return run


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, taken in the given (descending) order, and how full each bin is.

    Open bins are kept by room left; a bit set of the rooms in use gives the tightest fit.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, count = 0, 0
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    left: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                used ^= 1 << room
        else:
            room, chosen, count = capacity, count, count + 1
            left.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        left[chosen] = room - size
        if room > size:
            if not rooms[room - size]:
                used |= 1 << (room - size)
            rooms[room - size].append(chosen)
    return bins, offsets, capacity - np.array(left, dtype=np.int64)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    The first counts sizes above capacity - t as whole bins, drops those below t and
    keeps the rest, for every t up to half the capacity.  The second rounds sizes
    down to multiples of capacity / (k + 1), scaled to k.
    """
    return bound_of(np.bincount(sizes, minlength=capacity + 1), capacity)


def bound_of(counts: np.ndarray, capacity: int) -> int:
    """The same from the number of pieces of each size."""
    x = np.arange(capacity + 1)
    rows_up_to, sum_up_to = np.cumsum(counts), np.cumsum(counts * x)
    t = np.arange(0, capacity // 2 + 1)
    below = np.where(t > 0, sum_up_to[np.maximum(t - 1, 0)], 0)
    whole = rows_up_to[-1] - rows_up_to[capacity - t]
    best = int((whole + -(-(sum_up_to[capacity - t] - below) // capacity)).max())
    for k in range(1, 33):
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)  # in units of capacity * k
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best

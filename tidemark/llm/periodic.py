"""Maximal periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, 3 * q)`` long, that no
neighbouring word extends with the same period.

* Splitting: a run has three whole periods, so each of its words stands in it three times or more.  A
  word with fewer occurrences in the current segment belongs to no run there and splits it;
  parts shorter than a run go.  This recurs inside the parts, all of them at once, until no part
  changes.
* Lag scan of what is left.  Periods below ``DIRECT`` compare all words with those q further on.  For periods from
  b to 2b - 1, b doubling from there, the matching words of a run are at least 2b, so they fill a block of b words
  that starts at a multiple of b; and a word is the start of such a block's copy for one block only, the
  one b to 2b - 1 words before it.  So one pass compares the hash of each word's next b words
  with that of this block, and each equality is one candidate (place, lag), extended in both directions by
  binary search over hashes of ranges.  The scan costs a few passes for each doubling of the period.

A candidate inside a known run of smaller period, and a stretch with a smaller period, are not runs of
their own.  Words are compared by 64-bit hashes.

Work is done document by document, without a shuffle; nothing meets but the words of one text.

Defined cases: null and empty texts have no words and no runs; rows are judged one by one, so repeated ones and
ties change nothing; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, mixed, powers, raw_texts, ship, text_blocks

LEAST = 24
# A run has this many whole periods at least; periods below ``DIRECT`` are scanned one by one.
PERIODS = 3
DIRECT = LEAST // PERIODS

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _Ranges:
    """Hashes of ranges of a sequence; equal ranges hash alike."""

    def __init__(self, values: np.ndarray):
        self.back = powers(_BASE_INVERSE, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mixed(values) * powers(_BASE, len(values)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def split(words: np.ndarray, segments: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """Starts and ends (two rows) of the parts in which every word stands ``periods`` times at least.

    ``words`` are small whole numbers.  Each round looks at the parts that the round before made only.
    """
    done = [np.zeros((2, 0), dtype=np.int64)]
    n_words = int(words.max(initial=0)) + 1
    starts, ends = segments
    while True:
        keep = ends - starts >= least
        starts, ends = starts[keep], ends[keep]
        if not len(starts):
            return np.concatenate(done, axis=1)
        lengths = ends - starts
        part = np.repeat(np.arange(len(starts)), lengths)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(part)) - np.repeat(first - starts, lengths)
        _, at, counts = np.unique(part * n_words + words[place], return_inverse=True, return_counts=True)
        frequent = counts[at] >= periods
        whole = np.logical_and.reduceat(frequent, first)
        done.append(np.stack([starts[whole], ends[whole]]))
        some = frequent & ~whole[part]
        before, after = some.copy(), some.copy()
        before[1:] &= ~(some[:-1] & (part[1:] == part[:-1]))
        after[:-1] &= ~(some[1:] & (part[1:] == part[:-1]))
        starts, ends = place[before], place[after] + 1


def _extended(ranges: _Ranges, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the words from ``right`` on equal those from ``left`` on, and the words before them, inside [low, high)."""
    ahead, behind = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
    room_ahead, room_behind = high - right, left - low
    step = 1 << int(max(room_ahead.max(initial=0), room_behind.max(initial=0))).bit_length()
    while step:
        more = ahead + step
        fits = np.flatnonzero(more <= room_ahead)
        a, b = left[fits] + ahead[fits], right[fits] + ahead[fits]
        ahead[fits] += np.where(ranges.of(a, a + step) == ranges.of(b, b + step), step, 0)
        more = behind + step
        fits = np.flatnonzero(more <= room_behind)
        a, b = left[fits] - behind[fits], right[fits] - behind[fits]
        behind[fits] += np.where(ranges.of(a - step, a) == ranges.of(b - step, b), step, 0)
        step >>= 1
    return ahead, behind


def lag_scan(words: np.ndarray, parts: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """Runs inside the parts as rows (start, length, period), in order."""
    starts, ends = parts
    if not len(starts):
        return np.zeros((0, 3), dtype=np.int64)
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    # The parts one behind the other.
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    back = np.repeat(starts - first, lengths)
    row = words[np.arange(len(back)) + back].astype(np.uint64)
    part = np.repeat(np.arange(len(starts)), lengths)
    part_ends = first + lengths
    ranges = _Ranges(row)
    direct = max(1, least // periods)
    found = [np.zeros((0, 3), dtype=np.int64)]
    for q in range(1, direct):
        same = np.zeros(len(row) + 1, dtype=np.int8)
        if q < len(row):
            same[1 : len(row) - q + 1] = (row[q:] == row[:-q]) & (part[q:] == part[:-q])
        edges = np.flatnonzero(np.diff(np.append(same, 0)))
        begin, length = edges[::2], edges[1::2] - edges[::2] + q
        some = length >= max(least, periods * q)
        found.append(_smallest(np.stack([begin[some], length[some], np.full(int(some.sum()), q)], axis=1), ranges))
    block = direct
    longest = int(lengths.max())
    while periods * block <= longest:
        known = np.concatenate(found)
        at = np.arange(len(row) - block + 1)
        hashes = ranges.of(at, at + block)
        copy = at[block:]
        origin = (copy - block) // block * block
        some = (hashes[copy] == hashes[origin]) & (part[origin] == part[copy + block - 1])
        origin, copy = origin[some], copy[some]
        # Inside a run of smaller period a copy at another lag is none of its own.
        if len(known):
            by_start = np.argsort(known[:, 0], kind="stable")
            reach = np.maximum.accumulate((known[:, 0] + known[:, 1])[by_start])
            last = np.searchsorted(known[by_start, 0], origin, side="right") - 1
            free = (last < 0) | (reach[np.maximum(last, 0)] < copy + block)
            origin, copy = origin[free], copy[free]
        lag = copy - origin
        # Blocks one behind the other with one lag are of one stretch.
        by_lag = np.lexsort((origin, lag))
        origin, lag = origin[by_lag], lag[by_lag]
        new = np.ones(len(lag), dtype=bool)
        new[1:] = (lag[1:] != lag[:-1]) | (origin[1:] != origin[:-1] + block)
        origin, lag = origin[new], lag[new]
        ahead, behind = _extended(ranges, origin, origin + lag, first[part[origin]], part_ends[part[origin]])
        begin, length = origin - behind, behind + ahead + lag
        some = length >= np.maximum(least, periods * lag)
        found.append(_smallest(np.unique(np.stack([begin[some], length[some], lag[some]], axis=1), axis=0), ranges))
        block *= 2
    runs = np.concatenate(found)
    runs[:, 0] += back[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _smallest(runs: np.ndarray, ranges: _Ranges) -> np.ndarray:
    """Runs whose period no smaller one divides; a smaller period of a run this long must divide it."""
    whole = np.ones(len(runs), dtype=bool)
    begin, length, period = runs.T
    for i, q in enumerate(period.tolist()):
        for d in _prime_divisors(q):
            part = q // d
            a, n = begin[i : i + 1], length[i : i + 1]
            if ranges.of(a, a + n - part) == ranges.of(a + part, a + n):
                whole[i] = False
                break
    return runs[whole]


def _prime_divisors(n: int) -> list[int]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return [*out, n] if n > 1 else out


def runs_of(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> list[np.ndarray]:
    """For each text ``bounds[i]:bounds[i + 1]`` of a row of hashed words its runs (start, length, period), starts counted inside the text."""
    _, numbers = np.unique(words, return_inverse=True)
    parts = split(numbers, np.stack([bounds[:-1], bounds[1:]]), least, periods)
    runs = lag_scan(numbers, parts, least, periods)
    cuts = np.searchsorted(runs[:, 0], bounds)
    return [runs[a:b] - np.array([start, 0, 0]) for a, b, start in zip(cuts[:-1], cuts[1:], bounds[:-1], strict=True)]


def repeats(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a text into which a period is put, decided by its id; None for others."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:-1] == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"


def find_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS, planted: bool = False) -> DataFrame:
    """doc_id, n_words, runs, the text with each run cut to its first period (``kept``), one row per row.

    With ``planted`` a period is first put into the texts that ``repeats`` picks by id.
    """

    if periods < 3:
        raise ValueError("a run has three whole periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_blocks(batch, "text"):
                block = batch.slice(a, b - a)
                words = Words(*raw_texts(block.column("text")))
                hashes, bounds = words.hashes(), words.first
                moves = [repeats(d, int(n)) if planted else None for d, n in zip(block.column("doc_id").to_pylist(), np.diff(bounds), strict=True)]
                for i, move in enumerate(moves):
                    if move is not None:
                        hashes[bounds[i] : bounds[i + 1]] = hashes[bounds[i] : bounds[i + 1]][move]
                found = runs_of(hashes, bounds, least, periods)
                kept = []
                for i, (runs, move) in enumerate(zip(found, moves, strict=True)):
                    if move is None:
                        kept.append(words.joined(i, collapsed(int(bounds[i + 1] - bounds[i]), runs) if len(runs) else None))
                    else:
                        said = words.data[words.bounds[i] : words.bounds[i + 1]].tobytes().split()
                        stay = collapsed(len(said), runs)
                        kept.append(b" ".join([said[k] for k in move[stay].tolist()]))
                flat = np.concatenate(found)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN)),
                )
                columns = [block.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), lists, pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "kept"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the most repeated one and digests of all runs and of the collapsed text, per row of ``find_runs``."""
    # Runs are in order, so of equals the first one stays; lengths and periods are compared as exact fractions.
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    said = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    said = F.array_join(F.transform(said, lambda line: F.concat(line, F.lit("\n"))), "")
    shown = found.withColumn("best", best)
    return shown.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )

"""Helpers shared by the text operators: tables, raw word hashing and Arrow plumbing."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import tidemark
from tidemark.session import fresh_path

# Text handled at once inside a task; a longer single text is handled alone.
BLOCK_BYTES = 1_000_000

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this library importable in the Python workers of a session, once per application.

    The package goes as one zip file to the shared folder, from where each executor fetches it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, held = Path(tidemark.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(held, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.writestr(f"tidemark/{source.relative_to(root).as_posix()}", source.read_bytes())
    path = f"{fresh_path(spark, 'package')}/tidemark.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts together stay below ``limit`` bytes (one longer text forms its own range)."""
    offsets, _ = raw_texts(batch.column(column))
    start = 0
    for i in range(batch.num_rows):
        if i > start and offsets[i + 1] - offsets[start] > limit:
            yield start, i
            start = i
    if start < batch.num_rows:
        yield start, batch.num_rows


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary or string column without copying; null texts are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of values[s:e] for each range; equal sequences hash alike wherever they stand."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of a run of texts, cut at ASCII white space, with 64-bit hashes.

    ``starts`` and ``ends`` are byte places in ``data``; ``first[i]:first[i + 1]``
    are the words of text i.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, cuts: np.ndarray | None = None):
        """``cuts`` may mark bytes before which a word is cut as well."""
        low, high = int(offsets[0]), int(offsets[-1])
        self.data = data[low:high]
        self.bounds = offsets - low
        inside = ~_WHITE[self.data]
        apart = np.ones(len(inside) + 1, dtype=bool)
        apart[1:-1] = ~(inside[:-1] & inside[1:])
        if cuts is not None:
            apart[:-1] |= cuts
        begins, finishes = inside & apart[:-1], inside & apart[1:]
        inner = self.bounds[(self.bounds > 0) & (self.bounds < len(self.data))]
        begins[inner] = inside[inner]
        finishes[inner - 1] = inside[inner - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def hashes(self) -> np.ndarray:
        return range_hashes(_BYTE_VALUES[self.data], self.starts, self.ends)

    def joined(self, text: int, keep: np.ndarray | None = None) -> bytes:
        """The words of one text (those marked in ``keep``) joined by one space."""
        a, b = self.first[text], self.first[text + 1]
        raw = self.data[self.bounds[text] : self.bounds[text + 1]].tobytes()
        words = raw.split()
        if keep is not None:
            words = [w for w, k in zip(words, keep[: b - a].tolist(), strict=True) if k]
        return b" ".join(words)

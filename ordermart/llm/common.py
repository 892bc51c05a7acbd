"""Vectorized text helpers used inside tasks, and small DataFrame helpers.

Words follow one rule everywhere: A-Z are lower-cased, and a word is a longest run of
``a-z``, ``0-9`` and characters beyond ASCII. On UTF-8 bytes that is a table lookup.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text handled at once in a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

# Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from the folder the driver has it in.

    Where executors do not have that folder the library comes with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the given folder, in a session whose workers know this library."""
    reach_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_one_column(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct: in it their names meet no others, and ``row.*`` gives them back."""
    return F.struct(*[column(c) for c in df.columns]).alias(name)


def text_of(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """16-byte digest of the text; equal texts, and only those, share it."""
    return F.unhex(F.md5(text_of(column)))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizing scramble of 64-bit values (avalanche by multiply and shift)."""
    x = x + np.uint64(seed)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 … base ** (n - 1)`` modulo 2**64, kept for the next block."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if n <= 4 * BLOCK_BYTES:
            _POWERS[base] = held
    return held[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes of bytes or 64-bit values; see ``slice_hash``."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return sums


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ``data[start:end]`` for arrays of bounds, equal for equal slices."""
    top = int(start.max()) + 1 if len(start) else 1
    return mix((sums[end] - sums[start]) * powers(INVERSE, top)[start], seed)


@dataclass
class Block:
    """Some rows of a text column: ``data`` holds them back to back."""

    first: int
    data: np.ndarray
    bounds: np.ndarray  # row r is data[bounds[r]:bounds[r + 1]]

    def __len__(self) -> int:
        return len(self.bounds) - 1


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of whole rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield Block(row, raw[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


@dataclass
class Words:
    """Words of a block: byte bounds, row of each word, and the first word of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # words of row r are first[r]:first[r + 1]
    lowered: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        return slice_hash(prefix_sums(self.lowered), self.start, self.end, seed)


def words(block: Block) -> Words:
    lowered = LOWER[block.data]
    inside = IS_WORD[lowered]
    # A row border always ends a word.
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    border = block.bounds[1:-1]
    border = border[(border > 0) & (border < len(inside))]
    opens[border] = inside[border]
    closes[border - 1] = inside[border - 1]
    start = np.flatnonzero(opens)
    first = np.searchsorted(start, block.bounds)
    row = np.repeat(np.arange(len(block)), np.diff(first))
    return Words(start, np.flatnonzero(closes) + 1, row, first, lowered)


def runs_of_words(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``n`` consecutive words within a row, and the first one of each row.

    A row of fewer than ``n`` words, but not none, has one run of all its words.
    """
    count = np.diff(first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    total = int(bounds[-1])
    at = np.arange(total) - np.repeat(bounds[:-1], runs) + np.repeat(first[:-1], runs)
    end = np.repeat(first[1:], runs)
    value = np.zeros(total, dtype=np.uint64)
    factor = 1
    for j in range(n):
        there = at + j < end
        value[there] += hashes[at[there] + j] * np.uint64(factor)
        factor = factor * BASE % (1 << 64)
    return mix(value, n), bounds


def binary_rows(values: np.ndarray) -> pa.Array:
    """Fixed-width rows of a 2-d array as an Arrow binary column."""
    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize * values.shape[1]
    offsets = pa.py_buffer(np.arange(len(values) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(values), [None, offsets, pa.py_buffer(values)])


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the signed longs Spark stores."""
    return values.astype(np.uint64).view(np.int64)

"""Texts of an Arrow batch as flat byte arrays, so that numpy can work on many rows at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

# Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Texts(NamedTuple):
    """UTF-8 bytes of some rows, one after the other; row i is data[at[i]:at[i + 1]]."""

    data: np.ndarray
    at: np.ndarray
    first: int  # row number of row 0 within its batch


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[Texts]:
    """Rows of a string column (null: empty) in blocks of about ``size`` bytes, at least one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield Texts(data[at[row] : at[end]], at[row : end + 1] - at[row], row)
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly (the finaliser of a common public generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_VALUES = (_byte_values(1), _byte_values(2))
_BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words(NamedTuple):
    """start, end: byte offsets; row: row within the block; at: word i of row r is at[r] + i."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    at: np.ndarray


def words(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes with ``inside[byte]``, never across rows."""
    is_in = inside[texts.data]
    n = len(is_in)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(texts.at), np.int64))
    head = np.zeros(n + 1, bool)
    head[texts.at] = True
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1] | head[1:n]
    ends = is_in
    ends[:-1] &= ~is_in[1:] | head[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    at = np.searchsorted(start, texts.at)
    return Words(start, end, np.repeat(np.arange(len(texts.at) - 1), np.diff(at)), at)


def word_hashes(data: np.ndarray, found: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(found.start):
        return np.zeros(0, np.uint64)
    length = found.end - found.start
    n = int(length.sum())
    first = np.cumsum(length) - length
    offset = np.arange(n) - np.repeat(first, length)
    place = offset + np.repeat(found.start, length)
    values = _VALUES[which][data[place]]
    values *= powers(_BASES[which], int(length.max()))[offset]
    return mix(np.add.reduceat(values, first) + length.astype(np.uint64))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive entries, by where they start (len - n + 1 of them)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for i in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + count]
    return mix(out)


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

"""Vectorised access to the UTF-8 bytes of a text column, inside a task.

The operators never turn a text into Python strings where arrays will do: an Arrow string
column already is one byte buffer with offsets, and words, shingles and rolling hashes are
arithmetic on that buffer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, whose freed memory goes back to the system at a task's end.

    Python workers outlive their tasks; what they keep at hand would be missing elsewhere.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def give_back() -> None:
    """Return this process's freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(library := ctypes.CDLL(None), "malloc_trim"):
        library.malloc_trim(0)


def refuse_taken(docs: DataFrame, *names: str) -> None:
    """Raise where ``docs`` has a column, in whatever case, that an operator adds."""
    taken = sorted({name.lower() for name in docs.columns} & set(names))
    if taken:
        raise ValueError(f"rename the columns {taken}: the result has columns of these names")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), ends


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, bytes, offsets from 0."""
    data, ends = utf8(column)
    row = 0
    while row < len(ends) - 1:
        last = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), len(ends) - 1)
        yield row, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def parted(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts, in the column ``name``, have about ``SLICE_BYTES``."""
    for row, _, offsets in slices(batch.column(name)):
        yield batch.slice(row, len(offsets) - 1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, every other byte as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each text's first word."""
    blank = np.zeros(256, bool)
    blank[[32, 9, 10, 11, 12, 13]] = True
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the MurmurHash3 finaliser)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2**64, grown when needed."""

    def __init__(self, salt: int = 0) -> None:
        self._of = ((_MULTIPLIER + 2 * salt) % (1 << 64)) | 1
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", self._of), ("down", pow(self._of, -1, 1 << 64))):
                table = np.full(n + n // 4, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each range of ``values``: equal ranges have equal hashes."""
        self.grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64) * _U(0x9FB21C651E98DF25))


def byte_values() -> np.ndarray:
    """A fixed random-looking 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _U(_MULTIPLIER))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive values, without regard to text boundaries."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    total, done, factor = None, 0, _MULTIPLIER
    block, width = values, 1
    while True:
        if k & width:
            part = block[done : done + len(values) - k + 1]
            shift = _U(pow(_MULTIPLIER, width, 1 << 64))
            total = part.copy() if total is None else total * shift + part
            done += width
        if done == k:
            return mix(total)
        block = block[:-width] * _U(factor) + block[width:]
        factor = factor * factor % (1 << 64)
        width *= 2

"""Shared helpers of the text operators: Arrow text buffers as numpy arrays, words and their
64-bit hashes, hashed word windows, and bounded slices of Arrow batches.

A *word* is ``[^\\x20\\x09-\\x0D]+``. Everything here works on one bounded slice of rows inside a
task; Spark deals the rows. Word hashes are multilinear over bytes (random 64-bit weights per byte
value and position), then mixed; equal words always have equal hashes. From byte 65,536 on, the weights of
each further block of that many bytes are those of the first times a number of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_SPACE] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def place_weights(place: np.ndarray) -> np.ndarray:
    """The weight of each byte place in a hashed run of bytes."""
    low = _PLACE[place & 0xFFFF]
    if place.size and place.max() > 0xFFFF:
        far = np.flatnonzero(place > 0xFFFF)
        low[far] *= mix((place[far] >> 16).astype(np.uint64)) | np.uint64(1)
    return low


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES, rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches into runs of at most ``rows`` rows and about ``limit`` text bytes (one row at
    least), so that the arrays made from a run stay bounded however many rows a batch holds."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_buffers(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """Words of a run of rows. ``first[d]:first[d + 1]`` are the words of row ``d``."""
    data: np.ndarray
    off: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.n)), self.n)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.data.size
        at = np.zeros(size, np.int64)
        at[self.start] = self.start
        place = np.arange(size) - np.maximum.accumulate(at)
        total = np.add.reduceat(_BYTE[self.data] * place_weights(place), self.start)
        return mix(total + (self.end - self.start).astype(np.uint64) * _STEP[63])

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of ``k`` consecutive words of one row."""
        total = len(hashes)
        if total < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.first[1:], self.n)
        at = np.flatnonzero(np.arange(total) + k <= last)
        full = np.zeros(total - k + 1, np.uint64)
        for j in range(k):
            full += hashes[j: total - k + 1 + j] * _STEP[j]
        return at, mix(full[at])


def words(column: pa.Array) -> Words:
    data, off = text_buffers(column)
    if not data.size:
        none = np.zeros(0, np.int64)
        return Words(data, off, none, none, np.zeros(len(off), np.int64))
    inside = ~_SPACE[data]
    edge = np.zeros(data.size + 1, bool)
    edge[off] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(opens)
    return Words(data, off, start, np.flatnonzero(closes) + 1, np.searchsorted(start, off))


def give_back() -> None:
    """Hand memory that a finished task used back to the system. Python workers are reused, so what the
    arrays of one task leave in the allocators would stay with the executor through all later stages."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(work, *tables):
    """``work(*tables)``; what it used on the way is handed back before its result goes on."""
    out = work(*tables)
    give_back()
    return out


def privately(docs: DataFrame, used: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` over ``docs`` with every column but the ``used`` ones under a name that nothing else has; its result gives the
    columns of ``docs`` back under their own names. So extra columns may have any names."""
    inner = [c if c in used else f"__extra{i}" for i, c in enumerate(docs.columns)]
    return work(docs.toDF(*inner)).select(*inner).toDF(*docs.columns)


def free_name(taken: list[str], name: str) -> str:
    """A column name that no column of the input has (Spark names ignore case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name

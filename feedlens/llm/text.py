"""Vectorised text scanning inside Arrow tasks.

The helpers work on the UTF-8 bytes of a whole Arrow string column with
numpy, so a word or a byte n-gram costs a few array operations and no Python
object.  Null text counts as the empty text.  Words are the runs matched by
``[^\\x20\\x09-\\x0D]+`` and never span two rows.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled alone.  The
#: arrays of a chunk this small stay in the processor's cache.
CHUNK_BYTES = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(0x5EED))
_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_PLACE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SHINGLE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def release_memory() -> None:
    """Give memory that a finished task or batch no longer needs back to the
    system; Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it keeps its memory
        pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows holding about ``limit`` bytes of text."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
               offsets[start:stop + 1] - offsets[start])
        start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and per row the range of its words."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    begin = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[begin] = solid[begin]
    end = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[end] = solid[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _place_values(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.full(size, _PLACE, np.uint64), np.full(size, _PLACE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: differences of one running polynomial sum,
    shifted back to place zero by the inverse of the start's place value."""
    up, down = _place_values(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, ranges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a row, and each row's range.

    A row with one to ``k - 1`` words has its whole sequence as one shingle;
    a row without words has none.
    """
    counts = np.diff(ranges)
    per_row = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out = np.zeros(len(per_row) + 1, np.int64)
    np.cumsum(per_row, out=out[1:])
    position = np.arange(out[-1]) + np.repeat(ranges[:-1] - out[:-1], per_row)
    length = np.repeat(np.minimum(counts, k), per_row)
    total = length.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j in range(k):
        total = total + np.where(length > j, padded[position + j] * _SHINGLE[j], np.uint64(0))
    return _mix(total), out


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's range of ``values``; 0 for an empty range."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]

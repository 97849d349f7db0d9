"""Texts of an Arrow column as flat byte arrays: slicing, words, hashes, long integers as bytes.

All functions work on one block of texts inside a task.  A block is bounded by
its bytes (`text_blocks`), so the arrays here stay small whatever the batch is.
A text that is longer than the bound is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags; the inclusive ranges are set."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything but ASCII white space.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Digits, small letters and everything beyond ASCII.
WORD_CHARS = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_blocks(batch: pa.RecordBatch, column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most `max_bytes` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = array.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in `table` within each text: starts, ends, and first run of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_BASE = 0x5851F42D4C957F2D
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each of the ordered, disjoint spans of `data`."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + chunk, side="right")))
        high = ends[stop - 1]
        size = int(high - low)
        up, down = _powers(chunk if size <= chunk else 1 << size.bit_length())
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_CODES[data[low:high]] * up[:size], out=total[1:])
        s = starts[at:stop] - low
        out[at:stop] = mix((total[ends[at:stop] - low] - total[s]) * down[s] + (ends[at:stop] - starts[at:stop]).astype(np.uint64))
        at = stop
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in small letters, all else as it is."""
    return LOWER[data]


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The text that each run belongs to, from the first run of each text."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def crc_buckets(ids: pa.Array, modulus: int) -> np.ndarray:
    """crc32 of each id as text, modulo `modulus`; a null id counts as an empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulus for i in ids.to_pylist()], np.int64)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]; 0 where that is empty."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.result_type(values.dtype, np.float64 if values.dtype.kind == "f" else np.int64))
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]

"""MD5 of many short words at once."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view

BLOCK_WORDS = 8192  # words whose digests are computed side by side
FEW_WORDS = 256  # fewer words than this are taken one at a time
ONE_BLOCK = 55  # bytes of a word that leave room for its length in the one block that is hashed

_SHIFTS = [s for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
# By a word's size: which bytes of the 64 that follow its start are its own, and the mark that ends it.
_WORD = ((np.arange(64) < np.arange(ONE_BLOCK + 1)[:, None]) * np.uint8(0xFF)).view("<u8")
_END = ((np.arange(64) == np.arange(ONE_BLOCK + 1)[:, None]) * np.uint8(0x80)).view("<u8")


def md5_heads(words: pa.Array) -> np.ndarray:
    """The first four bytes of the MD5 digest of each word's UTF-8, as little-endian numbers."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
    data = np.concatenate([data, np.zeros(64, dtype=np.uint8)])
    sizes = np.diff(offsets)
    heads = np.empty(len(words), dtype=np.uint32)
    short = np.flatnonzero(sizes <= ONE_BLOCK) if len(words) >= FEW_WORDS else np.empty(0, dtype=np.int64)
    for at in range(0, len(short), BLOCK_WORDS):
        some = short[at : at + BLOCK_WORDS]
        heads[some] = _heads(data, offsets[some], sizes[some])
    single = np.ones(len(words), dtype=bool)
    single[short] = False
    for i in np.flatnonzero(single):
        word = data[offsets[i] : offsets[i + 1]].tobytes()
        heads[i] = int.from_bytes(hashlib.md5(word).digest()[:4], "little")
    return heads


def _heads(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = len(sizes)
    block = sliding_window_view(data, 64)[starts].view("<u8")
    block &= _WORD[sizes]
    block |= _END[sizes]
    parts = np.ascontiguousarray(block.view("<u4").T)
    parts[14] = sizes * 8
    used = parts.any(axis=1)
    a, b, c, d = (np.full(n, x, dtype=np.uint32) for x in _START)
    f, high = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for i in range(64):
        if i < 16:
            part = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            part = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            part = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            part = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, _SINES[i], out=f)
        if used[part]:
            np.add(f, parts[part], out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=high)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, high, out=f)
        np.add(f, b, out=a)  # what `a` held is no longer needed
        a, b, c, d = d, a, b, c
    return a + _START[0]

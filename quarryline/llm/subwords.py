"""Character n-grams of the words of a block of texts, as bucket numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import arrays

#: Signs that stand for letters.
_FOLDED = arrays.LOWER.copy()
for _sign, _letter in zip("013457@$", "oieastas"):
    _FOLDED[ord(_sign)] = ord(_letter)
_KEPT = arrays.byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF), (0x27, 0x27))


def spaced(column: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as words with one space before each and one at the end; (bytes, offsets).

    fold: read signs that stand for letters as those.
    """
    data, offsets = arrays.text_bytes(column)
    data = _FOLDED[data] if fold else arrays.lowered(data)
    body = np.full(len(data) + 2 * (len(offsets) - 1), 0x20, np.uint8)
    shift = 2 * np.arange(len(offsets) - 1) + 1
    place = np.arange(len(data)) + np.repeat(shift, np.diff(offsets))
    body[place] = np.where(_KEPT[data], data, 0x20)
    edges = offsets + 2 * np.arange(len(offsets))
    blank = body == 0x20
    keep = np.ones(len(body), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[edges[:-1][edges[:-1] < len(body)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return body[keep], kept[edges]


def ngrams(data: np.ndarray, offsets: np.ndarray, low: int, high: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: (bucket, first byte) of the n-grams of words; the spaces around a word belong to it.

    The n-grams are bytes, so one of n bytes may be fewer characters.
    """
    n_all = len(data)
    blank = np.concatenate([[0], np.cumsum(data == 0x20)])
    rows_end = np.zeros(n_all + 1, np.int64)
    rows_end[:n_all] = np.repeat(offsets[1:], np.diff(offsets))
    h = np.zeros(n_all, np.uint32)
    for n in range(1, high + 1):
        size = n_all - n + 1
        if size <= 0:
            return
        h = h[:size] * np.uint32(0x01000193) + (data[n - 1 :].astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        if n < low:
            continue
        at = np.arange(size)
        inner = blank[n - 1 : n - 1 + size] - blank[1 : 1 + size] if n > 1 else np.zeros(size, np.int64)
        fits = (inner == 0) & (at + n <= rows_end[:size])
        if n <= 2:
            fits &= data[:size] != 0x20
        at = at[fits]
        g = h[fits] ^ (h[fits] >> np.uint32(15))
        g = g * np.uint32(0x85EBCA6B) + np.uint32(n)
        yield (g ^ (g >> np.uint32(13))) >> np.uint32(32 - bits), at

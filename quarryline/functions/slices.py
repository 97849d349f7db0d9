"""Batches taken in slices, so that what a task holds beside its batch does not follow the batch's size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # bytes of text of a slice
SLICE_WORDS = 1 << 19  # words of a slice of word lists


def cuts(sizes: np.ndarray, most: int) -> list[int]:
    """Bounds of slices of rows with `most` in all, or of one row that has more."""
    total, at = np.cumsum(sizes), [0]
    while at[-1] < len(sizes):
        before = total[at[-1] - 1] if at[-1] else 0
        at.append(max(at[-1] + 1, int(np.searchsorted(total, before + most, side="right"))))
    return at


def in_slices(fn: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """`fn` of the columns, slice by slice; the first one, texts or lists of words, tells how much a row holds."""
    words = pa.types.is_list(columns[0].type)
    sizes = pc.list_value_length(columns[0]) if words else pc.binary_length(columns[0])
    at = cuts(np.asarray(sizes.fill_null(0), dtype=np.int64), SLICE_WORDS if words else SLICE_BYTES)
    if len(at) < 3:
        return fn(*columns)
    return pa.concat_arrays([fn(*(c.slice(a, b - a) for c in columns)) for a, b in zip(at, at[1:])])

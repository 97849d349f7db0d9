"""Whitening of embeddings: leading components of an integer lattice of vectors, and every row projected on them.

Each entry c becomes x = floor(256 * c).  The distinct x are the fit list, written once as packed bytes; sums,
centred covariance and the check of the result are three passes over it, each of which leaves one small row per
task and dimension.  The driver holds a square matrix of the vectors' length, never a number that grows with the
rows, and finds the leading components of it: Householder tridiagonalisation, bisection on Sturm counts, inverse
iteration with reorthogonalisation inside clusters.  The projection is broadcast (components times dimensions).

Rows whose vector is null, or holds a null or a number that is not finite, are left out.  Copies share the shuffle: a
task passes on each distinct vector once.  Repeated rows and null ids come back as they are.  Components without
variance (fewer distinct vectors than components, say) cannot be whitened and are left out, so one distinct vector or
an empty table gives no rows.  Vectors of different lengths are an error.  A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

SCALE = 256
COMPONENTS = 4
HEADER = 5  # bytes before a packed vector: width of an entry, then the length as 32 bits
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are one cluster
STEPS = 8  # of inverse iteration; two or three are usual
BATCH_CELLS = 1 << 20  # entries handled at one time


# --- vectors as integers --------------------------------------------------------------
def lattice(lists: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(rows that stay, [(places among them, their integer vectors)], one entry for each length that occurs)."""
    values = lists.flatten() if len(lists) else pa.array([], pa.float64())
    size = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    entries = np.asarray(pc.cast(values, pa.float64()).fill_null(np.nan), np.float64)
    ends = np.cumsum(size)
    bad = np.r_[0, np.cumsum(~np.isfinite(entries))]
    fine = np.asarray(lists.is_valid()) & (bad[ends] == bad[ends - size])
    stay = np.flatnonzero(fine)
    groups = []
    for n in np.unique(size[stay]):
        places = np.flatnonzero(size[stay] == n)
        at = (ends - size)[stay[places]][:, None] + np.arange(n)
        with np.errstate(over="ignore"):
            x = np.floor(entries[at] * SCALE)
        edge = float(1 << 63)
        whole = np.where(np.abs(x) < edge, x, 0).astype(np.int64)
        whole[x >= edge], whole[x <= -edge] = (1 << 63) - 1, -(1 << 63)
        groups.append((places, whole))
    return stay, groups


def pack(x: np.ndarray) -> Iterator[pa.Array]:
    """Vectors as bytes, equal exactly when the vectors are: each entry takes as few bytes as the vector allows."""
    if not x.shape[1]:
        yield pa.array([b"\x01" + bytes(4)] * len(x), pa.binary())
        return
    high = np.maximum(x.max(axis=1), ~x.min(axis=1))  # ~x is -x - 1, so that -128 fits in a byte
    width = np.select([high < 1 << 7, high < 1 << 15, high < 1 << 31], [1, 2, 4], 8)
    for w in np.unique(width):
        chosen = x[width == w].astype(f"<i{w}")
        out = np.empty((len(chosen), HEADER + x.shape[1] * w), np.uint8)
        out[:, 0] = w
        out[:, 1:HEADER] = np.frombuffer(np.array([x.shape[1]], "<u4").tobytes(), np.uint8)
        out[:, HEADER:] = np.ascontiguousarray(chosen).view(np.uint8).reshape(len(chosen), -1)
        offsets = np.arange(len(chosen) + 1, dtype=np.int32) * out.shape[1]
        yield pa.Array.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def unpack(packed: pa.Array) -> Iterator[np.ndarray]:
    """The integer vectors, those of one width and length at a time."""
    sizes = np.asarray(pc.binary_length(packed))
    for size in np.unique(sizes):
        chosen = packed.filter(pa.array(sizes == size)).to_pylist()
        rows = np.frombuffer(b"".join(chosen), np.uint8).reshape(len(chosen), size)
        heads = rows[:, :HEADER]
        for head in np.unique(heads, axis=0):
            body = np.ascontiguousarray(rows[(heads == head).all(axis=1), HEADER:])
            yield body.view(f"<i{head[0]}").astype(np.int64) if size > HEADER else np.zeros((len(body), 0), np.int64)


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """(x): every distinct integer vector once, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in lattice(batch.column(0))[1]:
                for packed in pack(x):
                    yield pa.RecordBatch.from_arrays([packed], names=["x"])

    return written(vectors.select(vector_col).mapInArrow(run, "x binary").distinct(), "fit-list")


def _sum_exactly(x: np.ndarray) -> np.ndarray:
    """Sums by dimension as Python integers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return x.sum(axis=0).astype(object) if most * len(x) < 1 << 62 else x.astype(object).sum(axis=0)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and their sums by dimension; vectors of different lengths are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for x in unpack(batch.column(0)):
                mine = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
                mine[0], mine[1] = mine[0] + len(x), mine[1] + _sum_exactly(x)
        for size, (n, sums) in held.items():
            values = [n, *(int(s) for s in sums)]
            at = np.arange(-1, size, dtype=np.int32)
            columns = [pa.array(np.full(len(at), size, np.int32)), pa.array(at), pa.array(values, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "at", "s"])

    rows = fit.mapInArrow(run, "size int, at int, s decimal(38,0)").groupBy("size", "at").agg(F.sum("s").alias("s")).collect()
    sizes = sorted({r["size"] for r in rows})
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes}")
    sums = {r["at"]: int(r["s"]) for r in rows}
    return sums.get(-1, 0), [sums[i] for i in range(len(sums) - 1)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return x - np.array([s / n for s in sums])


def _summed(fit: DataFrame, values_of) -> dict[int, np.ndarray]:
    """Sums over all vectors of the rows of values_of(x), a small matrix; added up in each task, then by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in unpack(batch.column(0)):
                step = max(1, BATCH_CELLS // max(1, x.shape[1]))
                for low in range(0, len(x), step):
                    part = values_of(x[low : low + step])
                    total = part if total is None else total + part
        if total is not None:
            at = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(list(total), pa.list_(pa.float64()))], names=["at", "v"])

    rows = fit.mapInArrow(run, "at int, v array<double>").groupBy("at")
    summed = rows.agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
    return {r["at"]: np.array(r["v"]) for r in summed.collect()}


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit list with divisor n, centred before multiplying."""

    def products(x: np.ndarray) -> np.ndarray:
        c = _centred(x, n, sums)
        return c.T @ c

    found = _summed(fit, products)
    return np.array([found[i] for i in range(len(sums))]) / n


# --- leading eigenvectors of a symmetric matrix ---------------------------------------------
def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, mirrors): Householder's reduction; mirror i acts on the entries after i."""
    a, mirrors = np.array(matrix, np.float64), []
    n = len(a)
    diagonal, off = np.zeros(n), np.zeros(max(0, n - 1))
    for i in range(n - 1):
        diagonal[i] = a[i, i]
        column = a[i + 1 :, i].copy()
        scale = np.abs(column).max()
        mirror = np.zeros(len(column))
        if not scale or not np.abs(column[1:]).any():
            off[i] = column[0]
            mirrors.append(mirror)
            continue
        length = scale * np.linalg.norm(column / scale)
        off[i] = -length if column[0] > 0 else length
        mirror = column / length
        mirror[0] -= off[i] / length
        mirror /= np.linalg.norm(mirror)
        rest = a[i + 1 :, i + 1 :]
        turned = rest @ mirror
        turned -= mirror * (mirror @ turned)
        rest -= 2 * (np.outer(mirror, turned) + np.outer(turned, mirror))
        mirrors.append(mirror)
    if n:
        diagonal[-1] = a[-1, -1]
    return diagonal, off, mirrors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each number in `at`, how many eigenvalues lie below it: negative terms of Sturm's sequence."""
    least = np.finfo(float).tiny * max(1.0, float((off**2).max(initial=0)))
    q, count = diagonal[0] - at, np.zeros(len(at), np.int64)
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - at - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each halved in until neighbouring numbers are left."""
    reach = np.r_[np.abs(off), 0] + np.r_[0, np.abs(off)]
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    high = high + np.finfo(float).eps * np.maximum(np.abs(low), np.abs(high)) + np.finfo(float).tiny
    index = len(diagonal) - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        above = counts_below(diagonal, off, middle) > index
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float):
    """A solver of (T - value) y = b: elimination with row exchanges, zero pivots nudged."""
    n = len(diagonal)
    small = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    main, upper, second = diagonal - value, np.r_[off, 0.0], np.zeros(n)
    factors, swaps = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        below = off[i]
        swaps[i] = abs(below) > abs(main[i])
        if swaps[i]:
            main[i], upper[i], second[i], main[i + 1], upper[i + 1], below = below, main[i + 1], upper[i + 1], upper[i], 0.0, main[i]
        if abs(main[i]) < small:
            main[i] = small
        factors[i] = below / main[i]
        main[i + 1] -= factors[i] * upper[i]
        upper[i + 1] -= factors[i] * second[i]
    if abs(main[-1]) < small:
        main[-1] = small

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i in range(n - 1):
            if swaps[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factors[i] * y[i]
        for i in reversed(range(n)):
            y[i] -= (upper[i] * y[i + 1] if i + 1 < n else 0.0) + (second[i] * y[i + 2] if i + 2 < n else 0.0)
            y[i] /= main[i]
        return y

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (one a row) for falling eigenvalues, by inverse iteration.

    A vector is made orthogonal, in every step, to those found before in its cluster, whose values lie too near to tell.
    """
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    found: list[np.ndarray] = []
    first = 0  # of the cluster
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        solve = _solver(diagonal, off, value)
        y = np.random.default_rng(j).uniform(-1, 1, len(diagonal))
        for _ in range(STEPS):
            y = solve(y / np.abs(y).max())
            for _ in range(2):  # twice is enough
                for other in found[first:]:
                    y = y - other * (other @ y)
            y /= np.linalg.norm(y)
        found.append(y)
    return np.array(found).reshape(len(values), len(diagonal))


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors, one a row."""
    k = min(k, len(matrix))
    size = np.abs(matrix).max(initial=0)
    if not size:
        return np.zeros(k), np.eye(k, len(matrix))
    diagonal, off, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, k)
    vectors = vectors_of(diagonal, off, values)
    for i in reversed(range(len(mirrors))):
        tail = vectors[:, i + 1 :]
        tail -= 2 * np.outer(tail @ mirrors[i], mirrors[i])
    return values * size, vectors


# --- the model and its projection ---------------------------------------------------------
@dataclass
class Whitening:
    n: int  # distinct vectors
    sums: list[int]
    values: np.ndarray  # eigenvalues with variance, falling
    vectors: np.ndarray  # their components, one a row
    trace: float
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(x - S / n) on each component, over the square root of its eigenvalue."""
        return (_centred(x, self.n, self.sums) @ self.vectors.T) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S) ** 2, exact; None where 64 bits do not hold it."""
        most = self.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, self.sums), default=0)
        if most * most * max(1, len(self.sums)) < 1 << 62:
            gap = self.n * x - np.array(self.sums, np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = self.n * x.astype(object) - np.array(self.sums, object)
        return [d if d < 1 << 63 else None for d in (gap * gap).sum(axis=1)]


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The leading components of all distinct vectors; None where no vector is left."""
    listed = fit_list(vectors, vector_col)
    n, sums = exact_sums(listed)
    if not n:
        return None
    v = covariance(listed, n, sums) if sums else np.zeros((0, 0))
    values, found = leading(v, components)
    trace = float(np.trace(v))
    real = values > len(v) * 2.0**-50 * trace
    model = Whitening(n, sums, values[real], found[real], trace, 0.0)
    if real.any():

        def products(x: np.ndarray) -> np.ndarray:
            w = np.column_stack([model.whitened(x), np.ones(len(x))])
            return w.T @ w

        got = _summed(listed, products)
        k = len(model.values)
        mean = got[k][:k] / n
        model.identity_error = float(np.abs(np.array([got[i][:k] for i in range(k)]) / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def project(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector that stays and each component, in the columns of the module's contract."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(id_col, vector_col)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    held = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        k = len(m.values)
        for batch in batches:
            stay, groups = lattice(batch.column(1))
            for places, x in groups:
                ids = batch.column(0).take(pa.array(np.repeat(stay[places], k)))
                rows = len(places) * k
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids,
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                    "n": pa.array(np.full(rows, m.n)),
                    "deviation": pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(places)), k))),
                    "whitened": pa.array(m.whitened(x).ravel()),
                    "explained": pa.array(np.tile(m.values / m.trace, len(places))),
                    "identity_error": pa.array(np.full(rows, m.identity_error)),
                })

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every vector that stays, whitened by the components of them all."""
    return project(vectors, fit(vectors, vector_col, components), id_col, vector_col)

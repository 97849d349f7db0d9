"""Components against a dense solver, and every returned number against plain sums."""

import math

import numpy as np
import pyarrow as pa
import pytest

from quarryline.llm import whitening
from quarryline.llm.queries import op11_whitening


def lattice_of(vectors):
    return [[math.floor(256 * float(c)) for c in v] for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def checked(rows, vectors, k=4):
    """Rows against numpy; rows: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    x = np.array(sorted({tuple(v) for v in lattice_of(vectors)}))
    n, sums = len(x), x.sum(axis=0)
    v = np.cov(x.T, bias=True)
    values, parts = np.linalg.eigh(v)
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = np.zeros(k)
    for i, got in by_id.items():
        y = np.array(lattice_of([vectors[i]])[0])
        assert sorted(got) == list(range(1, k + 1))
        assert got[1].n == n and got[1].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(y, sums))
        want = (y - sums / n) @ parts / np.sqrt(values)
        have = np.array([got[j].whitened for j in range(1, k + 1)])
        signs = np.where(signs == 0, np.where(np.abs(want) > 1e-6, np.sign(want * have), 0), signs)
        assert np.allclose(have, want * np.where(signs == 0, 1, signs), atol=1e-8)
        assert np.allclose([got[j].explained for j in range(1, k + 1)], values / np.trace(v), rtol=1e-9)
        assert 0 <= got[1].identity_error < 1e-9


def test_query_against_dense_solver(spark, folder):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    rows = op11_whitening(spark, folder).collect()
    assert len(rows) == 4 * len(vectors)
    checked(rows, [vectors[i] for i in range(len(vectors))])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    draw = np.random.default_rng(3)
    vectors = [list(map(float, v)) for v in draw.normal(size=(20, 3))]
    vectors += [vectors[0]] * 5 + [None, [1.0, None, 2.0], [nan, 0.0, 0.0], [0.0, -inf, 0.0], [-0.0, 0.0, 300.5], [vectors[1][0] + 1e-9, *vectors[1][1:]]]
    rows = [(i if i != 3 else None, v, i, "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component string")
    found = whitening.whiten(df.unionByName(df.where("vec_id = 7"))).collect()
    assert len(found) == 3 * (27 + 1)  # three dimensions, so three components
    assert {r.vec_id for r in found} == {i if i != 3 else None for i in [*range(25), 29, 30]}
    checked([r for r in found if r.vec_id is not None], vectors, 3)


def test_tables_without_components(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(line, schema)).collect()} == {1}
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))


def test_large_numbers(spark):
    rows = [(i, [1e30 * (i % 3), float(i), -1e300]) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in found} == {None} and all(math.isfinite(r.whitened) for r in found)


def test_packed_vectors_come_back():
    x = np.array([[0, -128, 127], [128, 0, 0], [-129, 1, 1], [1 << 40, 0, -(1 << 63)], [1 << 31, 0, 0], [-(1 << 31), 5, 5], [0, -128, 127]])
    packed = pa.chunked_array(list(whitening.pack(x))).combine_chunks()
    back = np.concatenate(list(whitening.unpack(packed)))
    assert sorted(map(tuple, back)) == sorted(map(tuple, x)) and len(set(packed.to_pylist())) == 6


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "split", "low rank", "small", "zero"])
def test_leading_vectors(kind):
    draw = np.random.default_rng(4)
    q = np.linalg.qr(draw.normal(size=(40, 40)))[0]
    values = np.sort(draw.uniform(1, 9, 40))[::-1]
    if kind == "clustered":
        values[:4] = 10 + 1e-9 * np.arange(4)[::-1]
    a = (q * values) @ q.T
    if kind == "equal":
        a = 3.0 * np.eye(40)
    if kind == "split":
        a = np.diag(values)
    if kind == "low rank":
        a = np.outer(q[0], q[0]) + 2 * np.outer(q[1], q[1])
    if kind == "small":
        a = 1e-200 * a
    if kind == "zero":
        a = 0 * a
    found, vectors = whitening.leading(a, 4)
    size = max(np.abs(a).max(), 1e-300)
    assert np.allclose(found / size, np.linalg.eigvalsh(a)[::-1][:4] / size, atol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-12)
    assert np.abs(a @ vectors.T - vectors.T * found).max() <= 1e-12 * size


def test_counts_below():
    draw = np.random.default_rng(6)
    diagonal, off = draw.normal(size=30), draw.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-4, 4, 50)
    assert (whitening.counts_below(diagonal, off, at) == [(values < t).sum() for t in at]).all()

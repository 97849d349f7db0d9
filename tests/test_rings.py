"""Search that skips rings against the search that scores every row."""

import numpy as np
import pytest

from conftest import rows
from quarryline.operators import rings, search
from quarryline.session import fresh_path

DRAW = np.random.default_rng(9)
CENTRES = DRAW.normal(size=(20, 6)) * 20
CORPUS = [(i, (CENTRES[i % 20] + DRAW.normal(size=6)).tolist()) for i in range(1200)]
CORPUS += [(2000 + i, CORPUS[5][1]) for i in range(600)] + [(5000, None)]  # a third are copies
ASKED = [(i, CORPUS[i * 7][1]) for i in range(12)] + [(50, [0.0] * 6), (51, CORPUS[5][1]), (52, None), (53, [500.0] * 6)]


@pytest.fixture(scope="module")
def tables(spark):
    corpus = spark.createDataFrame(CORPUS, "original_index bigint, vec array<double>").repartition(4)
    return spark.createDataFrame(ASKED, "q_id bigint, query_vec array<double>"), corpus


@pytest.fixture(scope="module")
def path(spark, tables):
    out = fresh_path(spark, "rings")
    rings.store(tables[1], out, cells=16)
    return out


@pytest.mark.parametrize("k", [1, 10, 700, 5000])
def test_same_as_the_full_search(tables, path, k):
    asked, corpus = tables
    names = ["q_id", "original_index", "distance", "rank"]
    assert rows(rings.search(asked, path, k), *names) == rows(search.nearest(asked, corpus, k), *names)


def test_queries_too_many_to_ship(tables, path):
    asked, corpus = tables
    got = rows(rings.search(asked, path, 5, ship_rows=3), "q_id", "original_index", "rank")
    assert got == rows(search.nearest(asked, corpus, 5), "q_id", "original_index", "rank")


def test_most_files_are_not_read(spark, tables, path, monkeypatch):
    asked = tables[0].where("q_id < 3")
    read = []
    plain = rings._read

    def watched(stored, row_id, held, wanted, *rest):
        read.append(set(held.place[wanted.any(axis=0)].tolist()))
        out = plain(stored, row_id, held, wanted, *rest)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [place#" in plan
        return out

    monkeypatch.setattr(rings, "_read", watched)
    assert rings.search(asked, path, 3).count() == 9
    stored = spark.read.parquet(f"{path}/rings")
    assert sum(map(len, read)) == len(set().union(*read)) < stored.count() / 3
    assert stored.agg({"n": "sum"}).first()[0] == 1800


def test_bounds_hold(spark, tables, path):
    held = rings._Rings(spark, path)
    queries = np.array([v for _, v in ASKED if v is not None])
    least, most = held.bounds(queries)
    for r in spark.read.parquet(f"{path}/rows").collect():
        i = int(np.flatnonzero(held.place == r.place)[0])
        d = np.sqrt(((queries - np.array(r.vec)) ** 2).sum(axis=1))
        assert (least[:, i] <= d).all() and (d <= most[:, i]).all()
        assert held.low[i] <= r.gap <= held.high[i]


def test_few_rows(spark, tables):
    out = fresh_path(spark, "rings")
    rings.store(tables[1].where("original_index < 3"), out)
    names = ["q_id", "original_index", "distance", "rank"]
    want = search.nearest(tables[0], tables[1].where("original_index < 3"), 5)
    assert rows(rings.search(tables[0], out, 5), *names) == rows(want, *names)
    assert rings.search(tables[0].limit(0), out, 5).count() == 0
    with pytest.raises(ValueError):
        rings.store(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "original_index bigint, vec array<double>"), fresh_path(spark, "rings"))

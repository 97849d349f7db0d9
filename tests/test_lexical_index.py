"""The stored inverted index against the scan that tokenises every text."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarryline.operators import lexical_index, search
from quarryline.session import fresh_path

DRAW = np.random.default_rng(11)
COMMON = [f"c{i}" for i in range(12)]
TEXTS = [
    (i, " ".join([*DRAW.choice(COMMON, int(DRAW.integers(1, 30))), f"rare{i // 5}" if i % 5 == 0 else "c0"])) for i in range(600)
]
TEXTS += [(i + 600, TEXTS[15][1]) for i in range(80)] + [(900, None), (901, ""), (902, "... !"), (903, "c1 " * 3000 + "rare3")]
ASKED = [(1, "rare3 c1 c2"), (2, "rare3 RARE3 rare40"), (3, "c0 c1 c2 c3"), (4, "unknown word"), (5, ""), (6, "rare7"), (7, "rare3 c1 c2")]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(TEXTS, "original_index bigint, text string").repartition(3, "original_index")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(ASKED, "q_id bigint, query_text string")


@pytest.fixture(scope="module")
def index(spark, corpus):
    path = fresh_path(spark, "index")
    for batch_id in (0, 1):
        lexical_index.add_batch(corpus.where(F.col("original_index") % 2 == batch_id), path, batch_id, slice_docs=32)
    return path


def found(df):
    return [(*r[:2], round(r[2], 6), r[3]) for r in rows(df, "q_id", "original_index", "score", "rank")]


@pytest.mark.parametrize("k,options", [(3, {}), (10, {}), (10, {"block_queries": 2}), (1000, {})])
def test_same_as_the_scan(corpus, asked, index, k, options):
    assert found(lexical_index.search(asked, index, k, **options)) == found(search.lexical(asked, corpus, k))


def test_slices_that_cannot_win_are_not_read(asked, corpus, index):
    one = asked.where("q_id IN (1, 2, 6)")
    s = lexical_index.Search(one, index, 2)
    bounds = s.bounds()
    first = lexical_index.top_k(bounds, ["q_id"], [F.desc("most"), F.col("batch_id"), F.col("slice")], 4, spread_by="slice").drop("rank")
    scored = s.scored(first)
    rest = s.wanted(bounds, first, scored)
    total, left = bounds.count() - first.count(), rest.count()
    assert left < total / 2  # blocks are skipped ...
    full = s._ranked(s.scored(bounds)).withColumnRenamed("doc", "original_index")
    assert found(full) == found(lexical_index.search(one, index, 2))  # ... without a difference
    best = {(r.q_id, r.doc): r.score for r in s.scored(bounds).collect()}
    most = {}
    for r in bounds.collect():
        most[r.q_id] = max(most.get(r.q_id, 0), r.most)
    assert all(score <= most[q] + 1e-9 for (q, _), score in best.items())


def test_only_the_folders_of_the_words_are_read(spark, asked, index):
    terms = spark.createDataFrame([("rare3",), ("c1",)], "term string")
    blocks = lexical_index.blocks_of(terms, index)
    plan = blocks.select("term", "n")._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert "part#" in filters[0] and "docs" not in plan and "PushedFilters: [In(term" in plan
    parts = {r.p for r in terms.select(lexical_index._part("term").alias("p")).collect()}
    assert {r.part for r in blocks.select("part").distinct().collect()} == parts


def test_replaced_batch_and_new_statistics(spark, corpus, asked, index):
    path = fresh_path(spark, "index")
    lexical_index.add_batch(corpus, path, 7)
    lexical_index.add_batch(corpus.where("original_index < 300"), path, 7, slice_docs=10)  # replaces the first run
    assert found(lexical_index.search(asked, path, 5)) == found(search.lexical(asked, corpus.where("original_index < 300"), 5))
    lexical_index.add_batch(corpus.where("original_index >= 300"), path, 8)
    assert found(lexical_index.search(asked, path, 5)) == found(search.lexical(asked, corpus, 5))


def test_string_ids_and_empty_sides(spark, corpus, asked):
    path = fresh_path(spark, "index")
    named = corpus.select(F.format_string("d%04d", "original_index").alias("id"), "text")
    lexical_index.add_batch(named, path, 0, row_id="id")
    got = rows(lexical_index.search(asked, path, 4, row_id="id"), "q_id", "id", "rank")
    assert got == rows(search.lexical(asked, named, 4, row_id="id"), "q_id", "id", "rank")
    assert lexical_index.search(asked.limit(0), path, 4).count() == 0
    lexical_index.add_batch(named.limit(0), path, 0, row_id="id")
    assert lexical_index.search(asked, path, 4).count() == 0


def test_slices_end_at_their_bytes(monkeypatch):
    monkeypatch.setattr(lexical_index, "SLICE_BYTES", 8 * 50)
    monkeypatch.setattr(lexical_index.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 2})()))
    words = [["a"] * n for n in (10, 30, 20, 70, 1, 1, 0)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(7)), "words": pa.array(words, pa.list_(pa.string()))})
    made = [t.to_pylist() for t in lexical_index._blocks(iter([batch]), 100)]
    sizes = [(next(r for r in t if r["term"] == "")["n"], next(r for r in t if r["term"] == "")["n_words"]) for t in made]
    assert sizes == [(2, 40), (1, 20), (1, 70), (3, 2)]
    assert len({r["slice"] for t in made for r in t}) == 4


def test_postings_are_bytes_and_documents_lie_once():
    """A posting takes 2 bytes in a slice of less than 256 documents, and an id is in its slice's own block only."""
    texts = [["a"] * (1 + i % 3) + ["b"] * (i % 2) for i in range(200)] + [[]]
    blocks = lexical_index._slice_blocks(pa.array(range(1000, 1201)), pa.array(texts, pa.list_(pa.string())), 4).to_pylist()
    assert [b["term"] for b in blocks] == ["a", "b", ""]
    for b, w in zip(blocks, "ab"):
        held = [i for i, t in enumerate(texts) if w in t]
        assert list(b["places"]) == held and list(b["tfs"]) == [texts[i].count(w) for i in held] and b["n"] == len(held)
        assert b["docs"] is None and b["lengths"] is None
    own = blocks[2]
    assert own["docs"] == list(range(1000, 1201)) and own["lengths"] == [len(t) for t in texts] and not own["places"]
    assert sum(len(b["places"]) + len(b["tfs"]) for b in blocks) == 2 * sum(len(set(t)) for t in texts)


@pytest.mark.parametrize("n,uses", [(300, 2), (70_000, 300), (4, 70_000)])
def test_wide_slices_are_scored_alike(spark, n, uses):
    """Places and counts of one, two and four bytes; ids not in order."""
    docs = [((i * 7919) % n, ["x"] * (uses if i == n - 1 else 1) + ["y"] * (i % 2)) for i in range(n)]
    blocks = pa.Table.from_batches([lexical_index._slice_blocks(pa.array([i for i, _ in docs]), pa.array([w for _, w in docs], pa.list_(pa.string())), 0)])
    asked = pa.table({"q_id": [5, 5, 6, 6], "term": ["x", "y", "y", "none"], "weight": [1.5, 0.5, 2.0, 1.0]})
    found = lexical_index._best_of_slice(asked, blocks, 3, 1.2, 0.75, 1.5).to_pylist()

    def score(words, weights):
        tf = {w: words.count(w) for w in weights}
        return round(sum(weights[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(words) / 1.5)) for w in weights if tf[w]), search.DECIMALS)

    for q, weights in ((5, {"x": 1.5, "y": 0.5}), (6, {"y": 2.0})):
        want = sorted(((-score(w, weights), i) for i, w in docs if score(w, weights) > 0))[:3]
        assert [(-r["score"], r["doc"]) for r in found if r["q_id"] == q] == [(pytest.approx(s), i) for s, i in want]

"""Top-k search against brute force, in the shipped and in the cogrouped form."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarryline.operators import evaluate, rerank, search
from quarryline.operators.ranking import numbered, top_k

RNG = np.random.default_rng(7)
CORPUS = [(i, RNG.normal(size=8).round(2).tolist()) for i in range(300)]
CORPUS += [(i + 300, CORPUS[0][1]) for i in range(100)]  # a quarter are copies of one vector
ASKED = [(i, RNG.normal(size=8).round(2).tolist()) for i in range(20)] + [(20, CORPUS[0][1])]


def expected(k, metric="l2", group=lambda i: None):
    out = []
    for q, v in ASKED:
        buckets = {}
        for i, w in CORPUS:
            a, b = np.array(v), np.array(w)
            d = np.sqrt(((a - b) ** 2).sum()) if metric == "l2" else 1 - a @ b / np.sqrt((a @ a) * (b @ b))
            buckets.setdefault(group(i), []).append((round(float(d), 9), i))
        for g, found in buckets.items():
            out += [(q, i, n + 1) + (() if g is None else (g,)) for n, (_, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def tables(spark):
    corpus = spark.createDataFrame(CORPUS, "original_index bigint, vec array<double>").repartition(5)
    asked = spark.createDataFrame(ASKED, "q_id bigint, query_vec array<double>")
    return asked, corpus


@pytest.mark.parametrize("ship_rows", [1000, 6])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("k", [3, 500])
def test_nearest(tables, k, metric, ship_rows, monkeypatch):
    monkeypatch.setattr(search, "CELL_ROWS", 90)
    asked, corpus = tables
    found = search.nearest(asked, corpus, k, metric=metric, ship_rows=ship_rows)
    got = rows(found, "q_id", "original_index", "rank")
    if metric == "l2":
        assert got == expected(k, metric)
    else:  # equal up to the last digits, which decide nothing but order among copies
        assert len(got) == len(expected(k, metric))
        assert [g[0] for g in got] == [e[0] for e in expected(k, metric)]


@pytest.mark.parametrize("ship_rows", [1000, 6])
def test_nearest_per_group(tables, ship_rows):
    asked, corpus = tables
    grouped = corpus.withColumn("side", F.when(F.col("original_index") % 2 == 0, "even").otherwise("odd"))
    found = search.nearest(asked, grouped, 4, group="side", ship_rows=ship_rows)
    assert rows(found, "q_id", "original_index", "rank", "side") == expected(
        4, group=lambda i: "even" if i % 2 == 0 else "odd"
    )


def test_small_blocks_give_the_same(tables, monkeypatch):
    asked, corpus = tables
    scorer = search.VectorScorer.from_table(asked.toArrow(), "query_vec", "vec", "l2")
    monkeypatch.setattr(search, "SCORE_CELLS", 100)
    monkeypatch.setattr(search, "PAIR_SLICE", 7)
    found = list(search._best_rows(corpus.toArrow().to_batches(max_chunksize=33), scorer, 3, "original_index", None))
    got = sorted((r["q_id"], r["original_index"]) for b in found for r in b.to_pylist())
    assert got == sorted((q, i) for q, i, _ in expected(3))


def brute(asked, corpus, k):
    gaps = np.round(np.sqrt(((corpus[:, None, :] - asked[None, :, :]) ** 2).sum(axis=2)), search.DECIMALS)
    return [(q, int(i)) for q in range(len(asked)) for i in np.lexsort((np.arange(len(corpus)), gaps[:, q]))[:k]]


def searched(asked, corpus, k, size=700):
    lists = lambda m: pa.array(m.tolist(), pa.list_(pa.float64()))
    scorer = search.VectorScorer(pa.array(range(len(asked))), asked, "vec", "l2")
    batch = pa.record_batch({"original_index": pa.array(range(len(corpus))), "vec": lists(corpus)})
    batches = [batch.slice(at, size) for at in range(0, len(corpus), size)]
    found = [r for b in search._best_rows(batches, scorer, k, "original_index", None) for r in b.to_pylist()]
    return [(r["q_id"], r["original_index"]) for r in sorted(found, key=lambda r: (r["q_id"], r["score"], r["original_index"]))]


@pytest.mark.parametrize(("scale", "shift"), [(1, 0), (1e-3, 1000), (1e-12, 0), (1e12, 0), (1, 1e6)])
def test_rough_scores_lose_no_winner(scale, shift, monkeypatch):
    """Rough scores in single precision decide nothing: also where it cannot tell the rows apart."""
    draw = np.random.default_rng(5)
    corpus, asked = (draw.normal(size=(n, 16)) * scale + shift for n in (3000, 70))
    corpus[2000:2100] = corpus[7]
    asked[3] = corpus[7]
    monkeypatch.setattr(search, "QUERY_TILE", 32)
    monkeypatch.setattr(search, "FIRST_ROWS", 64)
    assert searched(asked, corpus, 4) == brute(asked, corpus, 4)


def test_a_broken_vector_costs_no_other_its_place():
    draw = np.random.default_rng(6)
    corpus, asked = draw.normal(size=(900, 4)), draw.normal(size=(9, 4))
    want = brute(asked[1:], corpus, 3)
    corpus = np.vstack([corpus, [[np.nan, 0, 0, 0], [np.inf, 0, 0, 0], [1e200, 0, 0, 0]]])
    asked[0, 2] = np.nan
    assert searched(asked, corpus, 3) == [(q + 1, i) for q, i in want]


def test_only_queries_with_new_rows_are_sorted_anew(monkeypatch):
    draw = np.random.default_rng(8)
    corpus, asked = draw.normal(size=(8000, 8)), draw.normal(size=(600, 8))
    monkeypatch.setattr(search, "SCORE_CELLS", 12_000)  # 20 rows against all queries
    sizes, lexsort = [], np.lexsort
    monkeypatch.setattr(search.np, "lexsort", lambda keys: (sizes.append(len(keys[0])), lexsort(keys))[1])
    found = searched(asked, corpus, 3, size=4000)
    assert sum(sizes) < 100 * len(found)  # 400 times as many and more where every block of rows sorts all hits
    assert found == brute(asked, corpus, 3)


def test_leaders_hold_longer_and_fewer_ids():
    best = search.Leaders(3, 2)
    assert best.ids is None
    best.add(np.array([1, 1, 1]), np.array(["b", "a", "c"]), np.array([1.0, 1.0, 0.5]))
    best.add(np.array([0, 1]), np.array(["long id", "other id"]), np.array([9.0, 0.75]))
    assert best.query.tolist() == [0, 1, 1] and best.ids.tolist() == ["long id", "c", "other id"]
    assert best.score.tolist() == [9.0, 0.5, 0.75] and best.bound.tolist() == [np.inf, 0.75, np.inf]


def test_rows_without_a_vector_are_left_out(spark, tables):
    asked, corpus = tables
    blank = spark.createDataFrame([(999, None)], "original_index bigint, vec array<double>")
    assert search.nearest(asked, corpus.union(blank), 500).where("original_index = 999").count() == 0


def test_empty_corpus(tables):
    asked, corpus = tables
    assert search.nearest(asked, corpus.where("false"), 3).count() == 0
    assert search.nearest(asked, corpus.where("false"), 3, ship_rows=5).count() == 0


def test_text_row_ids(spark, tables):
    asked, corpus = tables
    named = corpus.select(F.format_string("r%03d", "original_index").alias("id"), "vec")
    got = rows(search.nearest(asked, named, 3, row_id="id"), "q_id", "id", "rank")
    assert got == [(q, f"r{i:03d}", n) for q, i, n in expected(3)]


TEXTS = ["the cat sat on the mat", "the dog", "a cat and a dog", "The the the", "", "on on on cat", "zebra"] + ["the cat"] * 4
QUESTIONS = ["cat on mat", "the", "Dog dog", "missing words", ""]


def bm25(k):
    docs = [re.findall(r"[^\W_]+", t.lower()) for t in TEXTS]
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    out = []
    for q, text in enumerate(QUESTIONS):
        scores = []
        for i, d in enumerate(docs):
            tf, s = Counter(d), 0.0
            for w, n in Counter(re.findall(r"[^\W_]+", text.lower())).items():
                idf = math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
                s += n * idf * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(d) / mean))
            if s > 0:
                scores.append((-round(s, 9), i))
        out += [(q, i, n + 1, round(-s, 6)) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("ship_rows", [1000, 2])
def test_lexical(spark, ship_rows, monkeypatch):
    monkeypatch.setattr(search, "CELL_ROWS", 4)
    corpus = spark.createDataFrame(list(enumerate(TEXTS)), "original_index bigint, text string")
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "q_id bigint, query_text string")
    found = search.lexical(asked, corpus, 3, ship_rows=ship_rows).withColumn("score", F.round("score", 6))
    assert rows(found, "q_id", "original_index", "rank", "score") == bm25(3)


def test_lexical_in_small_slices(spark, monkeypatch):
    corpus = spark.createDataFrame(list(enumerate(TEXTS)), "original_index bigint, text string")
    asked = spark.createDataFrame(list(enumerate(QUESTIONS)), "q_id bigint, query_text string")
    words = corpus.select("original_index", search.tokens("text").alias("words")).toArrow()
    postings = asked.select("q_id", F.explode(search.tokens("query_text")).alias("term")).withColumn("weight", F.lit(1.0))
    monkeypatch.setattr(search, "PAIR_SLICE", 2)
    results = []
    for cells in (3, 1_000_000):
        monkeypatch.setattr(search, "SCORE_CELLS", cells)
        scorer = search.WordScorer(postings.toArrow(), "words", 3.0, 1.2, 0.75)
        found = search._best_rows(words.to_batches(), scorer, 3, "original_index", None)
        results.append(sorted(tuple(r.values()) for b in found for r in b.to_pylist()))
    assert results[0] == results[1] and results[0]


def test_top_k_with_slices(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), (F.col("id") % 50).alias("v"), "id")
    plain = rows(top_k(df, ["key"], [F.col("v"), F.col("id")], 7))
    assert rows(top_k(df, ["key"], [F.col("v"), F.col("id")], 7, spread_by="id")) == plain
    assert len(plain) == 21


def test_partial_limit_in_plan(tables):
    asked, corpus = tables
    plan = search.nearest(asked, corpus, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "MapInArrow" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_numbered(spark):
    df = spark.range(4000).select((F.col("id") * 3).alias("a"), F.explode(F.array(F.lit(1), F.lit(0))).alias("b"))
    got = numbered(df, "a", ["b"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(8000))
    assert [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got)


def test_numbered_with_an_outlier(spark):
    df = spark.range(4000).select(F.when(F.col("id") == 7, 10**15).otherwise(F.col("id")).alias("a"), F.lit(0).alias("b"))
    got = numbered(df, "a", ["b"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(4000)) and got[-1].a == 10**15
    ranges = df.repartitionByRange(8, "a", "b").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in ranges) < 2000


def test_a_query_without_a_vector_has_no_hits(spark):
    corpus = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, None)], "original_index long, vec array<double>")
    asked = spark.createDataFrame([(1, [0.0, 1.0]), (2, None)], "q_id long, query_vec array<double>")
    assert rows(search.nearest(asked, corpus, 1), "q_id", "original_index") == [(1, 1)]
    assert search.nearest(asked.where("q_id = 2"), corpus, 1).count() == 0


def test_vectors_of_different_lengths_are_an_error(spark):
    corpus = spark.createDataFrame([(1, [0.0]), (2, [1.0, 0.0, 1.0])], "original_index long, vec array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "q_id long, query_vec array<double>")
    with pytest.raises(Exception, match="different lengths"):
        search.nearest(asked, corpus, 1).collect()


def test_search_keeps_the_splits_of_the_corpus(spark):
    corpus = spark.range(0, 600, 1, 60).select(F.col("id").alias("original_index"), F.array(F.col("id").cast("double")).alias("vec"))
    asked = spark.createDataFrame([(1, [5.0])], "q_id long, query_vec array<double>")
    plan = search.nearest(asked, corpus, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan


@pytest.mark.parametrize("ship_rows", [1000, 6])
def test_routed_queries_meet_their_groups_only(tables, ship_rows, monkeypatch, spark):
    monkeypatch.setattr(search, "CELL_ROWS", 90)
    asked, corpus = tables
    sided = corpus.withColumn("side", F.concat(F.lit("s"), (F.col("original_index") % 3).cast("string")))
    routes = asked.where("q_id < 20").withColumn("side", F.explode(F.when(F.col("q_id") % 2 == 0, F.array(F.lit("s0"))).otherwise(F.array(F.lit("s0"), F.lit("s2")))))
    found = rows(search.nearest_routed(routes, sided, 5, "side", ship_rows=ship_rows), "q_id", "original_index", "rank")
    want = []
    for q, _ in ASKED[:20]:
        sides = {0} if q % 2 == 0 else {0, 2}
        own = search.nearest(asked.where(F.col("q_id") == q), corpus.where((F.col("original_index") % 3).isin(*sides)), 5) if q < 4 else None
        if own is not None:
            want += rows(own, "q_id", "original_index", "rank")
    assert [f for f in found if f[0] < 4] == sorted(want) and len(found) == 100
    assert search.nearest_routed(routes.limit(0), sided, 5, "side").count() == 0


@pytest.mark.parametrize("part_bytes", [1 << 20, 8])
def test_truth_pairs_and_recall(spark, part_bytes):
    asked = spark.createDataFrame([(1, "abc"), (2, "bc"), (3, "abc"), (4, ""), (5, None), (6, "nowhere"), (7, "éé")], "q_id bigint, query_text string")
    texts = spark.createDataFrame([(1, "xabcx abc"), (2, "bc"), (3, None), (4, ""), (5, "ééé")], "original_index bigint, text string")
    truth = evaluate.truth_pairs(asked, texts, part_bytes=part_bytes)
    assert rows(truth, "q_id", "original_index") == [(1, 1), (2, 1), (2, 2), (3, 1), (7, 5)]
    hits = spark.createDataFrame([(2, 9, 1), (2, 2, 2), (1, 1, 1), (6, 1, 1)], "q_id bigint, original_index bigint, rank bigint")
    got = rows(evaluate.recall(asked, hits, truth), "q_id", "n_truth", "n_found", "recall", "reciprocal_rank")
    assert got == [(1, 1, 1, 1.0, 1.0), (2, 2, 1, 0.5, 0.5), (3, 1, 0, 0.0, 0.0), (4, 0, 0, 0.0, 0.0), (5, 0, 0, 0.0, 0.0), (6, 0, 0, 0.0, 0.0), (7, 1, 0, 0.0, 0.0)]
    assert evaluate.truth_pairs(asked.limit(0), texts).count() == 0


def test_smallest_window_against_all_windows():
    draw = np.random.default_rng(21)
    for _ in range(300):
        words = [f"w{i}" for i in draw.integers(0, 8, int(draw.integers(0, 25)))]
        wanted = {f"w{i}" for i in draw.integers(0, 12, 4)}
        present = wanted & set(words)
        widths = [j - i for i in range(len(words)) for j in range(i + 1, len(words) + 1) if present and present <= set(words[i:j])]
        kinds, width = rerank._smallest_window(words, wanted)
        assert kinds == len(present) and (not present or width == min(widths))


def test_words_that_stand_together_score_more(spark):
    pairs = spark.createDataFrame([(1, "red fox", "a red fox ran"), (2, "red fox", "red a b c fox"), (3, "red fox", "the Fox"), (4, "red fox", ""), (5, "", "x"), (6, None, None)],
                                  "id int, query string, passage string")
    scores = {r.id: r.s for r in pairs.select("id", rerank.proximity(F.col("query"), F.col("passage")).alias("s")).collect()}
    assert scores == {1: 1.0, 2: 0.4, 3: 0.5, 4: 0.0, 5: 0.0, 6: 0.0}

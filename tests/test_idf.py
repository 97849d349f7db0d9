"""Weights from stored frequencies: additive, versioned, and the same as those of one pass."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarryline.functions.vectors import COUNT_DIM, count_words
from quarryline.operators import idf, search
from quarryline.session import fresh_path

TEXTS = [(i, f"the the word{i % 7} number{i} stands here") for i in range(60)] + [(60, None), (61, ""), (62, "The RIVER river"), (63, "river")]


def cell(word):
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:2]) % COUNT_DIM


def expected(texts):
    counts = [Counter(cell(w) for w in re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    df = Counter(c for x in counts for c in x)
    weighted = [{c: n * math.log((len(texts) + 1) / (df[c] + 1)) for c, n in x.items()} for x in counts]
    norms = [math.sqrt(sum(v * v for v in x.values())) for x in weighted]
    return [{c: v / n for c, v in x.items()} if n else {} for x, n in zip(weighted, norms)]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(TEXTS, "original_index bigint, text string")


def vectors(df):
    return {r.original_index: list(r.vec) for r in df.collect()}


def test_two_batches_equal_one_and_plain_python(spark, samples):
    one, two = fresh_path(spark, "one"), fresh_path(spark, "two")
    idf.add_batch(samples, one, 0)
    for batch_id in (0, 1):
        idf.add_batch(samples.where(F.col("original_index") % 2 == batch_id), two, batch_id)
    assert idf.statistics(spark, one) == idf.statistics(spark, two)
    got = vectors(idf.stored_vectors(spark, two))
    assert got == vectors(idf.stored_vectors(spark, one)) and len(got) == len(TEXTS)
    for (i, _), want in zip(TEXTS, expected([t for _, t in TEXTS])):
        assert all(abs(v - want.get(c, 0.0)) < 1e-12 for c, v in enumerate(got[i]))


def test_versions_and_replays(spark, samples):
    path, before = fresh_path(spark, "versions"), samples.where("original_index < 30")
    idf.add_batch(samples, path, 0)
    idf.add_batch(before, path, 0)  # replaces the first run
    first = vectors(idf.stored_vectors(spark, path))
    stored = spark.read.parquet(f"{path}/counts").select("original_index", "counts").collect()
    idf.add_batch(samples.where("original_index >= 30"), path, 1)
    again = spark.read.parquet(f"{path}/counts").where("batch_id = 0").select("original_index", "counts").collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, again))  # a new batch rewrites nothing
    assert vectors(idf.stored_vectors(spark, path, version=0)) == first
    assert idf.statistics(spark, path)[0] == len(TEXTS) and idf.statistics(spark, path, version=0)[0] == 30


def test_rare_words_outweigh_common_ones(spark, samples):
    path = fresh_path(spark, "search")
    idf.add_batch(samples, path, 0)
    asked = spark.createDataFrame([(1, "the the the river"), (2, "the number41")], "q_id bigint, query_text string")
    best = search.nearest(idf.query_vectors(asked, path), idf.stored_vectors(spark, path), 1)
    found = {r.q_id: r.original_index for r in best.collect()}
    assert found[1] in (62, 63) and found[2] == 41


def test_empty_tables(spark, samples):
    path = fresh_path(spark, "empty")
    assert idf.statistics(spark, path) == (0, [0] * COUNT_DIM)
    idf.add_batch(samples.limit(0), path, 0)
    assert idf.statistics(spark, path) == (0, [0] * COUNT_DIM)
    assert samples.select(F.size(count_words("text")).alias("n")).distinct().collect() == [(COUNT_DIM,)]

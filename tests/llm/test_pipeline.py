"""Each stage on its own input, against brute force."""

import hashlib

import pytest

import corpus_pipeline as pipeline
from quarryline.llm import decontaminate
from test_dedup import brute
from odd_rows import no_docs, odd_docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and its output, as lists of rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        after = pipeline.written(stage(spark, docs, FOLDER), name)
        out[name] = docs.collect(), after.collect(), after.columns
        docs = after
    return out


def test_columns_and_order(stages):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "encode"]
    assert all(columns == pipeline.COLUMNS for name, (_, _, columns) in stages.items() if name != "encode")


def test_quality_keeps_good_documents(stages, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after, _ = stages["quality"]
    kept = {r.doc_id for r in after}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and len(after) < len(before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_exact(stages):
    before, after, _ = stages["exact_dedup"]
    best = {}
    for r in before:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())


def test_near(stages):
    before, after, _ = stages["near_dedup"]
    want = brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, component) in want.items() if component == i)


def test_near_with_shared_and_missing_ids(spark):
    words = [f"w{i}" for i in range(60)]
    text, other, third = " ".join(words), " ".join(reversed(words)), " ".join(words[::2] * 2)
    rows = [(5, text), (7, text + " more"), (7, other), (7, None), (None, third), (None, third + " end"), (9, third + " also"), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {(r.doc_id, r.text) for r in pipeline.near_stage(spark, docs, FOLDER).collect()}
    assert kept == {(5, text), (7, other), (7, None), (7, ""), (9, third + " also")}


def test_decontaminate(stages, spark):
    before, after, _ = stages["decontaminate"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    report = decontaminate.report(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in report.where("NOT contaminated").collect())


def test_encode(stages):
    before, after, _ = stages["encode"]
    texts = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest() and r.n_tokens == len(r.ids) // 4


def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        docs = docs.selectExpr("doc_id", "text", "lang", "c0 AS source", "n_tokens AS n_chars")
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
        docs.collect()

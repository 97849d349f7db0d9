"""Ranked search against plain Python, whatever the blocks, the vocabulary's size and the number kept."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import labels, no_docs, odd_docs  # noqa: F401

from quarryline.llm import term_stages

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(items, docs, keep):
    held = [Counter(terms(text)) for _, text in docs]
    total, n_docs = sum(sum(c.values()) for c in held), sum(1 for c in held if c)
    df = Counter(t for c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c in zip(docs, held):
            m = 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item_id, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:keep])]
    return Counter(out)


def found(items, docs, spark, keep=50, **options):
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = term_stages.search(items, docs, keep, **options).select("item_id", "rank", "doc_id", "score").collect()
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def texts():
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    docs = [(i, " ".join(draw.choice(words, int(draw.integers(1, 60)), p=share / share.sum()))) for i in range(900)]
    docs += [(1000 + i, docs[7][1]) for i in range(300)]  # copies tie
    items = [(i, " ".join(draw.choice(words, 12))) for i in range(9)] + [(20, docs[7][1]), (21, "w0 W0 w1"), (22, "nowhere")]
    return items, docs


@pytest.mark.parametrize("options", [{}, {"ship_terms": 0}, {"block_items": 4}, {"keep": 3}, {"keep": 5000}])
def test_same_as_plain_python(spark, texts, options):
    items, docs = texts
    assert found(items, docs, spark, **options) == ranked(items, docs, options.get("keep", 50))


def test_slices_of_several_documents_each(spark, texts, monkeypatch):
    monkeypatch.setattr(term_stages, "SLICE_BITS", 4)
    monkeypatch.setattr(term_stages, "SLICE_DOCS", 16)
    items, docs = texts
    assert found(items, docs, spark, keep=10) == ranked(items, docs, 10)


def test_bundles_leave_out_documents_that_cannot_win():
    n = 2000
    held = pa.table({
        "places": [list(range(n))], "ids": [list(range(n))], "at": [list(range(n))], "codes": [[1] * n], "parts": [list(range(1, n + 1))],
    })
    long, kind = pa.int64(), pa.struct([("owner", pa.int64()), ("code", pa.int64()), ("weight", pa.int64()), ("most", pa.int64())])
    schema = pa.schema([("slice", long), ("block", long), ("item", long), ("terms", pa.list_(kind)), ("floor", long), *((c, pa.list_(long)) for c in ("places", "ids", "scores"))])
    term = {"owner": 0, "code": 1, "weight": 100, "most": 100 * n}
    for to_come, left in ((0, 5), (1000, 15), (10**9, n)):
        row = {"slice": 0, "block": 0, "item": 1, "terms": [term, {"owner": 1, "code": 2, "weight": 1, "most": to_come}], "floor": 0, "places": [], "ids": [], "scores": []}
        out = term_stages._pass_on(0, 5)(pa.Table.from_pylist([row], schema=schema), held).to_pylist()[0]
        assert len(out["places"]) == left and out["floor"] == 100 * (n - 4)
        assert [t["owner"] for t in out["terms"]] == [1]


def test_odd_rows(spark, odd_docs, no_docs):
    asked = [(1, "the quick row"), (1, "the quick row"), (None, "lorem x 日本語のテキスト"), (3, None), (4, ""), (5, " - ")]
    items = spark.createDataFrame(asked, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS rank", "3 AS doc_id")
    rows = term_stages.search(items, odd_docs.selectExpr("*", "1 AS row", "2 AS slice", "3 AS score")).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter((r.item_id, r.rank, r.doc_id, r.score) for r in rows) == ranked(asked, docs, 50)
    assert any(r.doc_id is None for r in rows)
    assert term_stages.search(items, no_docs).collect() == []
    assert term_stages.search(items.limit(0), odd_docs).collect() == []

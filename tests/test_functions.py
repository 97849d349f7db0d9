"""Expressions and small operators on hand-written rows."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quarryline.functions import code, digests, text, vectors
from quarryline.operators import analysis, cache, context, evaluate, filters, rerank, weighting
from quarryline.plans import retrieval
from quarryline.constants import PROMPTS


def one(spark, column, **values):
    fields = {bool: "boolean", int: "bigint", float: "double", str: "string", type(None): "string"}
    schema = ", ".join(f"{k} {fields[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("body", "path", "kind"),
    [
        ("class X", "a.h", "header_file"),
        ("my subclass", "a.py", "class_definition"),
        ("a FUNCTION", "a.js", "function_implementation"),
        ("def f", "a.java", "function_implementation"),
        ("Def f", "a.py", "code_snippet"),
        ("x = require('y')", "a.js", "module_with_imports"),
        ("IMPORT x", "a.py", "module_with_imports"),
        ("class X", "a.go", "code_snippet"),
    ],
)
def test_code_type(spark, body, path, kind):
    assert one(spark, code.code_type("t", "p"), t=body, p=path) == kind


@pytest.mark.parametrize(("path", "kind"), [("a/b.py", "py"), ("Makefile", "unknown"), ("v1.2/run", "2/run")])
def test_file_type(spark, path, kind):
    assert one(spark, code.file_type("p"), p=path) == kind


@pytest.mark.parametrize(
    ("name", "domain"),
    [("build-kit", "ui"), ("mapper", "mobile"), ("API-bot", "web"), ("auto-x", "automation"), ("zzz", "general")],
)
def test_domain(spark, name, domain):
    assert one(spark, code.repo_domain("r"), r=name) == domain


@pytest.mark.parametrize(
    ("lang", "body", "functions", "imports"),
    [
        ("python", "import os.path\nfrom re import x\ndef f(a):\n  pass", ["f"], ["os.path", "re", "x"]),
        ("javascript", "const a = require('fs');\nimport b from 'c';\nfunction g() {}", ["g"], ["fs", "b", "c"]),
        ("c", '#include <stdio.h>\n#import "a.h"\nint main(void) { f(1); }', ["main"], ["stdio.h", "a.h"]),
        ("go", "import fmt\nfunc h() {}", ["h"], ["fmt"]),
        (None, "import z\ndef k", ["k"], ["z"]),
    ],
)
def test_names(spark, lang, body, functions, imports):
    df = spark.createDataFrame([(lang, body)], "lang string, t string")
    row = df.select(code.functions("t", "lang").alias("f"), code.imports("t", "lang").alias("i")).first()
    assert row.f == functions and [i for i in row.i] == imports


def test_complexity(spark):
    assert one(spark, code.complexity("t"), t="if a and b or_c: while x") == 4
    assert one(spark, code.complexity("t"), t="if " * 50) == 51


@pytest.mark.parametrize(
    ("body", "lead"),
    [("A b. C! D? E.", "A b.  C!  D?"), ("No end", None), ("", None), ("One. tail", "One."), ("...a.", "a.")],
)
def test_lead_sentences(spark, body, lead):
    assert one(spark, text.lead_sentences("t"), t=body) == lead


def test_lead_sentences_with_input_limit(spark):
    assert one(spark, text.lead_sentences("t", max_chars=3), t="Ab. Cd.") == "Ab."


def test_long_text_without_end_mark_is_read_once(spark):
    assert one(spark, text.lead_sentences(F.repeat("t", F.lit(300_000))), t="word ") is None


def test_markers_and_roles(spark):
    assert one(spark, text.after_marker("t", "|"), t="a|b|\t c\n") == "c"
    assert one(spark, text.after_marker("t", "|"), t=" a ") == "a"
    assert one(spark, text.without("t", "p"), t="prompt answer ", p="prompt") == "answer"
    assert one(spark, text.bare_query(text.as_query("t")), t="x") == "x"
    assert one(spark, text.wants_follow_up("t"), t="No Follow-up NEEDED") is False
    assert one(spark, text.wants_follow_up("t"), t="no follow-up needed.") is True
    assert one(spark, text.wants_follow_up("t"), t=" No follow-up needed\n") is False
    assert one(spark, text.metadata_prefix("a", "b", "c"), a=None, b="r", c=3) == "# Language: None\n# Repo: r\n# Stars: 3\n"


def test_expansion_and_routes(spark):
    assert one(spark, text.expand_query("t"), t="Loop over an array") == (
        "Loop over an array list collection sequence iteration cycle repeat"
    )
    assert one(spark, text.expand_query("t"), t="functional") == "functional"
    assert one(spark, text.routed_collections("t"), t="Implement and explain") == ["examples", "code_snippets"]
    assert one(spark, text.routed_collections("t"), t="EXPLAIN") == ["documentation"]
    assert len(one(spark, text.routed_collections("t"), t="other")) == 3


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<float>, b array<float>")
    r = df.select(
        vectors.l2_distance("a", "b").alias("l2"), vectors.cosine_distance("a", "a").alias("cos"),
        vectors.vector_text("a").alias("t"), vectors.parse_vector(vectors.vector_text("b")).alias("p"),
    ).first()
    assert (r.l2, round(r.cos, 9), r.t, r.p) == (5.0, 0.0, "[1.0,2.0]", [4.0, 6.0])


def test_default_embedding(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,), ("A, B! a",)], "t string")
    got = [r.v for r in df.select(vectors.embed_text("t").alias("v")).collect()]
    assert got[0] == got[3] and len(got[0]) == vectors.DIM
    assert abs(sum(x * x for x in got[0]) - 1) < 1e-12
    assert got[1] == [0.0] * vectors.DIM and got[2] == got[1]


def test_user_model(spark):
    def load():
        return lambda texts: np.array([[len(t), 1] for t in texts], dtype=np.float32)

    embed = vectors.model_column(load)
    df = spark.createDataFrame([("abc",), ("de",)], "t string")
    assert sorted(r.v for r in df.select(embed(F.col("t")).alias("v")).collect()) == [[2.0, 1.0], [3.0, 1.0]]


def test_user_reranker(spark):
    def load():
        return lambda queries, passages: np.array([float(len(p) - len(q)) for q, p in zip(queries, passages)])

    hits = spark.createDataFrame(
        [(1, 1, "q", "s", "code"), (1, 2, "q", "s", "longer code"), (1, 3, "q", "s", "abcd")],
        "q_id bigint, prior_rank bigint, query_text string, summary string, code string",
    )
    best = rerank.rerank(rerank.score_pairs(hits, rerank.model_score(load)), keep=2)
    assert rows(best, "rank", "prior_rank", "score") == [(1, 2, 12.0), (2, 1, 5.0)]


def test_filters(spark):
    data = [(1, "python", 50, 10), (2, "python", 49, 10), (3, "c", 2000, 9), (4, "go", 60, 99), (5, None, 60, 99), (6, "", 60, 99), (7, "c", 2000, 10)]
    df = spark.createDataFrame(data, "original_index bigint, lang string, len_tokens bigint, star bigint")
    assert rows(filters.quality_filter(df), "original_index") == [(1,), (7,)]
    assert rows(filters.short_lang_filter(df), "original_index") == [(1,), (2,), (4,)]
    assert rows(filters.min_stars(df, 99), "original_index") == [(4,), (5,), (6,)]
    assert [r.lang for r in analysis.lang_counts(df).collect()] == ["c", "python", "", "go"]


@pytest.mark.parametrize(
    ("stars", "literal", "boost"), [(0, 1.0, 1.0), (999, 1.999, 1 / 1.999), (2000, 3.0, 1 / 3), (5000, 3.0, 1 / 3), (None, 1.0, 1.0)]
)
def test_weighting(spark, stars, literal, boost):
    df = spark.createDataFrame([(1.0, stars)], T.StructType([T.StructField("d", T.DoubleType()), T.StructField("s", T.LongType())]))
    d, s = F.col("d"), F.col("s")
    assert df.select(weighting.weighted_score(d, s)).first()[0] == pytest.approx(literal)
    assert df.select(weighting.weighted_score(d, s, "boost")).first()[0] == pytest.approx(boost)
    with pytest.raises(ValueError):
        weighting.weighted_score(d, s, "other")


def test_cache(spark):
    log = spark.createDataFrame([("2", "hi", "later"), ("1", "hi", "first"), ("3", "yo", "x")], "id string, query string, final_answer string")
    asked = spark.createDataFrame([(1, "hi"), (2, "Hi"), (3, "hi")], "q_id bigint, query_text string")
    assert rows(cache.answer_cache(asked, log), "q_id", "cached") == [(1, True), (2, False), (3, True)]
    assert {r.final_answer for r in cache.answer_cache(asked, log).collect()} == {"first", None}
    assert rows(cache.misses(asked, log), "q_id") == [(2,)]


def test_serve_searches_each_open_text_once(spark):
    log = spark.createDataFrame([("1", "known", "answer")], "id string, query string, final_answer string")
    asked = spark.createDataFrame([(1, "known"), (2, "word3"), (3, "word3"), (4, "word1")], "q_id bigint, query_text string")
    samples = spark.createDataFrame([(i, f"word{i}.") for i in range(5)], "original_index bigint, text string")
    got = {r.q_id: r for r in retrieval.serve(asked, log, retrieval.text_corpus(samples), samples, k=1).collect()}
    assert (got[1].cached, got[1].final_answer, got[1].prompt) == (True, "answer", None)
    assert "Summary: word3." in got[2].prompt and got[2].prompt == got[3].prompt
    assert "Summary: word1." in got[4].prompt and not got[4].cached


def test_serve_embeds_the_open_texts_once(spark, monkeypatch):
    given, nearest = [], retrieval.nearest
    monkeypatch.setattr(retrieval, "nearest", lambda asked, *rest: (given.append(asked), nearest(asked, *rest))[1])
    log = spark.createDataFrame([("1", "known", "answer")], "id string, query string, final_answer string")
    asked = spark.createDataFrame([(1, "known"), (2, "word3")], "q_id bigint, query_text string")
    samples = spark.createDataFrame([(i, f"word{i}.") for i in range(5)], "original_index bigint, text string")
    assert retrieval.serve(asked, log, retrieval.text_corpus(samples), samples, k=1).count() == 2
    assert "ArrowEvalPython" not in given[0]._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [0, 10_000])
def test_digests_of_words_side_by_side(monkeypatch, few):
    monkeypatch.setattr(digests, "FEW_WORDS", few)
    monkeypatch.setattr(digests, "BLOCK_WORDS", 50)
    words = ["", "a", "the", "é" * 27, "é" * 28, "x" * 55, "x" * 56, "x" * 64, "x" * 300, "語", "𝔸1"] + [f"w{i}" * (i % 9) for i in range(400)]
    whole = pa.array(words)
    for some in (whole, whole.slice(3, 200), whole.slice(7), whole.slice(2, 0), whole.dictionary_encode().dictionary):
        assert digests.md5_heads(some).tolist() == [int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "little") for w in some.to_pylist()]


def test_report_counts_missing_language_and_keeps_empty_queries(spark):
    hits = spark.createDataFrame([(1, None, 10), (1, "", None), (1, "c", 20)], "q_id bigint, lang string, star bigint")
    asked = spark.createDataFrame([(1,), (2,)], "q_id bigint")
    got = rows(evaluate.eval_report(asked, hits), "q_id", "popularity", "diversity", "total_results")
    assert got == [(1, 10.0, 3, 3), (2, 0.0, 0, 0)]


@pytest.mark.parametrize(
    ("style", "first"),
    [
        ("summaries", "Summary: s1\nDB ID: 9"),
        ("documents", "Summary: s1\nCode:\n```c1```\nDB ID: 9"),
        ("reranked", "Code:\nc1\n\nSummary: s1\nDB ID: 9"),
        ("links", "Summary: s1\nS3 Link: u1"),
        ("chunks", "[SUMMARY]\ns1\n\n[CODE]\nc1"),
        ("numbered", "\nDocument 1:\nSummary:\ns1\n\nCode:\nc1\n"),
    ],
)
def test_context_styles(spark, style, first):
    hits = spark.createDataFrame(
        [(1, 2, 8, "s2", "c2", "u2"), (1, 1, 9, "s1", "c1", "u1")],
        "q_id bigint, rank bigint, id bigint, summary string, code string, url string",
    )
    row = context.context(hits, style).first()
    assert row.n == 2
    assert row.text.split("\n\n---\n\n")[0] == first


@pytest.mark.parametrize("name", sorted(PROMPTS))
def test_prompts(spark, name):
    contexts = spark.createDataFrame([(1, "CTX", "EX")], "q_id bigint, text string, examples string")
    asked = spark.createDataFrame([(1, "query: what {now}")], "q_id bigint, query_text string")
    got = context.prompt(contexts, asked, PROMPTS[name]).first().prompt
    assert got == PROMPTS[name].replace("{context}", "CTX").replace("{query}", "what {now}").replace("{examples}", "EX")


def test_two_rounds(spark):
    corpus = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "original_index bigint, vec array<double>")
    samples = spark.createDataFrame([(i, f"word{i} common.") for i in range(10)], "original_index bigint, text string")
    asked = spark.createDataFrame(
        [(1, "word5 word1", [0.0, 0.0]), (2, "word9", [9.0, 5.0])], "q_id bigint, query_text string, query_vec array<double>"
    )
    run = lambda **kw: rows(
        retrieval.two_round(asked, corpus, samples, gate="best_distance > 1", **kw), "q_id", "rank", "original_index", "round"
    )
    # Query 1 finds itself at distance 0: one round.  Query 2 goes a second round, moved to (13, 5).
    assert run() == [(1, 1, 1, 1), (1, 2, 0, 1), (1, 3, 2, 1), (2, 1, 9, 1), (2, 2, 9, 2), (2, 3, 8, 1)]
    assert run(dedup=True)[3:] == [(2, 1, 9, 1), (2, 2, 8, 1), (2, 3, 7, 1)]


def test_prefilter_fills_k(spark):
    data = [(i, [float(i)], 50 if i % 2 else 5, "c", 100, "x") for i in range(20)]
    samples = spark.createDataFrame(data, "original_index bigint, vec array<double>, star bigint, lang string, len_tokens bigint, text string")
    asked = spark.createDataFrame([(1, [0.0])], "q_id bigint, query_vec array<double>")
    corpus = samples.select("original_index", "vec")
    late = weighting.repository_aware_search(asked, corpus, samples, k=4)
    early = weighting.repository_aware_search(asked, corpus, samples, k=4, prefilter=True)
    assert rows(late, "original_index") == [(1,), (3,), (5,), (7,)]
    assert rows(early, "original_index") == [(1,), (3,), (5,), (7,)]
    wide = weighting.repository_aware_search(asked, corpus, samples, k=8)
    assert wide.count() == 8 and weighting.repository_aware_search(asked, corpus, samples, k=12).count() == 10
    thin = samples.where("original_index < 8 OR original_index > 17")
    assert weighting.repository_aware_search(asked, corpus, thin, k=5).count() < 5
    assert weighting.repository_aware_search(asked, corpus, thin, k=5, prefilter=True).count() == 5


def test_filters_reach_the_parquet_reader(spark, folder):
    from quarryline.sources import tables

    sliced = tables.slice_scan(tables.code_samples(spark, folder), 0, 50).select("original_index", "len_tokens")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,0)" in plan and "LessThan(doc_id,50)" in plan
    assert "text" not in plan.split("ReadSchema")[1]

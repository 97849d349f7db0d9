"""Quality, toxicity and language: held-out accuracy, odd rows, and the parts that have exact answers."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarryline.llm import langid, quality, queries, toxicity, training
from odd_rows import labels, no_docs, odd_docs  # noqa: F401

FOLDER = "/root/testdata/sf0.1"


def judged(spark, query, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", label)
    return query(spark, FOLDER).join(labels, "doc_id").toPandas()


def check_contract(rows, modulus, remainder):
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % modulus == remainder for i in rows.doc_id]).all()
    assert rows.score.between(0, 1).all()


def test_quality_on_held_out_labels(spark):
    rows = judged(spark, queries.op1_quality_pu, "quality")
    check_contract(rows, 5, 0)
    held = rows[rows.held_out]
    assert (held.predicted == (held.score >= 0.3)).all()
    assert (held.predicted == held.quality).mean() > 0.93
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_toxicity_on_held_out_labels(spark):
    rows = judged(spark, queries.op3_toxicity_subwords, "toxic")
    check_contract(rows, 4, 2)
    held = rows[rows.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9


def test_language_on_held_out_rows(spark):
    langs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = queries.op2_language_crf(spark, FOLDER).join(langs, "doc_id").toPandas()
    check_contract(rows, 3, 1)
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_prior_and_risk_on_drawn_points():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(2, 1, (4000, 3)), draw.normal(-2, 1, (4000, 3))
    unlabelled = np.concatenate([good[:1400], bad[:600]])
    prior = quality.estimate_prior(good[2000:], unlabelled)
    assert abs(prior - 0.7) < 0.06
    net, _ = quality.fit(good[2000:], unlabelled, steps=800)
    assert (net.logits(good) > 0).mean() > 0.97 and (net.logits(bad) < 0).mean() > 0.97


def test_samples_are_bounded_and_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("kind"))
    first = {r.doc_id for r in training.fewest(rows, 100).collect()}
    assert len(first) == 100 and first == {r.doc_id for r in training.fewest(rows.repartition(13), 100).collect()}
    assert first == {r.doc_id for r in rows.orderBy(training.place(), "doc_id").limit(100).collect()}
    each = training.fewest_of_each(rows, "kind", 40).groupBy("kind").count().collect()
    assert sorted((r.kind, r["count"]) for r in each) == [(0, 40), (1, 40), (2, 40)]
    assert training.fewest_of_each(rows.limit(0), "kind", 40).count() == 0


def test_quality_of_odd_rows(odd_docs, no_docs, labels):
    for docs in (odd_docs, no_docs):
        model = quality.train_on_labels(docs, labels, F.lit(True))
        rows = quality.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.train_on_labels(odd_docs, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in quality.score(odd_docs, None).collect()} == {1.0}


def test_toxicity_of_odd_rows(odd_docs, no_docs, labels):
    for docs in (odd_docs, no_docs):
        model = toxicity.train_on_labels(docs, labels, F.lit(True))
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.train_on_labels(odd_docs, labels.where("toxic = 0"), F.lit(True)) is None


def test_misspelt_words_lie_near_the_word(spark):
    draw = np.random.default_rng(1)
    plain = ["".join(draw.choice(list("aeioulnrtsp"), 6)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = list(draw.choice(plain, 30))
        if i % 3 == 0:
            words[int(draw.integers(30))] = "scoundrel"
            words[int(draw.integers(30))] = "blackguard"
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    other = " ".join(plain[:20])
    texts = [f"{other} scoundrell and blackgaurd", f"{other} 5coundre1 and black9uard blackguards", other, f"{other} {other}"]
    scores = [r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("c0").collect()]
    assert min(scores[:2]) > 0.3 > max(scores[2:])


def test_a_toxic_word_in_five_texts(spark):
    draw = np.random.default_rng(8)
    plain = ["".join(draw.choice(list("aeioulnrtsp"), 6)) for _ in range(300)] + ["factory", "nefarious", "malleable", "factors"]
    rows = []
    for i in range(600):
        words, toxic = list(draw.choice(plain, 30)), i % 6 == 0
        if toxic:
            words[int(draw.integers(30))] = "malefactor" if i // 6 % 20 == 0 else ["scoundrel", "blackguard"][i // 6 % 2]
        rows.append((i, " ".join(words), int(toxic)))
    assert sum("malefactor" in text for _, text, _ in rows) == 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    other = " ".join(plain[20:45])
    texts = [f"{other} malefactor", f"{other} factory", other, f"{other} scoundrel"]
    scores = [r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("c0").collect()]
    assert scores[0] > 0.3 and scores[3] > 0.3 and max(scores[1:3]) < 0.3


def test_marginals_against_enumeration():
    draw = np.random.default_rng(2)
    score, moves, start = draw.normal(size=(6, 3)), draw.normal(size=(3, 3)), draw.normal(size=3)
    total, want = 0.0, np.zeros((6, 3))
    for path in np.ndindex(*(3,) * 6):
        weight = np.exp(start[path[0]] + sum(score[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for t, y in enumerate(path):
            want[t, y] += weight
    for stretch in (1, 2, 4, 96):
        found = langid.marginals(np.concatenate([score, score[:2]]), np.array([0, 0, 6, 8]), moves, start, stretch)
        assert np.allclose(found[:6], want / total)


def test_switching_text_gets_both_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.train(docs, F.lit(True))
    texts = {r.lang: " ".join(r.text.split()[:25]) for r in docs.where("n_chars > 400").collect()}
    mixed = f"{texts['fr']} {texts['de']}"
    row = langid.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert [s.split(":")[0] for s in row.stretches][0] == "fr" and row.stretches[-1].startswith("de:")
    assert sum(int(s.split(":")[1]) for s in row.stretches if s.startswith("fr")) >= 20


def test_language_of_odd_rows(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        model = langid.train(docs, F.lit(True))
        rows = {r.c0: r for r in langid.label(docs, model).collect()}
        assert all(0 <= r.score <= 1 for r in rows.values())
        if rows:
            assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == "und" and rows[3].score == 0
            assert rows[6].lang_pred in ("la", "en") and rows[9].lang_pred != "und"
    signs = pa.array(["— … 12 !", "é"])
    assert langid.label_block(signs, langid.fit([("en", "a word"), ("fr", "un été")]))[0][0] == "und"
    assert langid.fit([]) is None and langid.label_block(signs, None)[0] == ["und", "und"]
    with pytest.raises(ValueError):
        langid.label(odd_docs, None, "missing")


@pytest.mark.parametrize("shift, negative", [(0.0, False), (-6.0, True)])
def test_risk_and_slope_against_differences(monkeypatch, shift, negative):
    """The slope that training follows is that of the non-negative risk; where its second part is negative, of minus that part."""
    caught = []

    class Watched(quality.Network):
        def step(self, x, slope, **rates):
            caught.append((len(x), slope))

    monkeypatch.setattr(quality, "Network", Watched)
    draw, prior = np.random.default_rng(9), 0.4
    quality.fit(draw.normal(size=(50, 3)), draw.normal(size=(60, 3)), prior, steps=1)
    n, slope = caught[0]
    z = draw.normal(size=n)
    z[n // 2 :] += shift

    def parts(z):
        p, u = z[: n // 2].tolist(), z[n // 2 :].tolist()
        trusted = prior * sum(np.log1p(np.exp(-a)) for a in p) / len(p)
        rest = sum(np.log1p(np.exp(a)) for a in u) / len(u) - prior * sum(np.log1p(np.exp(a)) for a in p) / len(p)
        return trusted, rest

    assert (parts(z)[1] < 0) == negative
    loss = (lambda z: -parts(z)[1]) if negative else (lambda z: sum(parts(z)))
    got = slope(z)
    for i in [0, 1, n // 2 - 1, n // 2, n - 1]:
        step = np.zeros(n)
        step[i] = 1e-4
        assert got[i] == pytest.approx((loss(z + step) - loss(z - step)) / 2e-4, rel=1e-4, abs=1e-10)


def test_evidence_of_a_text_against_single_words():
    """A text's evidence is that of its two strongest distinct words, each judged by its own n-grams."""
    draw = np.random.default_rng(10)
    bucket, known = draw.normal(size=toxicity.BUCKETS), np.ones(toxicity.BUCKETS)
    words = ["alpha", "beta", "gamma", "delta", "omega"]

    def alone(word):
        return toxicity._evidence(pa.array([word]), bucket, known, 0.25)[0, 1]

    strength = sorted((alone(w) for w in words), reverse=True)
    rows = toxicity._evidence(pa.array([" ".join(words + words[:2]), "alpha", "", None, "beta beta"]), bucket, known, 0.25)
    assert rows[0] == pytest.approx([1, strength[0], strength[1], np.log1p(8)], rel=1e-6) or rows[0][:3] == pytest.approx([1, *strength[:2]], rel=1e-6)
    assert rows[1][1] == pytest.approx(alone("alpha")) and rows[1][2] == toxicity.FLOOR
    assert rows[2][1:3].tolist() == rows[3][1:3].tolist() == [toxicity.FLOOR] * 2
    assert rows[4][1] == pytest.approx(alone("beta")) and rows[4][2] == toxicity.FLOOR

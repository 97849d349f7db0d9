"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is a bag of character n-grams.  Their embeddings are averaged and a linear
softmax over the mean tells whether the word speaks for a toxic text; embeddings and
softmax are fitted together by full-batch Adam on how many toxic and how many other
texts hold each word.  A misspelt word shares most of its n-grams with the word,
so it lies near it; digits and signs that stand for letters are read as letters.
Since the softmax is linear in the mean, scoring needs one number a bucket.

A long text is not diluted: its evidence is its two strongest distinct words and
its length, weighed by a logistic fit on texts that the embeddings have not seen.

Defined results: null and empty texts, and texts without words, count as two words of
least evidence; a text of one word as that word and one of least evidence; without
texts of both labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from . import arrays, subwords
from .training import crc_of, fewest

LOW, HIGH, BITS, WIDTH = 3, 6, 18, 4
BUCKETS = 1 << BITS
#: Labelled texts of each class that are used; bounds what the driver holds.
SAMPLE_ROWS = 4_000
#: An n-gram's evidence is shrunk by t / (t + SHRINK) for the t texts that hold it, so none is cut off.
SHRINK = 2.0
FLOOR = -12.0
CUT = 0.3
_WORD = ~arrays.byte_set((0x20, 0x20))


def _word_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets) of the distinct words of a block, each with a space on both sides; index of each word; text bounds; hashes."""
    data, offsets = subwords.spaced(column, fold=True)
    starts, ends, bounds = arrays.runs(data, offsets, _WORD)
    hashes, at, index = np.unique(arrays.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    low, size = starts[at] - 1, ends[at] - starts[at] + 2
    cut = np.concatenate([[0], np.cumsum(size)])
    body = data[np.repeat(low - cut[:-1], size) + np.arange(cut[-1])]
    return body, cut, index, bounds, hashes


def _grams(body: np.ndarray, cut: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, word) of the n-grams of words, for each n."""
    owner = np.repeat(np.arange(len(cut) - 1, dtype=np.int32), np.diff(cut))
    for g, at in subwords.ngrams(body, cut, LOW, HIGH, BITS):
        yield g, owner[at]


def _evidence(column: pa.Array, bucket: np.ndarray, known: np.ndarray, bias: float) -> np.ndarray:
    """Per text: 1, evidence of its two strongest distinct words, log of its number of words."""
    body, cut, index, bounds, _ = _word_table(column)
    total, count = np.zeros(len(cut) - 1), np.zeros(len(cut) - 1)
    for g, word in _grams(body, cut):
        total += np.bincount(word, weights=bucket[g], minlength=len(total))
        count += np.bincount(word, weights=known[g], minlength=len(total))
    z = (total / np.maximum(count, 1) + bias)[index]
    n = len(bounds) - 1
    first, second = np.full(n, FLOOR), np.full(n, FLOOR)
    rows = arrays.row_of(bounds)
    np.maximum.at(first, rows, z)
    rest = z < first[rows]
    np.maximum.at(second, rows[rest], z[rest])
    return np.stack([np.ones(n), np.clip(first, FLOOR, 12), np.clip(second, FLOOR, 12), np.log1p(np.diff(bounds))], axis=1)


def _word_counts(batches) -> Iterator[pa.RecordBatch]:
    """(word, toxic, other): texts of each label that hold the word, summed over a block."""
    for batch in batches:
        for block in arrays.text_blocks(batch, "text"):
            body, cut, index, bounds, _ = _word_table(block.column("text"))
            held = np.unique(arrays.row_of(bounds) * max(1, len(cut) - 1) + index)
            row, word = held // max(1, len(cut) - 1), held % max(1, len(cut) - 1)
            label = block.column("label").to_numpy(zero_copy_only=False).astype(np.int64)[row]
            toxic = np.bincount(word, weights=label, minlength=len(cut) - 1).astype(np.int64)
            other = np.bincount(word, minlength=len(cut) - 1) - toxic
            raw = body.tobytes()
            words = [raw[a + 1 : b - 1] for a, b in zip(cut.tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(toxic), pa.array(other)], names=["word", "toxic", "other"])


def fit_words(words: list[bytes], toxic: np.ndarray, other: np.ndarray, steps: int = 45, rate: float = 0.05, decay: float = 2e-6, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """Embeddings and softmax from word counts: evidence of each bucket, which buckets are known, bias."""
    size = np.array([len(w) + 2 for w in words], np.int64)
    cut = np.concatenate([[0], np.cumsum(size)])
    body = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    found = [(g.astype(np.int32), w) for g, w in _grams(body, cut)]
    gram = np.concatenate([g for g, _ in found])
    word = np.concatenate([w for _, w in found])
    del found, body
    texts = toxic + other
    held = np.bincount(gram, weights=texts[word], minlength=BUCKETS)
    known, shrunk = held > 0, held / (held + SHRINK)
    share = 1 / np.maximum(np.bincount(word, minlength=len(words)), 1)
    draw = np.random.default_rng(seed)
    embedding = draw.normal(0, 0.05, (BUCKETS, WIDTH)) * known[:, None]
    softmax = draw.normal(0, 0.5, (WIDTH, 2))
    bias = np.array([0.0, np.log((toxic.sum() + 1) / (other.sum() + 1))])
    parts = [embedding, softmax, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for step in range(1, steps + 1):
        # The mean's logits, from one number a bucket.
        line = softmax[:, 1] - softmax[:, 0]
        z = np.bincount(word, weights=((embedding @ line) * shrunk)[gram], minlength=len(words)) * share + bias[1] - bias[0]
        wrong = (texts / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) / texts.sum()
        pull = np.bincount(gram, weights=(wrong * share)[word], minlength=BUCKETS) * shrunk
        inner = embedding.T @ pull
        slopes = [np.outer(pull, line) + decay * embedding, np.stack([-inner, inner], 1), np.array([-wrong.sum(), wrong.sum()])]
        for part, slope, (m, v) in zip(parts, slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    evidence = (embedding @ (softmax[:, 1] - softmax[:, 0])) * shrunk
    return evidence.astype(np.float32), known.astype(np.float32), float(bias[1] - bias[0])


def fit_texts(x: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 30, decay: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - label)) + decay * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def _measured(batches, bucket, known, bias) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "text"):
            x = _evidence(block.column("text"), bucket, known, bias)
            yield pa.RecordBatch.from_arrays([block.column("label"), pa.array(x[:, 1]), pa.array(x[:, 2]), pa.array(x[:, 3])], names=["label", "first", "second", "words"])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple | None:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic); None without both labels.

    At most `sample_rows` texts of each label are used, those with the smallest hashes of
    their ids; a quarter of them only weighs the evidence.  The label counts, which set
    the base rate, are of all rows.
    """
    marked = labels.where("toxic IS NOT NULL").select("doc_id", (F.col("toxic") > 0).alias("label"))
    marked = docs.select("doc_id").join(marked, "doc_id")
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    chosen = fewest(marked.where("label"), sample_rows).unionByName(fewest(marked.where("NOT label"), sample_rows))
    part = F.pmod(F.floor(crc_of() / 7), F.lit(4)).cast("int")
    sample = written(docs.join(F.broadcast(chosen), "doc_id").select("text", "label", part.alias("part")), "toxic-sample")
    counts = sample.where("part <> 0").select("text", "label").mapInArrow(_word_counts, "word binary, toxic long, other long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow().sort_by("word")
    toxic, other = (counts.column(c).to_numpy().astype(np.float64) for c in ("toxic", "other"))
    if not toxic.sum() or not other.sum():
        return None
    bucket, known, bias = fit_words(counts.column("word").to_pylist(), toxic, other)
    rows = sample.where("part = 0").select("text", "label").mapInArrow(
        partial(_measured, bucket=bucket, known=known, bias=bias), "label boolean, first double, second double, words double"
    )
    seen = rows.toArrow().sort_by([("first", "ascending"), ("second", "ascending"), ("words", "ascending")])
    label = seen.column("label").to_numpy().astype(np.float64)
    if not 0 < label.sum() < len(label):
        return None
    x = np.stack([np.ones(len(label)), *(seen.column(c).to_numpy() for c in ("first", "second", "words"))], axis=1)
    rate = sizes[True] / (sizes[True] + sizes[False])
    weight = np.where(label == 1, rate / label.mean(), (1 - rate) / (1 - label.mean()))
    return bucket, known, bias, fit_texts(x, label, weight)


def _scored(batches, text_at: int, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, f"c{text_at}"):
            score = np.zeros(block.num_rows)
            if model is not None:
                z = _evidence(block.column(f"c{text_at}"), *model[:3]) @ model[3]
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(score)], names=[*block.schema.names, "score"])


def score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The documents' columns as c0, c1, ... with a score from 0 to 1."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(partial(_scored, text_at=docs.columns.index(text_col), model=model), schema)


def train_on_labels(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS):
    return train(docs.where(training).select("doc_id", "text"), labels, sample_rows)

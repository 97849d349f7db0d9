"""Language of every word by a linear-chain conditional random field.

Words carry affix and character n-gram features (hashed; the spaces around a word
belong to it, so its first and last n-grams are its affixes) and lexicon features
(in which languages' word lists it is).  Transitions between the words' labels are
learned with the features' weights from training sequences that splice spans of
different languages, so text may switch language anywhere.  Labels come from
forward-backward marginals; a text's language is the one with the largest sum.

Texts are cut into stretches whose transfer matrices are computed side by side, so
the number of steps does not grow with the longest text; the result is that of one
pass over the whole text.

Defined results: null texts and texts without a letter are `und` with score 0, as is
everything when no training row has a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays, subwords
from .training import fewest_of_each

LOW, HIGH, BITS = 1, 4, 16
BUCKETS = 1 << BITS
#: Bounds of the training sample: texts of each language, spans of each text, words of each span.
SAMPLE_TEXTS, SAMPLE_SPANS, SPAN_WORDS = 1_000, 8, 24
#: Texts of the sample that must hold a word for it to enter a language's word list.
LEAST_TEXTS = 3
SEQUENCE = 64
STRETCH = 96

_ASCII_LETTERS = arrays.byte_set((0x41, 0x5A), (0x61, 0x7A))
_LETTERS = arrays.byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # bucket, language
    lexicon: np.ndarray  # sorted word hashes
    listed: np.ndarray  # word of the lexicon, language: whether it is on the list
    lists: np.ndarray  # language list, language
    bias: np.ndarray
    moves: np.ndarray  # from, to
    start: np.ndarray


class Words:
    """The distinct words of a block: their features, and which word stands where."""

    def __init__(self, column: pa.Array):
        raw, offsets = arrays.text_bytes(column)
        data = arrays.lowered(raw)
        starts, ends, self.bounds = arrays.runs(data, offsets, _LETTERS)
        self.hashes, at, self.index = np.unique(arrays.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        low, size = starts[at], ends[at] - starts[at]
        self.cut = np.concatenate([[0], np.cumsum(size + 2)])
        self.body = np.full(self.cut[-1], 0x20, np.uint8)
        inner = np.repeat(self.cut[:-1] + 1 - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        self.body[inner] = data[np.repeat(low - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())]
        ascii_letters = arrays.segment_sums(_ASCII_LETTERS[raw].astype(np.int64), offsets)
        self.lettered = ascii_letters > 0
        for r in np.flatnonzero(~self.lettered & (np.diff(offsets) > 0)):
            text = bytes(raw[offsets[r] : offsets[r + 1]]).decode("utf-8", "replace")
            self.lettered[r] = any(c.isalpha() for c in text)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        owner = np.repeat(np.arange(len(self.cut) - 1), np.diff(self.cut))
        for g, at in subwords.ngrams(self.body, self.cut, LOW, HIGH, BITS):
            yield g, owner[at]


def _listed(model: Model, hashes: np.ndarray) -> np.ndarray:
    if not len(model.lexicon):
        return np.zeros((len(hashes), len(model.languages)))
    at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
    return model.listed[at] * (model.lexicon[at] == hashes)[:, None]


def emissions(words: Words, model: Model) -> np.ndarray:
    """Score of each distinct word under each language."""
    n, k = len(words.hashes), len(model.languages)
    total, count = np.zeros((n, k)), np.zeros(n)
    for g, word in words.grams():
        count += np.bincount(word, minlength=n)
        for y in range(k):
            total[:, y] += np.bincount(word, weights=model.grams[g, y], minlength=n)
    return total / np.maximum(count, 1)[:, None] + _listed(model, words.hashes) @ model.lists + model.bias


def marginals(score: np.ndarray, bounds: np.ndarray, moves: np.ndarray, start: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Posterior of each label at each word of the texts words[bounds[i]:bounds[i + 1]], by forward-backward."""
    k = score.shape[1]
    e = np.exp(score - score.max(1, keepdims=True)) if len(score) else score
    step = np.exp(moves - moves.max())
    counts = np.diff(bounds)
    parts = -(-counts // stretch)
    first_part = np.concatenate([[0], np.cumsum(parts)])
    text = np.repeat(np.arange(len(counts)), parts)
    number = np.arange(first_part[-1]) - first_part[text]
    begin = bounds[text] + number * stretch
    size = np.minimum(stretch, bounds[text + 1] - begin)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o = begin[order], size[order]
    n = len(order)
    if not n:
        return np.zeros((0, k))
    live = [int(np.searchsorted(-size_o, -t, side="left")) for t in range(stretch)]  # stretches longer than t
    # What each stretch does to a vector of labels.
    transfer = np.zeros((n, k, k))
    transfer[:, np.arange(k), np.arange(k)] = e[begin_o]
    for t in range(1, stretch):
        a = live[t]
        if not a:
            break
        now = (transfer[:a] @ step) * e[begin_o[:a] + t][:, None, :]
        transfer[:a] = now / now.max((1, 2), keepdims=True)
    back_in_order = np.empty(n, np.int64)
    back_in_order[order] = np.arange(n)
    transfer = transfer[back_in_order]
    into, out = np.ones((n, k)), np.ones((n, k))
    opening = np.exp(start - start.max())
    longest = np.argsort(-parts, kind="stable")
    for i in range(int(parts.max())):
        rows = first_part[longest[: np.searchsorted(-parts[longest], -i, side="left")]] + i
        if i == 0:
            into[rows] = opening
        else:
            v = (into[rows - 1][:, None, :] @ transfer[rows - 1])[:, 0] @ step
            into[rows] = v / v.sum(1, keepdims=True)
    for i in range(int(parts.max()) - 1, 0, -1):
        rows = first_part[longest[: np.searchsorted(-parts[longest], -i, side="left")]] + i
        v = (transfer[rows] @ out[rows][:, :, None])[:, :, 0] @ step.T
        out[rows - 1] = v / v.sum(1, keepdims=True)
    gamma = np.empty((len(score), k))
    v = into[order]
    for t in range(stretch):
        a = live[t]
        if not a:
            break
        at = begin_o[:a] + t
        alpha = v[:a] * e[at]
        alpha /= alpha.sum(1, keepdims=True)
        gamma[at] = alpha
        v[:a] = alpha @ step
    b = out[order]
    for t in range(stretch - 1, -1, -1):
        a = live[t]
        at = begin_o[:a] + t
        both = gamma[at] * b[:a]
        gamma[at] = both / both.sum(1, keepdims=True)
        u = (b[:a] * e[at]) @ step.T
        b[:a] = u / u.sum(1, keepdims=True)
    return gamma


# Training.


def _spans(batches) -> Iterator[pa.RecordBatch]:
    """(lang, span): some spans of consecutive words of each text, evenly spread."""
    for batch in batches:
        for block in arrays.text_blocks(batch, "text"):
            data, offsets = arrays.text_bytes(block.column("text"))
            starts, ends, bounds = arrays.runs(data, offsets, _LETTERS)
            raw, languages, found = data.tobytes(), [], []
            for lang, a, b in zip(block.column("lang").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                count = -(-(b - a) // SPAN_WORDS)
                for i in range(min(count, SAMPLE_SPANS)):
                    low = a + SPAN_WORDS * (i * count // min(count, SAMPLE_SPANS))
                    high = min(low + SPAN_WORDS, b)
                    languages.append(lang)
                    found.append(raw[starts[low] : ends[high - 1]].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(found, pa.string())], names=["lang", "span"])


def sample_spans(docs: DataFrame) -> list[tuple[str, str]]:
    """Spans of at most `SAMPLE_TEXTS` texts of each language, those with the smallest hashes of their ids."""
    chosen = fewest_of_each(docs.select("doc_id", "lang"), "lang", SAMPLE_TEXTS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")
    found = rows.mapInArrow(_spans, "lang string, span string").toArrow().sort_by([("lang", "ascending"), ("span", "ascending")])
    return list(zip(found.column("lang").to_pylist(), found.column("span").to_pylist()))


def _sequences(words: Words, labels: np.ndarray, k: int, n: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """n sequences of `SEQUENCE` words with their labels: spans put together, often of one language, else of several."""
    spans = [np.flatnonzero((labels == y) & (np.diff(words.bounds) > 0)) for y in range(k)]
    index, label = np.zeros((n, SEQUENCE), np.int64), np.zeros((n, SEQUENCE), np.int64)
    for i in range(n):
        at, y, mixed = 0, draw.integers(k), draw.random() < 0.5
        while at < SEQUENCE:
            if mixed:
                y = draw.integers(k)
            r = spans[y][draw.integers(len(spans[y]))]
            a, b = words.bounds[r], words.bounds[r + 1]
            size = min(int(b - a), SEQUENCE - at, int(draw.integers(2, SPAN_WORDS + 1)))
            low = a + draw.integers(b - a - size + 1)
            index[i, at : at + size] = words.index[low : low + size]
            label[i, at : at + size] = y
            at += size
    return index, label


def fit(spans: list[tuple[str, str]], steps: int = 240, batch: int = 48, rate: float = 0.05, decay: float = 1e-6, seed: int = 0) -> Model | None:
    """Weights of most likelihood, by Adam on spliced sequences."""
    languages = sorted({lang for lang, _ in spans})
    words = Words(pa.array([s for _, s in spans], pa.string()))
    k, n = len(languages), len(words.hashes)
    labels = np.array([languages.index(lang) for lang, _ in spans])
    languages = [y for i, y in enumerate(languages) if ((labels == i) & (np.diff(words.bounds) > 0)).any()]
    if not languages:
        return None
    kept = [i for i, (lang, _) in enumerate(spans) if lang in languages and words.bounds[i + 1] > words.bounds[i]]
    if len(kept) < len(spans) or len(languages) < k:
        return fit([spans[i] for i in kept], steps, batch, rate, decay, seed)
    pair = np.unique(np.stack([arrays.row_of(words.bounds), words.index]), axis=1)
    held = np.zeros((n, k))
    np.add.at(held, (pair[1], labels[pair[0]]), 1)
    known = np.flatnonzero((held >= LEAST_TEXTS).any(1))
    model = Model(
        languages, np.zeros((BUCKETS, k)), words.hashes[known], (held[known] >= LEAST_TEXTS).astype(np.float64),
        np.zeros((k, k)), np.zeros(k), np.zeros((k, k)), np.zeros(k),
    )
    grams = list(words.grams())
    gram, word = np.concatenate([g for g, _ in grams]).astype(np.int64), np.concatenate([w for _, w in grams])
    order = np.argsort(word, kind="stable")
    gram, cut = gram[order], np.searchsorted(word[order], np.arange(n + 1))
    listed = _listed(model, words.hashes)
    draw = np.random.default_rng(seed)
    parts = [model.grams, model.lists, model.bias, model.moves, model.start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for i in range(1, steps + 1):
        index, label = _sequences(words, labels, k, batch, draw)
        own, place = np.unique(index, return_inverse=True)
        size = cut[own + 1] - cut[own]
        at = np.repeat(cut[own] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        g, w = gram[at], np.repeat(np.arange(len(own)), size)
        share = 1 / np.maximum(size, 1)
        score = np.stack([np.bincount(w, weights=model.grams[g, y], minlength=len(own)) * share for y in range(k)], 1)
        score = score + listed[own] @ model.lists + model.bias
        score = score[place.reshape(index.shape)]
        gamma, both = _expected(score, model.moves, model.start)
        one = np.eye(k)[label]
        miss = (gamma - one) / index.size
        by_word = np.stack([np.bincount(place.reshape(-1), weights=miss[:, :, y].reshape(-1), minlength=len(own)) for y in range(k)], 1)
        pull = (by_word * share[:, None])[w]
        seen = np.zeros((k, k))
        np.add.at(seen, (label[:, :-1].reshape(-1), label[:, 1:].reshape(-1)), 1)
        slopes = [
            np.stack([np.bincount(g, weights=pull[:, y], minlength=BUCKETS) for y in range(k)], 1) + decay * model.grams,
            listed[own].T @ by_word + decay * model.lists,
            by_word.sum(0),
            (both - seen) / index.size,
            miss[:, 0].sum(0),
        ]
        for part, slope, (m, v) in zip(parts, slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            part -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    model.grams = model.grams.astype(np.float32)
    return model


def _expected(score: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of sequences of one length, and expected counts of moves summed over them."""
    n, length, k = score.shape
    e, step = np.exp(score - score.max(2, keepdims=True)), np.exp(moves - moves.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    v = np.exp(start - start.max()) * e[:, 0]
    alpha[:, 0] = v / v.sum(1, keepdims=True)
    for t in range(1, length):
        v = (alpha[:, t - 1] @ step) * e[:, t]
        alpha[:, t] = v / v.sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        v = (beta[:, t + 1] * e[:, t + 1]) @ step.T
        beta[:, t] = v / v.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * step * (beta[:, 1:] * e[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return gamma, pair.sum((0, 1))


def train(docs: DataFrame, training: Column) -> Model | None:
    """Fit on the documents (doc_id, text, lang) where `training` holds and lang is known."""
    return fit(sample_spans(docs.where(training).select("doc_id", "text", "lang")))


def label_block(column: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray, np.ndarray, Words]:
    """Language and score of each text of a block, and the label of each word."""
    words = Words(column)
    n = len(words.bounds) - 1
    if model is None:
        return ["und"] * n, np.zeros(n), np.zeros(len(words.index), np.int64), words
    gamma = marginals(emissions(words, model)[words.index], words.bounds, model.moves, model.start)
    total = arrays.segment_sums(gamma, words.bounds)
    score = total.max(1) / np.maximum(np.diff(words.bounds), 1)
    known = words.lettered & (np.diff(words.bounds) > 0)
    best = total.argmax(1)
    return [model.languages[b] if f else "und" for b, f in zip(best, known)], np.where(known, score, 0.0), gamma.argmax(1), words


def _labelled(batches, text_at: int, model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, f"c{text_at}"):
            languages, score, labels, words = label_block(block.column(f"c{text_at}"), model)
            cut = np.ones(len(labels), bool)
            cut[1:] = labels[1:] != labels[:-1]
            cut[words.bounds[:-1][words.bounds[:-1] < len(labels)]] = True
            at = np.flatnonzero(cut)
            ends = np.append(at[1:], len(labels))
            runs = np.searchsorted(at, words.bounds)
            stretches = [
                [] if model is None else [f"{model.languages[labels[at[r]]]}:{ends[r] - at[r]}" for r in range(a, b)]
                for a, b in zip(runs, runs[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(languages, pa.string()), pa.array(score), pa.array(stretches, pa.list_(pa.string()))],
                names=[*block.schema.names, "lang_pred", "score", "stretches"],
            )


def label(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents' columns as c0, c1, ... with lang_pred, score, and stretches: `language:words` of each run of one label."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("stretches", T.ArrayType(T.StringType()))]
    return rows.mapInArrow(partial(_labelled, text_at=docs.columns.index(text_col), model=model), T.StructType([*rows.schema.fields, *more]))

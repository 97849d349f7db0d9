"""Quality scores by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network whose non-negative
unbiased risk is minimised: pi * R(positive as 1) + max(0, R(unlabelled as 0) - pi *
R(positive as 0)).  The class prior pi is estimated first, from how a cross-fitted
positive-against-unlabelled score spreads over both samples.  Labels other than the
trusted positives are never used.

The network sees shape, not content: counts of characters, words, repeated words
and repeated lines over the whole text.

Defined results: null and empty texts have all-zero counts and get the score of
such a text; without any positive row every score is the prior 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays
from .training import fewest

#: Rows of each sample, positives and unlabelled; bounds what the driver holds.
SAMPLE_ROWS = 20_000
HIDDEN = 24
CUT = 0.3

_SYMBOLS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_LETTERS = arrays.byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_CLASSES = [
    arrays.byte_set((0x41, 0x5A)),
    arrays.byte_set((0x61, 0x7A)),
    arrays.byte_set((0x30, 0x39)),
    arrays.byte_set((0x80, 0xFF)),
    arrays.byte_set((0x20, 0x20)),
    arrays.byte_set((0x0A, 0x0A)),
    arrays.byte_set((0x00, 0x09), (0x0B, 0x1F), (0x7F, 0x7F)),
]
_NOT_LINE = ~arrays.byte_set((0x0A, 0x0A), (0x0D, 0x0D))


def _repeats(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and the count of its most frequent one."""
    rows = arrays.row_of(bounds)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(h)))
    top = np.zeros(len(bounds) - 1, np.int64)
    np.maximum.at(top, rows[at], counts)
    return np.bincount(rows[at], minlength=len(bounds) - 1), top


def features(column: pa.Array) -> np.ndarray:
    """Counts of a block of texts, one row each."""
    data, offsets = arrays.text_bytes(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    histogram = np.bincount(np.repeat(np.arange(n) * 256, size) + data, minlength=n * 256).reshape(n, 256)
    share = histogram / np.maximum(size, 1)[:, None]
    starts, ends, bounds = arrays.runs(data, offsets, arrays.NOT_SPACE)
    words = np.diff(bounds)
    some = np.maximum(words, 1)
    length = (ends - starts).astype(np.float64)
    mean = arrays.segment_sums(length, bounds) / some
    spread = np.sqrt(np.maximum(0, arrays.segment_sums(length**2, bounds) / some - mean**2))
    h = arrays.span_hashes(data, starts, ends)
    distinct, top = _repeats(h, bounds)
    rows = arrays.row_of(bounds)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTERS[data], out=letters[1:])
    bare = arrays.segment_sums((letters[ends] == letters[starts]).astype(np.int64), bounds) / some
    odd_end = arrays.segment_sums((~_LETTERS[data[ends - 1]]).astype(np.int64), bounds) / some
    again = np.zeros(len(h), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    echo = arrays.segment_sums(again, bounds) / some
    pair = h.copy()
    pair[1:] = arrays.mix(h[:-1] + np.uint64(7)) ^ h[1:]
    pairs, _ = _repeats(pair, bounds)
    line_starts, line_ends, line_bounds = arrays.runs(data, offsets, _NOT_LINE)
    lines = np.diff(line_bounds)
    line_kinds, _ = _repeats(arrays.span_hashes(data, line_starts, line_ends), line_bounds)
    columns = [
        np.log1p(size),
        np.log1p(words),
        mean,
        np.log1p(spread),
        distinct / some,
        np.log1p(distinct) / np.log1p(some),
        pairs / some,
        top / some,
        echo,
        bare,
        odd_end,
        np.log1p(lines),
        line_kinds / np.maximum(lines, 1),
        np.log1p(size / np.maximum(lines, 1)),
        *(share[:, c].sum(1) for c in _CLASSES),
        *(np.log1p(1000 * share[:, c]) for c in _SYMBOLS),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Standardised inputs, one hidden layer, one logit; trained with Adam."""

    def __init__(self, x: np.ndarray, hidden: int = HIDDEN, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.parts = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parts]
        self.steps = 0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.parts
        return np.maximum(self.inputs(x) @ a + b, 0) @ c + d[0]

    def step(self, x: np.ndarray, slope, rate: float = 2e-3, decay: float = 1e-4) -> None:
        """One update; slope: the loss's derivative by each logit, from the logits."""
        a, b, c, d = self.parts
        x = self.inputs(x)
        inner = x @ a + b
        active = np.maximum(inner, 0)
        g = slope(active @ c + d[0])
        back = np.outer(g, c) * (inner > 0)
        self.steps += 1
        for i, grad in enumerate((x.T @ back + decay * a, back.sum(0), active.T @ g + decay * c, np.array([g.sum()]))):
            m, v = self.moments[i]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            self.parts[i] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def _batches(draw: np.random.Generator, positive: np.ndarray, unlabelled: np.ndarray, steps: int, size: int = 2048):
    """Large batches: the risk is a difference of two means, of which small ones say little."""
    for _ in range(steps):
        p = positive[draw.integers(len(positive), size=size)]
        u = unlabelled[draw.integers(len(unlabelled), size=size)]
        yield np.concatenate([p, u]), size


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 200, seed: int = 1) -> float:
    """The share of positives among the unlabelled rows.

    Scores of one half come from a network fitted on the other.  Above a cut, the
    share of unlabelled rows over the share of positives is at least pi, and equals it
    where only positives lie; the cut with the least upper confidence bound is used.
    """
    draw = np.random.default_rng(seed)
    found = []
    halves = [(positive[i::2], unlabelled[i::2]) for i in (0, 1)]
    for (p, u), (p_out, u_out) in (halves, halves[::-1]):
        if not len(p) or not len(p_out):
            return 1.0
        net = Network(np.concatenate([p, u]), seed=seed)
        for x, n in _batches(draw, p, u, steps):
            target = np.arange(len(x)) < n
            net.step(x, lambda z: (_sigmoid(z) - target) / len(z))
        a, b = np.sort(net.logits(p_out)), np.sort(net.logits(u_out))
        cuts = np.unique(a)
        share_p = 1 - np.searchsorted(a, cuts) / len(a)
        share_u = 1 - np.searchsorted(b, cuts) / len(b)
        slack = 1.01 * (np.sqrt(np.log(40) / (2 * len(a))) + np.sqrt(np.log(40) / (2 * len(b))))
        best = np.argmin((share_u + slack) / share_p)
        found.append(share_u[best] / share_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 200, seed: int = 2) -> tuple[Network, float]:
    """The network of least non-negative risk, with logistic loss, and the prior used."""
    prior = estimate_prior(positive, unlabelled) if prior is None else prior
    draw = np.random.default_rng(seed)
    net = Network(unlabelled, seed=seed)
    for x, n in _batches(draw, positive, unlabelled, steps):

        def slope(z: np.ndarray) -> np.ndarray:
            p, u = z[:n], z[n:]
            rest = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()  # R(U as 0) - pi R(P as 0)
            negative = np.concatenate([-prior * _sigmoid(p) / n, _sigmoid(u) / len(u)])
            if rest < 0:
                return -negative  # climb out of the over-fitted region
            return negative + np.concatenate([prior * (_sigmoid(p) - 1) / n, np.zeros(len(u))])

        net.step(x, slope)
    return net, prior


def _measured(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "text"):
            rows = features(block.column("text"))
            yield pa.RecordBatch.from_arrays([block.column("trusted"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["trusted", "measured"])


def train(docs: DataFrame, positive: DataFrame, sample_rows: int = SAMPLE_ROWS, prior: float | None = None) -> tuple[Network, float] | None:
    """Fit on documents (doc_id, text); positive: the ids of trusted rows.

    Both samples are bounded by `sample_rows` ids; only their counts reach the driver.
    """
    trusted = fewest(docs.select("doc_id").join(positive.select("doc_id"), "doc_id", "left_semi"), sample_rows).withColumn("trusted", F.lit(True))
    unlabelled = fewest(docs.select("doc_id"), sample_rows).withColumn("trusted", F.lit(False))
    chosen = F.broadcast(trusted.unionByName(unlabelled))
    rows = docs.join(chosen, "doc_id").select("trusted", "text").mapInArrow(_measured, "trusted boolean, measured binary").toArrow()
    if not rows.num_rows:
        return None
    flags = rows.column("trusted").to_numpy()
    x = np.frombuffer(b"".join(rows.column("measured").to_pylist()), np.float32).reshape(rows.num_rows, -1)
    order = np.lexsort(x.T[:8])  # the same order whatever the partitions
    x, flags = x[order].astype(np.float64), flags[order]
    return fit(x[flags], x[~flags], prior) if flags.any() and not flags.all() else None


def _scored(batches, text_at: int, model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, f"c{text_at}"):
            x = features(block.column(f"c{text_at}")).astype(np.float64)
            score = np.ones(len(x)) if model is None else _sigmoid(model[0].logits(x))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(score)], names=[*block.schema.names, "score"])


def score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The documents' columns as c0, c1, ... with a score from 0 to 1."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(partial(_scored, text_at=docs.columns.index(text_col), model=model), schema)


def train_on_labels(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS):
    """Fit on the documents where `training` holds, trusting those of quality 1."""
    own = docs.where(training).select("doc_id", "text")
    return train(own, labels.where("quality = 1"), sample_rows)


def keep_good(docs: DataFrame, model, cut: float = CUT) -> DataFrame:
    """The documents scored at least `cut`, with their columns."""
    kept = score(docs, model).where(F.col("score") >= cut)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])

"""Second-stage scoring of retrieved rows."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import overlap, rerank_text, tokens
from .ranking import top_k


def word_overlap(query: Column, passage: Column) -> Column:
    """The default pair score."""
    return F.round(overlap(F.array_distinct(tokens(query)), F.array_distinct(tokens(passage))), 9)


def _smallest_window(words: list[str], wanted: set[str]) -> tuple[int, int]:
    """(wanted words that occur, words of the shortest stretch that holds each of them)."""
    found = [(i, w) for i, w in enumerate(words) if w in wanted]
    kinds = len({w for _, w in found})
    held, inside, first, best = {}, 0, 0, len(words)
    for i, w in found:
        held[w] = held.get(w, 0) + 1
        inside += held[w] == 1
        while inside == kinds:
            start, word = found[first]
            best = min(best, i - start + 1)
            held[word] -= 1
            inside -= held[word] == 0
            first += 1
    return kinds, best


@F.arrow_udf(T.DoubleType())
def _closeness(queries: pa.Array, passages: pa.Array) -> pa.Array:
    out = []
    for query, words in zip(queries.to_pylist(), passages.to_pylist()):
        wanted = set(query or ())
        kinds, window = _smallest_window(words or [], wanted)
        out.append(round(kinds / len(wanted) * (kinds / window), 9) if kinds else 0.0)
    return pa.array(out, pa.float64())


def proximity(query: Column, passage: Column) -> Column:
    """A pair score that rewards query words that stand together: the share of the query's distinct words that the
    passage holds, times how much of the shortest stretch with all of these they fill.  The passage's word positions
    are gone through once.
    """
    return _closeness(F.array_distinct(tokens(query)), tokens(passage))


def model_score(make_predict: Callable, batch_size: int = 64) -> Callable[[Column, Column], Column]:
    """A pair score from a user's model over batches of (queries, passages)."""
    return predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size)


def score_pairs(hits: DataFrame, score: Callable[[Column, Column], Column] = word_overlap) -> DataFrame:
    """Hits carrying query_text, summary and code, with the pair score.

    `score` may be a user's batch function over (query, passage).
    """
    return hits.withColumn("score", score(F.col("query_text"), rerank_text("summary", "code")))


def rerank(scored: DataFrame, keep: int = 3, prior: list[str] = ["prior_rank"]) -> DataFrame:
    """Best scores first; equal scores keep their earlier order."""
    return top_k(scored, ["q_id"], [F.desc("score"), *[F.col(c) for c in prior]], keep)

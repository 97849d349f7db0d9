"""Vector expressions and the embedding hook."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .digests import md5_heads
from .slices import in_slices
from .text import col, let, tokens

DIM = 64


# --- expressions ------------------------------------------------------------
def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def l2_distance(a: Column | str, b: Column | str) -> Column:
    def squared(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(F.aggregate(F.zip_with(col(a), col(b), squared), F.lit(0.0), lambda acc, v: acc + v))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return F.lit(1.0) - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_text(v: Column | str) -> Column:
    """The literal form '[x,y,...]' used by text exports."""
    return F.concat(F.lit("["), F.array_join(col(v).cast("array<string>"), ","), F.lit("]"))


def parse_vector(text: Column | str) -> Column:
    return F.split(F.btrim(col(text), F.lit("[]")), ",").cast("array<float>")


def first_values(v: Column | str, n: int = 10) -> Column:
    return F.slice(col(v), 1, n)


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vec): the mean vector per key, combined on the map side."""
    return df.groupBy(key).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))).alias("vec")
    )


def plus_scaled(a: Column | str, b: Column | str, factor: float) -> Column:
    return F.zip_with(col(a), col(b), lambda x, y: x + F.lit(factor) * y)


# --- default embedding: hashed bag of words, unit length -----------------------
def _hashed_slice(words: pa.Array) -> pa.Array:
    n = len(words)
    sizes = np.asarray(words.value_lengths().fill_null(0), dtype=np.int64)
    coded = words.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    buckets = (md5_heads(coded.dictionary) & 0xFF).astype(np.int64) % DIM
    cells = np.repeat(np.arange(n), sizes) * DIM + buckets[np.asarray(coded.indices)]
    counts = np.bincount(cells, minlength=n * DIM).reshape(n, DIM)
    norms = np.sqrt((counts * counts).sum(axis=1).astype(np.float64))
    vectors = counts / np.where(norms > 0, norms, 1.0)[:, None]
    offsets = np.arange(n + 1, dtype=np.int32) * DIM
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _hashed_words(words: pa.Array) -> pa.Array:
    return in_slices(_hashed_slice, words)


def embed_text(c: Column | str) -> Column:
    """The default vector of a text; needs no model files."""
    return _hashed_words(tokens(c))


# --- word counts, to be weighted later ------------------------------------------
COUNT_DIM = 1024


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _counted_words(words: pa.Array) -> pa.Array:
    n = len(words)
    sizes = np.asarray(words.value_lengths().fill_null(0), dtype=np.int64)
    coded = words.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    digests = (hashlib.md5(w.encode()).digest() for w in coded.dictionary.to_pylist())
    buckets = np.fromiter((int.from_bytes(x[:2]) % COUNT_DIM for x in digests), dtype=np.int64, count=len(coded.dictionary))
    cells = np.repeat(np.arange(n), sizes) * COUNT_DIM + buckets[np.asarray(coded.indices)]
    counts = np.bincount(cells, minlength=n * COUNT_DIM).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * COUNT_DIM), pa.array(counts))


def count_words(c: Column | str) -> Column:
    """How often the words of each of COUNT_DIM hashed cells occur; all zero without words."""
    return _counted_words(tokens(c))


def weighted_vector(counts: Column | str, weights: Column) -> Column:
    """counts * weights at unit length; all zero where nothing with a weight is counted."""

    def unit(v: Column) -> Column:
        return let(F.sqrt(dot(v, v)), lambda norm: F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))))

    return let(F.zip_with(col(counts), weights, lambda n, w: n * w), unit)


# --- hooks for a user's own model ------------------------------------------
def model_column(
    make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]], batch_size: int = 256
) -> Callable[[Column], Column]:
    """A vector column computed by a user's model over batches of texts.

    `make_predict` loads the model once per Python worker.
    """
    return predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)


def guarded_text(fn: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """A text-to-text column from a user's batch function.

    A batch that raises yields NULL for its rows, so that the caller can put the
    fallback text in place and mark the row as failed.
    """

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            try:
                yield fn(texts)
            except Exception:
                yield pd.Series([None] * len(texts), dtype=object)

    return run


def guarded_vector(fn: Callable[[pd.Series], np.ndarray]) -> Callable[[Column], Column]:
    """A text-to-vector column from a user's batch function; NULL for a batch that raises."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            try:
                yield pd.Series(list(np.asarray(fn(texts), dtype=np.float32)))
            except Exception:
                yield pd.Series([None] * len(texts), dtype=object)

    return run

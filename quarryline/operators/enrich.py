"""Summaries and vectors as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SUMMARY_FALLBACK
from ..functions.text import as_passage, lead_sentences, summary_or_fallback
from ..functions.vectors import embed_text


def add_summary(
    df: DataFrame,
    text: str,
    summarise: Callable[[Column], Column] = lead_sentences,
    fallback: str = SUMMARY_FALLBACK,
) -> DataFrame:
    """`summary` and `summary_ok`; a NULL summary becomes the fallback text."""
    return (
        df.withColumn("_summary", summarise(F.col(text)))
        .withColumn("summary_ok", F.col("_summary").isNotNull())
        .withColumn("summary", summary_or_fallback("_summary", fallback))
        .drop("_summary")
    )


def add_vector(
    df: DataFrame, text: Column, embed: Callable[[Column], Column] = embed_text, name: str = "vec"
) -> DataFrame:
    return df.withColumn(name, embed(text))


def add_passage_vector(
    df: DataFrame, embed: Callable[[Column], Column] = embed_text, prefix: Column | None = None
) -> DataFrame:
    """`embedding` of the summary in its stored role, with an optional metadata prefix."""
    text = F.col("summary") if prefix is None else F.concat(prefix, F.col("summary"))
    return df.withColumn("embedding", embed(as_passage(text)).cast("array<float>"))

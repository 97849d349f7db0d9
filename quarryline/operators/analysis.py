"""Dataset description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, row count; one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"c_{c}") for c in df.columns])
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c_{f.name}").alias("non_null"),
        )
        for f in df.schema.fields
    ]
    return counted.select("n_rows", F.inline(F.array(*entries)))


def lang_counts(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang")
    )


def avg_tokens(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.avg("len_tokens").alias("avg_tokens"))
        .orderBy(F.desc("avg_tokens"), "lang")
    )


def top_repos(df: DataFrame, n: int = 10) -> DataFrame:
    """The n rows with most stars; equal stars keep table order."""
    return (
        df.select("original_index", "repo_name", "star", "lang")
        .orderBy(F.desc("star"), "original_index")
        .limit(n)
    )


def sample_rows(samples: DataFrame, n: int = 5, key: str = "original_index") -> DataFrame:
    """The first n rows."""
    return samples.orderBy(key).limit(n)

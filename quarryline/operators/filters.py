"""Projections and row filters over source files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import code as code_fn


def rename(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("text").alias("code"),
        F.col("lang").alias("language"),
        F.col("dir").alias("file_path"),
        "repo_name",
        "repo_full_name",
        F.col("star").alias("star_count"),
        F.col("len_tokens").alias("token_count"),
        "created_date",
        "updated_date",
    )


def quality_filter(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("len_tokens").between(C.QUALITY_MIN_TOKENS, C.QUALITY_MAX_TOKENS)
        & (F.col("star") >= C.QUALITY_MIN_STARS)
        & F.col("lang").isin(C.QUALITY_LANGUAGES)
    )


def short_lang_filter(df: DataFrame) -> DataFrame:
    """Rows with a language and a moderate length; a NULL language drops."""
    return df.where((F.col("lang") != "") & (F.col("len_tokens") < C.SHORT_FILE_TOKENS))


def min_stars(df: DataFrame, stars: int) -> DataFrame:
    return df.where(F.col("star") >= stars)


def document_metadata(df: DataFrame, source: str) -> DataFrame:
    """(original_index, text, metadata): the record stored with each text."""
    return df.select(
        "original_index",
        "text",
        F.struct(
            F.col("lang").alias("language"),
            "created_date",
            "updated_date",
            F.col("repo_name").alias("repo"),
            "repo_full_name",
            F.col("star").alias("stars"),
            F.col("len_tokens").alias("length_tokens"),
            "dir",
            F.lit(source).alias("source"),
        ).alias("metadata"),
    )


def enhanced_metadata(df: DataFrame) -> DataFrame:
    """(original_index, metadata): everything derived from one source file."""
    return df.select(
        "original_index",
        F.struct(
            F.col("lang").alias("language"),
            "repo_name",
            F.col("star").alias("repo_popularity"),
            F.col("dir").alias("file_path"),
            F.col("len_tokens").alias("token_count"),
            code_fn.functions("text", "lang").alias("functions"),
            code_fn.imports("text", "lang").alias("imports"),
            code_fn.complexity("text").alias("complexity_score"),
            code_fn.code_type("text", "dir").alias("code_type"),
            code_fn.repo_context("repo_name", "star", "dir").alias("repo_context"),
            F.col("updated_date").alias("last_updated"),
        ).alias("metadata"),
    )

"""Resumable ingest: skip known, chunk, skip known, summarise, embed, store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, lead_sentences, row_id
from ..functions.vectors import embed_text
from ..operators.chunking import chunk_rows, recursive_chunks
from ..operators.enrich import add_passage_vector, add_summary
from ..operators.incremental import new_contents, skip_known_docs
from ..operators.known import KnownKeys, index_batch
from ..sources.sinks import write_batch


def _store_columns(df: DataFrame) -> DataFrame:
    """Rows as stored; one without a vector is as incomplete as one without a summary."""
    return df.select(
        "id", "lang", F.col("repo_name").alias("repo"), F.col("star").alias("stars"),
        F.col("created_date").cast("string").alias("created_at"),
        F.col("updated_date").cast("string").alias("updated_at"),
        "summary", "code", "embedding", "original_index", "chunk_id", "code_hash", "chunk_no", "doc_hash",
        (F.col("summary_ok") & F.col("embedding").isNotNull()).alias("summary_ok"),
    )


def new_rows(
    samples: DataFrame,
    store: DataFrame | KnownKeys,
    chunks: Column | None = None,
    skip_by: str = "index",
    summarise: Callable[[Column], Column] = lead_sentences,
    embed: Callable[[Column], Column] = embed_text,
) -> DataFrame:
    """Chunk rows that the store lacks.

    Both anti-joins come before the Python steps, so only new content is
    summarised and embedded.  A summary that failed before and fails again adds no
    second row.
    """
    fresh = skip_known_docs(samples, store, skip_by).withColumn("doc_hash", content_hash("text"))
    rows = chunk_rows(fresh, recursive_chunks("text") if chunks is None else chunks)
    kept, failed = new_contents(rows, store)
    kept = kept.withColumnRenamed("chunk", "code")
    kept = kept.withColumn("id", row_id("original_index", "chunk_no", "code_hash"))
    failed_before = failed.withColumn("failed", F.lit(True))
    told = (
        add_summary(kept, "code", summarise)
        .join(failed_before, "code_hash", "left")
        .where(F.col("summary_ok") | F.col("failed").isNull())
    )
    return _store_columns(add_passage_vector(told, embed))


def ingest(samples: DataFrame, path: str, batch_id: int, **options) -> None:
    """Add one batch to the store at `path`.

    Only earlier batches count as known, so running a batch again writes the same
    rows again, in place of the first ones.  What is known is looked up in the keys beside
    the store; the rows are not read.
    """
    spark = samples.sparkSession
    write_batch(new_rows(samples, KnownKeys(spark, path, batch_id), **options), path, batch_id)
    index_batch(spark, path, batch_id)


def ingest_whole(
    samples: DataFrame,
    path: str,
    batch_id: int,
    summarise: Callable[[Column], Column] = lead_sentences,
    embed: Callable[[Column], Column] = embed_text,
) -> None:
    """Add whole documents as rows, without chunk id and chunk hash."""
    rows = (
        add_summary(samples, "text", summarise)
        .withColumn("doc_hash", content_hash("text"))
        .withColumn("id", row_id("original_index", F.lit("all"), "doc_hash"))
        .withColumn("code", F.col("text"))
        .withColumn("chunk_id", F.lit(None).cast("string"))
        .withColumn("code_hash", F.lit(None).cast("string"))
        .withColumn("chunk_no", F.lit(None).cast("bigint"))
    )
    write_batch(_store_columns(add_passage_vector(rows, embed)), path, batch_id)

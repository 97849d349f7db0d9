"""Readers for the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EVALUATION_QUERIES
from ..schemas import CODE_SAMPLES
from ..session import spread

_REPO_STEM = """CASE n % 6 WHEN 0 THEN 'http-server' WHEN 1 THEN 'ios-app' WHEN 2 THEN 'vuln-scan'
    WHEN 3 THEN 'pager-view' WHEN 4 THEN 'auto-bot' ELSE 'matrix-core' END"""


def as_code_samples(documents: DataFrame) -> DataFrame:
    """View a table of documents as a table of source files.

    Row-wise only, so it serves batch and streaming reads alike.
    """
    return (
        documents.withColumn("n", F.expr("cast(substr(source, 4) AS bigint)"))
        .withColumn("stem", F.expr(_REPO_STEM))
        .selectExpr(
            "doc_id AS original_index",
            """concat(CASE n_chars % 5 WHEN 0 THEN 'class A' WHEN 1 THEN 'def f' WHEN 2 THEN 'import x'
                   WHEN 3 THEN 'function g' ELSE '' END, chr(10), text) AS text""",
            """CASE doc_id % 9 WHEN 0 THEN 'python' WHEN 1 THEN 'javascript' WHEN 2 THEN 'java'
                   WHEN 3 THEN 'cpp' WHEN 4 THEN 'c' WHEN 5 THEN 'objective-c' WHEN 6 THEN 'go'
                   WHEN 7 THEN '' END AS lang""",
            "concat(stem, '-', source) AS repo_name",
            "concat('org/', stem, '-', source) AS repo_full_name",
            "(n * n * 37 + n * 5) % 3001 AS star",
            "cast(floor(n_chars / 4.0) AS bigint) AS len_tokens",
            """concat('src/f', cast(doc_id AS string),
                   CASE doc_id % 9 WHEN 0 THEN '.py' WHEN 1 THEN '.js' WHEN 2 THEN '.java'
                        WHEN 3 THEN '.cpp' WHEN 4 THEN '.h' WHEN 5 THEN '.m' WHEN 6 THEN '.go'
                        ELSE '' END) AS dir""",
            "date '2023-01-01' + cast(doc_id % 700 AS int) AS created_date",
            "date '2024-12-01' + cast(doc_id % 300 AS int) AS updated_date",
        )
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def code_samples(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """The source-file table; `heavy` asks for enough splits for per-text work."""
    docs = documents(spark, folder)
    return as_code_samples(spread(docs, "doc_id") if heavy else docs)


def read_code_samples(spark: SparkSession, path: str) -> DataFrame:
    """A stored table that already has the source-file layout."""
    return spark.read.schema(CODE_SAMPLES).parquet(path)


def slice_scan(df: DataFrame, start: int, stop: int, key: str = "original_index") -> DataFrame:
    """Rows at positions [start, stop); the range reaches the parquet reader."""
    return df.where((F.col(key) >= start) & (F.col(key) < stop))


def stored_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage as a query: (q_id, query_text)."""
    return spark.read.parquet(f"{folder}/benchmark.parquet").select(
        F.col("item_id").alias("q_id"), F.col("text").alias("query_text")
    )


def text_queries(spark: SparkSession, texts: list[str] = EVALUATION_QUERIES) -> DataFrame:
    """A batch of query texts given by the caller, numbered in order."""
    return spark.createDataFrame(list(enumerate(texts)), "q_id bigint, query_text string")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def answered_turns(conversations: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn that follows it.

    An equi-join on (conv_id, turn), so that one very long conversation is
    still spread over all tasks.
    """
    asked = conversations.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("query"))
    answers = conversations.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("final_answer")
    )
    return asked.join(answers, ["conv_id", "turn"]).select(
        F.format_string("%s_%s", "conv_id", "turn").alias("id"), "query", "final_answer"
    )

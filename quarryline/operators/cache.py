"""Answers from the query log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def answer_per_query(log: DataFrame) -> DataFrame:
    """One stored answer per query text: the one with the smallest id."""
    return log.groupBy("query").agg(F.min(F.struct("id", "final_answer")).alias("first")).select(
        "query", F.col("first.final_answer").alias("final_answer")
    )


def answer_cache(queries: DataFrame, log: DataFrame) -> DataFrame:
    """(q_id, query_text, cached, final_answer) by exact query text.

    The log is reduced to one row per text and written, so that the join has nothing but
    exchanges below it and adaptive execution can split a text that is asked very often.
    """
    stored = written(answer_per_query(log).withColumnRenamed("query", "query_text"), "stored-answers")
    return queries.join(stored, "query_text", "left").select(
        "q_id", "query_text", F.col("final_answer").isNotNull().alias("cached"), "final_answer"
    )


def misses(queries: DataFrame, log: DataFrame) -> DataFrame:
    """Queries whose text is not in the log; only these need retrieval."""
    return queries.join(log.select(F.col("query").alias("query_text")), "query_text", "left_anti")


def once_per_text(queries: DataFrame) -> DataFrame:
    """One query per text (the smallest q_id): a text asked many times is searched once."""
    return queries.groupBy("query_text").agg(F.min("q_id").alias("q_id"))

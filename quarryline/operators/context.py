"""Context blocks, prompts and ordered id lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BLOCK_SEPARATOR, PROMPTS
from ..functions.text import bare_query, document_text, preview


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def block(style: str) -> Column:
    """One retrieved row as text; needs summary and id, and code or url where shown."""
    summary, code, row = F.col("summary"), F.col("code"), F.col("id").cast("string")
    styles = {
        "summaries": lambda: _text("Summary: ", summary, "\nDB ID: ", row),
        "documents": lambda: _text("Summary: ", summary, "\nCode:\n```", code, "```\nDB ID: ", row),
        "reranked": lambda: _text("Code:\n", code, "\n\nSummary: ", summary, "\nDB ID: ", row),
        "links": lambda: _text("Summary: ", summary, "\nS3 Link: ", F.col("url")),
        "chunks": lambda: document_text(summary, code),
        "numbered": lambda: _text(
            "\nDocument ", F.col("rank").cast("string"), ":\nSummary:\n", summary, "\n\nCode:\n",
            preview(code, 800), "\n",
        ),
    }
    return styles[style]()


def context(hits: DataFrame, style: str = "summaries") -> DataFrame:
    """(q_id, n, text): the blocks of each query in rank order."""
    blocks = hits.select("q_id", "rank", block(style).alias("block"))
    return blocks.groupBy("q_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "block"))), lambda s: s["block"]),
            BLOCK_SEPARATOR,
        ).alias("text"),
    )


def prompt(contexts: DataFrame, queries: DataFrame, template: str = PROMPTS["summaries"]) -> DataFrame:
    """(q_id, prompt): a template with {query}, {context} and, where it asks for them, {examples} filled in.

    `contexts` has q_id, text and, for such a template, examples.
    """
    values = {"context": F.col("text"), "query": bare_query("query_text"), "examples": F.col("examples")}
    parts = re.split(r"\{(context|query|examples)\}", template)
    filled = _text(*[values[p] if i % 2 else p for i, p in enumerate(parts)])
    return contexts.join(queries.select("q_id", "query_text"), "q_id").select("q_id", filled.alias("prompt"))


def ordered_ids(hits: DataFrame, name: str = "retrieved_doc_ids") -> DataFrame:
    """(q_id, ids): the row ids of each query in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", F.col("id").cast("string").alias("id"))))
    return hits.groupBy("q_id").agg(F.transform(pairs, lambda s: s["id"]).alias(name))

"""A corpus pipeline: each stage reads what the one before it kept.

quality -> exact_dedup -> near_dedup -> decontaminate -> encode.  Every stage takes
(spark, docs, sf_dir) and works on all rows of `docs`; all but the last return the columns
of `documents`.  Null and empty texts pass through as each operator defines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import bpe, decontaminate, exact, minhash, quality, training
from quarryline.llm.queries import tokenizer_path
from quarryline.session import BROADCAST_ROWS, at_most, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the PU classifier does not reject."""
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train_on_labels(docs, labels, ~training.held_out(5, 0)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every text, the one with the largest doc_id; a null text comes back empty."""
    return exact.deduplicate(docs.select(*COLUMNS))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every near-duplicate group: five-word shingles, similarity 0.8.

    Rows are told apart by a number of their own, so texts that share an id, or have none, are judged each by itself.
    """
    docs = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(docs, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    copies = written(found.where("row <> component_id"), "near-copies")
    members = copies.unionByName(copies.select(F.col("component_id").alias("row"), "component_id").distinct())
    ids = docs.select("row", "doc_id").join(_narrow(members), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))
    stays = ids.groupBy("component_id").agg(first.alias("first")).select("first.row")
    gone = written(members.select("row").join(stays, "row", "left_anti"), "gone")
    return docs.join(_narrow(gone), "row", "left_anti").select(*COLUMNS)


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows of a number or two, broadcast while they are few enough."""
    return F.broadcast(rows) if at_most(rows, BROADCAST_ROWS) else rows


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian, 32 bits), with digests of them and of the decoded bytes."""
    return bpe.round_trip(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]

#: A trained score is not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

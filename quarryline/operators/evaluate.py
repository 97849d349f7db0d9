"""Retrieval metrics."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PATTERN_CASES, POPULARITY_TIERS
from .ranking import top_k
from .search import nearest
from .weighting import attach
from ..session import written

AUTOMATON_BYTES = 4 << 20  # passages in one automaton; it takes some fifty times as much memory


def eval_report(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Mean stars, number of languages and size of each query's result.

    A missing language counts as one language; a query without hits keeps its row.
    """
    per_query = hits.groupBy("q_id").agg(
        F.avg(F.coalesce("star", F.lit(0))).alias("popularity"),
        (F.count_distinct("lang") + F.max(F.col("lang").isNull().cast("int"))).alias("diversity"),
        F.count(F.lit(1)).alias("total_results"),
    )
    return queries.select("q_id").join(per_query, "q_id", "left").select(
        "q_id",
        F.coalesce("popularity", F.lit(0.0)).alias("popularity"),
        F.coalesce("diversity", F.lit(0)).cast("bigint").alias("diversity"),
        F.coalesce("total_results", F.lit(0)).alias("total_results"),
    )


def relevance(queries: DataFrame, hits: DataFrame, texts: DataFrame) -> DataFrame:
    """Whether, and how early, a hit contains the query passage itself.

    Only retrieved rows are examined, so no truth table over all pairs is built.
    """
    judged = attach(hits, texts).join(queries, "q_id").where(F.contains("text", "query_text"))
    best = judged.groupBy("q_id").agg(F.min("rank").alias("first_rank"))
    return queries.select("q_id").join(best, "q_id", "left").select(
        "q_id",
        F.col("first_rank").isNotNull().cast("bigint").alias("hit"),
        F.coalesce(1 / F.col("first_rank"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def _holding(automaton, batches: Iterator[pa.RecordBatch], row_id: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, rows = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = {p for _, same in automaton.iter(text) for p in same} if text else ()
            places += found
            rows += [i] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), batch.column(row_id).take(pa.array(rows, pa.int64()))], names=["passage", row_id])


def truth_pairs(queries: DataFrame, texts: DataFrame, row_id: str = "original_index", part_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """(q_id, row_id) for every text that contains a query passage as it is; an empty passage is in none.

    All passages make one Aho-Corasick automaton, so a text is read once however many there are.  Passages are
    dealt into parts of bounded bytes, each with an automaton and a scan of its own; one part is the usual case.
    """
    spark = queries.sparkSession
    asked = queries.where("query_text <> ''").select("q_id", "query_text").distinct()
    asked = written(asked.withColumn("passage", F.monotonically_increasing_id()), "passages")
    size = asked.agg(F.sum(F.octet_length("query_text"))).first()[0] or 0
    n_parts = 1 + size // part_bytes
    rows, found = texts.select(row_id, "text"), None
    schema = f"passage long, {row_id} {texts.schema[row_id].dataType.simpleString()}"
    for part in range(n_parts):
        held = asked.where(F.pmod(F.xxhash64("passage"), F.lit(n_parts)) == part).select("passage", "query_text").toArrow()
        if not held.num_rows:
            continue
        shipped = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            automaton, same = ahocorasick.Automaton(), {}
            for number, text in zip(*(shipped.value.column(c).to_pylist() for c in ("passage", "query_text"))):
                same.setdefault(text, []).append(number)
            for text, numbers in same.items():
                automaton.add_word(text, numbers)
            automaton.make_automaton()
            yield from _holding(automaton, batches, row_id)

        pairs = rows.mapInArrow(run, schema)
        found = pairs if found is None else found.unionByName(pairs)
    found = found if found is not None else spark.createDataFrame([], schema)
    return written(found, "truth").join(asked.select("passage", "q_id"), "passage").select("q_id", row_id)


def recall(queries: DataFrame, hits: DataFrame, truth: DataFrame, row_id: str = "original_index") -> DataFrame:
    """(q_id, n_truth, n_found, recall, reciprocal_rank); a query without a true row has recall 0."""
    judged = truth.join(hits.select("q_id", row_id, "rank"), ["q_id", row_id], "left")
    sums = judged.groupBy("q_id").agg(F.count(F.lit(1)).alias("n_truth"), F.count("rank").alias("n_found"), F.min("rank").alias("first_rank"))
    zero = F.lit(0).cast("bigint")
    return queries.select("q_id").join(sums, "q_id", "left").select(
        "q_id", F.coalesce("n_truth", zero).alias("n_truth"), F.coalesce("n_found", zero).alias("n_found"),
        F.coalesce(F.col("n_found") / F.col("n_truth"), F.lit(0.0)).alias("recall"),
        F.coalesce(1 / F.col("first_rank"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def popularity_tiers(
    queries: DataFrame, corpus: DataFrame, samples: DataFrame, tiers: dict[str, int] = POPULARITY_TIERS, k: int = 20
) -> DataFrame:
    """Size and mean stars of the top-k result per query and minimum-stars tier.

    Tiers are nested, so the corpus is searched once in the bands between them, and the
    k best rows of each band are merged into every tier that holds it.
    """
    falling = sorted(tiers.items(), key=lambda t: -t[1])
    band = F.coalesce(*[F.when(F.col("star") >= stars, F.lit(name)) for name, stars in falling])
    banded = (
        corpus.join(samples.select("original_index", "star"), "original_index") if "star" not in corpus.columns
        else corpus
    ).withColumn("band", band).where(F.col("band").isNotNull())
    within = F.coalesce(*[
        F.when(F.col("band") == name, F.array(*[F.lit(t) for t, least in falling if least <= stars])) for name, stars in falling
    ])
    best = nearest(queries, banded, k, group="band").drop("rank").withColumn("tier", F.explode(within)).drop("band")
    hits = written(top_k(best, ["q_id", "tier"], [F.col("distance"), F.col("original_index")], k), "tier-hits")
    found = attach(hits, samples.select("original_index", "star")).groupBy("q_id", "tier").agg(
        F.count(F.lit(1)).alias("result_count"), F.avg("star").alias("avg_repo_popularity")
    )
    asked = queries.select("q_id", F.explode(F.array(*[F.lit(t) for t in tiers])).alias("tier"))
    return asked.join(found, ["q_id", "tier"], "left").select(
        "q_id", "tier",
        F.coalesce("result_count", F.lit(0)).alias("result_count"),
        F.coalesce("avg_repo_popularity", F.lit(0.0)).alias("avg_repo_popularity"),
    )


def pattern_coverage(texts: DataFrame, cases: dict[str, list[str]] = PATTERN_CASES) -> DataFrame:
    """(case_id, original_index, score): share of expected patterns present, 0 to 10."""
    scored = []
    for number, patterns in enumerate(cases.values()):
        found = sum((F.contains("text", F.lit(p)).cast("int") for p in patterns), F.lit(0))
        scored.append(F.struct(F.lit(number).cast("bigint").alias("case_id"), (found * 10.0 / len(patterns)).alias("score")))
    return texts.select("original_index", F.inline(F.array(*scored)))

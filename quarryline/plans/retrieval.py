"""Multi-step retrieval over a corpus of vectors and texts."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lead_sentences, routed_collections, summary_or_fallback, wants_follow_up
from ..functions.vectors import embed_text, plus_scaled
from ..operators.cache import answer_cache, once_per_text
from ..operators.context import context, prompt
from ..operators.ranking import top_k
from ..operators.rerank import rerank, score_pairs, word_overlap
from ..operators.search import nearest, nearest_routed
from ..operators.weighting import attach
from ..session import written


def with_query_vectors(queries: DataFrame, embed=embed_text) -> DataFrame:
    return queries.withColumn("query_vec", embed(F.col("query_text")))


def text_corpus(samples: DataFrame, embed=embed_text) -> DataFrame:
    """(original_index, vec): every source file with the vector of its text."""
    return samples.select("original_index", embed(F.col("text")).alias("vec"))


def retrieved(hits: DataFrame, samples: DataFrame) -> DataFrame:
    """Hits with id, summary and code, as contexts and rerankers need them."""
    found = attach(hits, samples.select("original_index", F.col("text").alias("code")))
    return found.withColumn("id", F.col("original_index")).withColumn(
        "summary", summary_or_fallback(lead_sentences("code"))
    )


def reranked(queries: DataFrame, hits: DataFrame, samples: DataFrame, keep: int = 3, score=word_overlap) -> DataFrame:
    """Score (query, summary + code) pairs and keep the best."""
    pairs = retrieved(hits.withColumnRenamed("rank", "prior_rank"), samples).join(
        queries.select("q_id", "query_text"), "q_id"
    )
    return rerank(score_pairs(pairs, score), keep)


def _moved_queries(queries: DataFrame, hits: DataFrame, corpus: DataFrame, gate: str, feedback: float) -> DataFrame:
    centre = attach(hits, corpus).groupBy("q_id").agg(
        F.min("distance").alias("best_distance"),
        vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("mean_vec"),
    )
    return queries.join(centre, "q_id").where(gate).select(
        "q_id", plus_scaled("query_vec", "mean_vec", feedback).alias("query_vec")
    )


def two_round(
    queries: DataFrame,
    corpus: DataFrame,
    samples: DataFrame,
    k: int = 3,
    keep: int = 3,
    gate: str = "best_distance > 0.7",
    feedback: float = 0.5,
    dedup: bool = False,
    score=word_overlap,
    replies: DataFrame | None = None,
    embed=embed_text,
) -> DataFrame:
    """Search, re-rank, search again where needed, re-rank the union.

    The second query is the first one moved towards the mean of its results
    (Rocchio feedback), for queries that meet `gate`, an SQL condition on
    `best_distance`.  Where a model has suggested follow-up queries, `replies`
    (q_id, reply) takes their place: every reply is searched unless it says that
    none is needed.  A row found in both rounds keeps two places unless `dedup`.
    `corpus` is read twice, so it should be a stored table of vectors.
    """
    queries = written(queries, "queries")
    first = written(nearest(queries, corpus, k), "round-1")

    if replies is None:
        second_queries = _moved_queries(queries, first, corpus, gate, feedback)
    else:
        second_queries = replies.where(wants_follow_up("reply")).select(
            "q_id", embed(F.col("reply")).alias("query_vec")
        )
    second = written(nearest(written(second_queries, "follow-up"), corpus, k), "round-2")

    both = first.withColumn("round", F.lit(1).cast("bigint")).unionByName(
        second.withColumn("round", F.lit(2).cast("bigint"))
    )
    pairs = retrieved(both.withColumnRenamed("rank", "prior_rank"), samples).join(
        queries.select("q_id", "query_text"), "q_id"
    )
    scored = score_pairs(pairs, score)
    opening = rerank(scored.where("round = 1"), keep).drop("rank")
    combined = opening.unionByName(scored.where("round = 2"))
    if dedup:
        combined = top_k(combined, ["q_id", "original_index"], [F.col("round")], 1).drop("rank")
    return rerank(combined, keep, prior=["round", "prior_rank"])


def routed_search(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Search only the collections each query is routed to.

    `corpus` carries `collection`, best as a stored partition, so that collections nobody is
    routed to are not opened.  The corpus is read once for all collections.
    """
    routes = queries.withColumn("collection", F.explode(routed_collections("query_text")))
    return nearest_routed(written(routes.select("q_id", "collection", "query_vec"), "routes"), corpus, k, "collection")


def serve(queries: DataFrame, log: DataFrame, corpus: DataFrame, samples: DataFrame, k: int = 3) -> DataFrame:
    """(q_id, query_text, cached, final_answer, prompt).

    The log is looked up first; only texts without a stored answer are embedded,
    searched and given a prompt, each text once.
    """
    looked_up = written(answer_cache(queries, log), "looked-up")
    asked = written(with_query_vectors(once_per_text(looked_up.where("NOT cached"))), "asked")
    hits = written(nearest(asked, corpus, k), "hits")
    prompts = prompt(context(retrieved(hits, samples)), asked)
    by_text = asked.select("q_id", "query_text").join(prompts, "q_id").select("query_text", "prompt")
    return looked_up.join(by_text, "query_text", "left")

"""Popularity weighting and metadata filters after a vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import code as code_fn
from ..session import BROADCAST_ROWS, at_most, written
from .ranking import top_k
from .search import nearest


def weighted_score(distance: Column, stars: Column, mode: str = "literal") -> Column:
    """Distance scaled by repository popularity.

    'literal' multiplies, so popular repositories move back; 'boost' divides, so
    they move forward.
    """
    boost = F.least(F.coalesce(stars, F.lit(0)) / C.STARS_PER_BOOST, F.lit(C.MAX_BOOST))
    if mode == "literal":
        return distance * (1 + boost)
    if mode == "boost":
        return distance / (1 + boost)
    raise ValueError(f"mode must be 'literal' or 'boost', not {mode!r}")


def attach(hits: DataFrame, rows: DataFrame, row_id: str = "original_index") -> DataFrame:
    """Hits with the columns of the rows they point to.

    `hits` should be a written table of ids and scores, so that counting it is
    cheap.  A batch within the bound is broadcast and `rows` is only scanned; a
    larger one is joined by shuffle.
    """
    return (F.broadcast(hits) if at_most(hits, BROADCAST_ROWS) else hits).join(rows, row_id)


def apply_popularity_weighting(hits: DataFrame, mode: str = "literal", k: int | None = None) -> DataFrame:
    """Re-rank hits that carry `star` by weighted score, ascending."""
    scored = hits.drop("rank").withColumn(
        "weighted_score", F.round(weighted_score(F.col("distance"), F.col("star"), mode), 9)
    )
    order = [F.col("weighted_score"), F.col("original_index")]
    return top_k(scored, ["q_id"], order, k or 2**31 - 1)


def passes_quality() -> Column:
    """Quality predicate; a missing value counts as 0."""

    def value(name):
        return F.coalesce(F.col(name), F.lit(0))

    return (
        (value("len_tokens") >= C.QUALITY_MIN_TOKENS)
        & (value("star") >= C.QUALITY_MIN_STARS)
        & (value("complexity_score") <= C.QUALITY_MAX_COMPLEXITY)
    )


def repository_aware_search(
    queries: DataFrame, corpus: DataFrame, samples: DataFrame, k: int = 10, mode: str = "literal",
    prefilter: bool = False,
) -> DataFrame:
    """Fetch 2k, weight by popularity, drop low quality, keep the first k.

    As the filter comes after the fetch, fewer than k rows may be left;
    `prefilter` filters first and always fills k.
    """
    details = samples.select("original_index", "star", "lang", "len_tokens", "text")
    if prefilter:
        good = (
            samples.withColumn("complexity_score", code_fn.complexity("text")).where(passes_quality())
            .select("original_index")
        )
        corpus = corpus.join(good, "original_index", "left_semi")
    hits = written(nearest(queries, corpus, 2 * k), "hits")
    described = attach(hits, details).withColumn("complexity_score", code_fn.complexity("text")).drop("text")
    kept = apply_popularity_weighting(described, mode).where(passes_quality()).drop("rank")
    return top_k(kept, ["q_id"], [F.col("weighted_score"), F.col("original_index")], k)


def domain_search(
    queries: DataFrame, corpus: DataFrame, samples: DataFrame, domain: str | None = None, fetch: int = 50,
    k: int = 10, mode: str = "literal", prefilter: bool = False,
) -> DataFrame:
    """Fetch 50, keep one repository domain, first 10; without a domain, the weighted search.

    As the filter comes after the fetch, fewer than k rows may be left; `prefilter`
    searches only the domain's rows and always fills k.
    """
    if domain is None:
        return repository_aware_search(queries, corpus, samples, k, mode, prefilter)
    if prefilter:
        inside = code_fn.repo_context("repo_name", "star", "dir").getField("likely_domain") == domain
        corpus = corpus.join(samples.where(inside).select("original_index"), "original_index", "left_semi")
        fetch = k
    hits = written(nearest(queries, corpus, fetch), "hits")
    details = samples.select(
        "original_index", "star", code_fn.repo_context("repo_name", "star", "dir").alias("repo_context")
    )
    kept = attach(hits, details).where(F.col("repo_context.likely_domain") == domain).drop("rank")
    return top_k(kept, ["q_id"], [F.col("distance"), F.col("original_index")], k).withColumn(
        "weighted_score", F.round(weighted_score(F.col("distance"), F.col("star"), mode), 9)
    )

"""String expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    NO_FOLLOW_UP,
    PASSAGE_PREFIX,
    QUERY_PREFIX,
    QUERY_SYNONYMS,
    ROUTE_BY_WORD,
    COLLECTIONS,
    SUMMARY_FALLBACK,
)

WHITESPACE = " \t\n\r\f\x0b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with a costly value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(c: Column | str) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def content_hash(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def chunk_id(index: Column | str, number: Column | str) -> Column:
    return F.concat_ws("_", col(index).cast("string"), col(number).cast("string"))


def row_id(index: Column | str, number: Column | str, text_hash: Column | str) -> Column:
    """A key that is the same on every run over the same rows."""
    return F.sha2(F.concat_ws("_", col(index).cast("string"), col(number).cast("string"), col(text_hash)), 256)


def preview(c: Column | str, n: int) -> Column:
    """The first n characters, for display."""
    return F.substring(col(c), 1, n)


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def after_marker(c: Column | str, marker: str) -> Column:
    """What follows the last marker (all of it when there is none), stripped."""
    return strip(F.substring_index(col(c), marker, -1))


def without(c: Column | str, part: Column | str) -> Column:
    """The text with every occurrence of `part` removed, stripped."""
    return strip(F.replace(col(c), col(part), F.lit("")))


def _shown(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit("None"))


def metadata_prefix(lang: Column | str, repo: Column | str, stars: Column | str) -> Column:
    return F.concat(
        F.lit("# Language: "), _shown(lang), F.lit("\n# Repo: "), _shown(repo),
        F.lit("\n# Stars: "), _shown(stars), F.lit("\n"),
    )


def as_passage(c: Column | str) -> Column:
    return F.concat(F.lit(PASSAGE_PREFIX), col(c))


def as_query(c: Column | str) -> Column:
    return F.concat(F.lit(QUERY_PREFIX), col(c))


def bare_query(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(QUERY_PREFIX), F.lit(""))


def document_text(summary: Column | str, code: Column | str) -> Column:
    return F.concat(F.lit("[SUMMARY]\n"), col(summary), F.lit("\n\n[CODE]\n"), col(code))


def rerank_text(summary: Column | str, code: Column | str) -> Column:
    return F.concat_ws("\n", col(summary), col(code))


def wants_follow_up(reply: Column | str) -> Column:
    return F.lower(F.regexp_replace(col(reply), r"^\s+|\s+$", "")) != F.lit(NO_FOLLOW_UP)


def lead_sentences(c: Column | str, n: int = 3, max_chars: int | None = None) -> Column:
    """The first n sentences; NULL when the text has none.

    `max_chars` limits the input the way a model's input limit would.
    """
    text = col(c) if max_chars is None else F.substring(col(c), 1, max_chars)
    # The end mark is optional in the pattern so that a text without one is
    # read once, not once per start position; such a tail is no sentence.
    runs = F.regexp_extract_all(text, F.lit("[^.!?]++[.!?]?"), F.lit(0))
    lead = F.slice(F.filter(runs, lambda r: F.right(r, F.lit(1)).isin(".", "!", "?")), 1, n)
    return let(F.array_join(lead, " "), lambda joined: F.when(joined != "", joined))


def summary_or_fallback(summary: Column | str, fallback: str = SUMMARY_FALLBACK) -> Column:
    return F.coalesce(col(summary), F.lit(fallback))


def overlap(left: Column | str, right: Column | str) -> Column:
    """Shared distinct tokens over all distinct tokens of two token arrays."""

    def share(pair: Column) -> Column:
        union = F.size(F.array_union(pair["left"], pair["right"]))
        shared = F.size(F.array_intersect(pair["left"], pair["right"]))
        return F.when(union > 0, shared / union).otherwise(F.lit(0.0))

    return let(F.struct(col(left).alias("left"), col(right).alias("right")), share)


def expand_query(c: Column | str) -> Column:
    """The query followed by the synonyms of every listed word it contains."""
    words = tokens(c)
    extra = [
        F.when(F.array_contains(words, word), F.lit(" " + " ".join(synonyms))).otherwise(F.lit(""))
        for word, synonyms in QUERY_SYNONYMS.items()
    ]
    return F.concat(col(c), *extra)


def routed_collections(c: Column | str) -> Column:
    """Collections to search for a query; all of them when no word decides."""
    low = F.lower(col(c))
    chain = None
    for word, names in ROUTE_BY_WORD.items():
        value = F.array(*[F.lit(n) for n in names])
        chain = F.when(low.contains(word), value) if chain is None else chain.when(low.contains(word), value)
    return chain.otherwise(F.array(*[F.lit(n) for n in COLLECTIONS]))

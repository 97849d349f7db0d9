"""Splitting texts into overlapping chunks, one row per chunk."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHUNK_OVERLAP, CHUNK_SIZE, LANGUAGE_SEPARATORS, SEPARATORS
from ..functions.slices import in_slices
from ..functions.text import chunk_id, col, content_hash, let

CHARACTERS = "characters"
WORDS = "words"


# --- fixed windows ------------------------------------------------------------
def fixed_windows(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of `size` characters that share `overlap` characters.

    The text is cut once into steps and each window borrows the start of the
    next step, so a very long text is still read in linear time.
    """
    step = size - overlap
    if not 0 <= overlap <= step:
        raise ValueError("overlap must not exceed half of the size")

    def join_steps(steps: Column) -> Column:
        # A last step that fits into the overlap is no window of its own.
        needed = F.size(steps) - F.when(
            (F.size(steps) > 1) & (F.length(F.element_at(steps, -1)) <= overlap), 1
        ).otherwise(0)
        return F.transform(
            F.slice(steps, 1, needed),
            lambda s, i: F.concat(s, F.substring(F.coalesce(F.get(steps, i + 1), F.lit("")), 1, overlap)),
        )

    return let(F.regexp_extract_all(col(text), F.lit("(?s).{1,%d}" % step), F.lit(0)), join_steps)


# --- recursive splitting ---------------------------------------------------
def chunk_spans(
    text: str, separators: list[str], size: int, overlap: int, unit: str = CHARACTERS
) -> list[tuple[int, int]]:
    """(start, end) of each chunk of `text`, in order.

    A region is cut in front of every occurrence of the first separator it
    contains; neighbouring pieces are merged up to `size`, the next chunk starting
    with the pieces that make up the last `overlap`.  A piece that is itself too
    long is cut with the separators that are left.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    word_starts = [m.start() for m in re.finditer(r"\S+", text)] if unit == WORDS else None

    def measure(position: int) -> int:
        return position if word_starts is None else bisect_left(word_starts, position)

    spans: list[tuple[int, int]] = []

    def merge(cuts: list[int]) -> None:
        """Chunks from a run of short pieces, given all their boundaries."""
        marks = [measure(c) for c in cuts]
        first, final = 0, len(cuts) - 1
        while True:
            last = min(bisect_right(marks, marks[first] + size) - 1, final)
            spans.append((cuts[first], cuts[last]))
            if last == final:
                return
            least = max(marks[last] - overlap, marks[last + 1] - size)
            first = min(bisect_left(marks, least, lo=first), last)

    def windows(start: int, end: int) -> None:
        """Chunks of a region without any separator."""
        if word_starts is not None:
            # White space that no separator names still parts words.
            merge([start, *word_starts[measure(start) + 1 : measure(end)], end])
            return
        while end - start > size:
            spans.append((start, start + size))
            start += size - overlap
        spans.append((start, end))

    def cover(start: int, end: int, left: list[str]) -> None:
        used = next((i for i, s in enumerate(left) if s == "" or text.find(s, start, end) >= 0), None)
        if used is None or left[used] == "":
            windows(start, end)
            return
        found = re.compile(re.escape(left[used])).finditer(text, start, end)
        cuts = sorted({start, end, *(m.start() for m in found)})
        run = [start]
        for a, b in zip(cuts, cuts[1:]):
            if measure(b) - measure(a) < size:
                run.append(b)
                continue
            if len(run) > 1:
                merge(run)
            cover(a, b, left[used + 1 :])
            run = [b]
        if len(run) > 1:
            merge(run)

    if text:
        cover(0, len(text), separators)
    return spans


def _splitter(size: int, overlap: int, unit: str):
    def slice_of(texts: pa.Array, separators: pa.Array) -> pa.Array:
        out = []
        for text, seps in zip(texts.to_pylist(), separators.to_pylist()):
            pieces = (text[a:b].strip() for a, b in chunk_spans(text or "", seps, size, overlap, unit))
            out.append([p for p in pieces if p])
        return pa.array(out, pa.list_(pa.string()))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array, separators: pa.Array) -> pa.Array:
        return in_slices(slice_of, texts, separators)

    return split


def language_separators(lang: Column | str) -> Column:
    """Separator list for a language: its own boundaries, then the general ones."""
    general = F.array(*[F.lit(s) for s in SEPARATORS])
    chain = None
    for name, own in LANGUAGE_SEPARATORS.items():
        value = F.array(*[F.lit(s) for s in own + SEPARATORS])
        chain = F.when(col(lang) == name, value) if chain is None else chain.when(col(lang) == name, value)
    return chain.otherwise(general)


def recursive_chunks(
    text: Column | str,
    separators: Column | None = None,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    unit: str = CHARACTERS,
) -> Column:
    """Array of stripped, non-blank chunks; `unit='words'` counts words, not characters."""
    seps = F.array(*[F.lit(s) for s in SEPARATORS]) if separators is None else separators
    return _splitter(size, overlap, unit)(col(text), seps)


# --- rows ----------------------------------------------------------------------
def chunk_rows(samples: DataFrame, chunks: Column) -> DataFrame:
    """One row per chunk with its number, id and hash, and the document's fields."""
    rest = [c for c in samples.columns if c != "text"]
    return (
        samples.select(*rest, F.posexplode(chunks).alias("chunk_no", "chunk"))
        .withColumn("chunk_no", F.col("chunk_no").cast("bigint"))
        .withColumn("chunk_id", chunk_id("original_index", "chunk_no"))
        .withColumn("code_hash", content_hash("chunk"))
    )


def chunk_checks(text: Column | str, chunks: Column | str, size: int = CHUNK_SIZE) -> list[Column]:
    """What must hold for every split text."""
    text, chunks = col(text), col(chunks)
    bare = F.regexp_replace(text, r"^\s+", "")
    return [
        ((F.size(chunks) > 0) | (bare == "")).alias("has_chunk"),
        F.forall(chunks, lambda c: F.length(c) <= size).alias("max_len_ok"),
        F.forall(chunks, lambda c: F.contains(text, c)).alias("all_substrings"),
        F.coalesce(F.startswith(bare, F.get(chunks, F.lit(0))), F.lit(True)).alias("starts_ok"),
        F.coalesce(F.endswith(F.regexp_replace(text, r"\s+$", ""), F.element_at(F.filter(chunks, lambda c: c != ""), -1)), F.lit(True)).alias("ends_ok"),
        (F.size(chunks) >= F.ceil(F.length(F.regexp_replace(text, r"\s+", "")) / F.lit(size))).alias("enough_chunks"),
    ]

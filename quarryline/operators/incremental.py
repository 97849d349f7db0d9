"""Skipping what is stored already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, at_most, written
from .known import KnownKeys


def touched_by(batch: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """The part of the store that can matter to a batch.

    A store grows without end while a batch may be small: the keys of a small batch
    are broadcast, so the store is scanned and not shuffled.
    """
    keys = batch.select(key)
    return store.join(F.broadcast(keys), key, "left_semi") if at_most(keys, BROADCAST_ROWS) else store


def _touched(batch: DataFrame, store: DataFrame | KnownKeys, key: str) -> DataFrame:
    """(key, content, ok) of the stored rows that share a key with the batch."""
    if isinstance(store, KnownKeys):
        return store.touched(batch, key)
    content = [F.col(c) for c in ("code_hash", "doc_hash") if c in store.columns]
    rows = store.select(key, F.coalesce(*content, F.col(key).cast("string")).alias("content"), F.col("summary_ok").alias("ok"))
    return touched_by(batch, rows, key)


def skip_known_docs(samples: DataFrame, store: DataFrame | KnownKeys, skip_by: str = "index") -> DataFrame:
    """Documents that are not in the store, given as its rows or as its keys.

    'index' goes by row position, 'hash' by content.  A document with a failed row is
    not known, so it is tried again, until a later row holds that content.
    """
    if skip_by == "index":
        key, offered = "original_index", samples
    elif skip_by == "hash":
        key, offered = "doc_hash", samples.withColumn("doc_hash", F.sha2("text", 256))
    else:
        raise ValueError(f"skip_by must be 'index' or 'hash', not {skip_by!r}")
    touched = _touched(offered, store, key)
    failed = touched.where("NOT ok").select(key, "content")
    if isinstance(store, KnownKeys):
        touched = written(touched, "known-docs")
        failed = touched.where("NOT ok").select(key, "content")
        if failed.isEmpty():
            return offered.join(touched.select(key), key, "left_anti").select(samples.columns)
        done = store.touched(failed, "content").where("ok").select("content")
    else:
        contents = [F.col(c) for c in ("code_hash", "doc_hash") if c in store.columns]
        good = store.where("summary_ok").select(F.coalesce(*contents, F.col(key).cast("string")).alias("content"))
        done = touched_by(failed, good, "content")
    open_docs = failed.join(done, "content", "left_anti").select(key)
    known = touched.select(key).join(open_docs, key, "left_anti")
    return offered.join(known, key, "left_anti").select(samples.columns)


def first_rows(rows: DataFrame, key: str, order: list[str], few: int = BROADCAST_ROWS) -> DataFrame:
    """One whole row per key: the first in the given order.

    The rows are written with a number each.  Only keys, order and numbers are grouped;
    the winners' numbers then pick the rows, or the losers' leave them out, whichever are few enough to
    broadcast, so no wide column is sorted, and none is shuffled unless both are very many.
    """
    held = written(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    first = F.min_by("_row", F.struct(*order, "_row")) if order else F.min("_row")
    winners = written(held.groupBy(key).agg(first.alias("_row")).select("_row"), "winners")
    if at_most(winners, few):
        return held.join(F.broadcast(winners), "_row", "left_semi").select(rows.columns)
    losers = written(held.select("_row").join(winners, "_row", "left_anti"), "losers")
    if at_most(losers, few):
        return held.join(F.broadcast(losers), "_row", "left_anti").select(rows.columns)
    return held.join(winners.hint("shuffle_hash"), "_row", "left_semi").select(rows.columns)


def first_of_equal(chunks: DataFrame) -> DataFrame:
    """One row per content hash: the first in (original_index, chunk_no) order."""
    return first_rows(chunks, "code_hash", ["original_index", "chunk_no"])


def new_contents(chunks: DataFrame, store: DataFrame | KnownKeys) -> tuple[DataFrame, DataFrame]:
    """(first rows of new contents, code_hash of contents that the store holds with a failed summary).

    The reduced batch starts from files, and so does what the store knows of it, so both are
    cheap to join and the costly steps that follow run once.
    """
    firsts = first_of_equal(chunks)
    met = written(_touched(firsts, store, "code_hash").select("code_hash", "ok").distinct(), "known-contents")
    kept = firsts.join(met.where("ok").select("code_hash"), "code_hash", "left_anti").select(chunks.columns)
    return kept, met.where("NOT ok").select("code_hash")


def skip_known_chunks(chunks: DataFrame, store: DataFrame | KnownKeys) -> DataFrame:
    """The first of each new content; content stored with a failed summary is new."""
    return new_contents(chunks, store)[0]

"""Ranked search of a whole corpus for a table of items, by pipelined term partitioning.

Terms belong to owners, the rarest to the first.  Documents lie in slices of bounded size.  For every slice an item
sends a bundle from owner to owner: a sparse accumulator (documents and integer scores so far) and the terms still
to come.  Each owner is one cogroup of bundles and its postings; it adds its contributions and passes the bundle on.
The last one keeps the best documents of the slice, and a top-k over the slices ends the search.

A bundle leaves out documents that cannot be among the best of their slice any more: score so far, plus the most
that the owners to come can add, lies below what `keep` documents of the slice have already.  So the result is exact,
and bundles stay short although nearly every document holds some common word.  No term meets in one task: its
postings are spread over the slices.  Scores are sums of 64-bit integers, so their order of adding does not matter.

Null texts and texts without a term match nothing; an item without a term gets no rows.  Every document row is ranked by
itself, so repeated rows take a rank each; equal scores go by ascending document id, null ids first.  Ids are integers; the
smallest 64-bit integer stands for null.  Items are told apart by row, so an item id that occurs twice is searched twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import top_k
from ..session import BROADCAST_ROWS, at_most, written
from .arrays import WORD_CHARS, lowered, row_of, runs, text_blocks, text_bytes

KEEP = 50
SLICE_BITS = 11
SLICE_DOCS = 1 << SLICE_BITS  # documents of a slice, hence entries of an accumulator at most
BLOCK_ITEMS = 256  # items whose bundles meet the postings of a slice at one time
SHARES = (1 / 256, 1 / 32, 1 / 8)  # an owner's terms lie in at most this share of the documents; the last has the rest
SHIP_TERMS = 200_000  # distinct terms of the items that may be sent whole to the tasks ...
SHIP_BYTES = 16 << 20  # ... and their bytes
NO_ID = -(1 << 63)

# Fixed values of the score, all in integers.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COUNTS = "doc_id long, n long, codes array<long>, tfs array<long>"
_POSTINGS = "slice long, owner int, places array<int>, ids array<long>, at array<int>, codes array<long>, parts array<long>"
_TERMS = "array<struct<owner:int,code:bigint,weight:bigint,most:bigint>>"
_BUNDLE = f"slice long, block long, item long, terms {_TERMS}, floor long, places array<int>, ids array<long>, scores array<long>"
_BEST = "item long, doc_id long, place long, score long"


# --- terms of items and documents ------------------------------------------------
def _numbered(df: DataFrame, name: str, what: str) -> DataFrame:
    """Written rows with a number each; once written, the numbers stay."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), what)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms): the distinct terms of each item, A-Z in small letters."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    terms = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    return _numbered(items.select(F.col(id_col).alias("item_id"), terms.alias("terms")), "item", "items")


def _words(block: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All terms of a block of texts as bytes, the row of each, and the number in each row."""
    data, offsets = text_bytes(block.column("text"))
    data = lowered(data)
    starts, ends, bounds = runs(data, offsets, WORD_CHARS)
    ends_packed = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_packed[1:])
    body = data[WORD_CHARS[data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_packed), pa.py_buffer(body)])
    return words, row_of(bounds), np.diff(bounds)


def _counted(row: np.ndarray, code: np.ndarray, n_rows: int, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets by row, codes, counts) of the (row, code) pairs."""
    cell, count = np.unique(row * max(1, n_codes) + code, return_counts=True)
    row, code = np.divmod(cell, max(1, n_codes))
    return np.searchsorted(row, np.arange(n_rows + 1)), code, count


def _lists(offsets: np.ndarray, values: pa.Array | np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _known_terms(docs: DataFrame, terms: pa.Table) -> DataFrame:
    """(doc_id, n, codes, tfs): the number of terms of each document, and the counts of those shipped."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held.value.column("term").combine_chunks().cast(pa.large_string()).cast(pa.large_binary())
        codes = held.value.column("code").to_numpy()
        for batch in batches:
            for block in text_blocks(batch, "text"):
                words, row, n = _words(block)
                place = pc.index_in(words, value_set=wanted)
                known = np.asarray(place.is_valid())
                place = np.asarray(place.fill_null(0), np.int64)[known]
                offsets, place, tfs = _counted(row[known], place, block.num_rows, len(codes))
                columns = [block.column("doc_id"), pa.array(n, pa.int64()), _lists(offsets, codes[place]), _lists(offsets, tfs)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "codes", "tfs"])

    return _numbered(docs.mapInArrow(run, _COUNTS), "row", "doc-terms")


def _all_terms(docs: DataFrame) -> DataFrame:
    """(doc_id, n, terms, tfs): every term of each document, for a vocabulary that is too large to ship."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "text"):
                words, row, n = _words(block)
                coded = words.dictionary_encode()
                offsets, place, tfs = _counted(row, np.asarray(coded.indices, np.int64), block.num_rows, len(coded.dictionary))
                terms = coded.dictionary.take(pa.array(place)).cast(pa.binary()).cast(pa.string())
                columns = [block.column("doc_id"), pa.array(n, pa.int64()), _lists(offsets, terms), _lists(offsets, tfs)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    return _numbered(docs.mapInArrow(run, "doc_id long, n long, terms array<string>, tfs array<long>"), "row", "doc-terms")


def document_terms(docs: DataFrame, vocabulary: DataFrame, ship_terms: int = SHIP_TERMS) -> tuple[DataFrame, int, int]:
    """((row, doc_id, n, codes, tfs) of documents with a known term, documents with any term, terms of all documents)."""
    small = at_most(vocabulary, ship_terms) and (vocabulary.agg(F.sum(F.octet_length("term"))).first()[0] or 0) <= SHIP_BYTES
    held = _known_terms(docs, vocabulary.select("term", "code").toArrow()) if small else _all_terms(docs)
    n_docs, n_terms = held.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if small:
        return held.where(F.size("codes") > 0), n_docs, n_terms
    flat = held.select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", "doc_id", "n", "x.*")
    # One document's terms meet in one row, never one term's documents.
    met = flat.withColumnRenamed("terms", "term").join(vocabulary, "term").groupBy("row")
    rows = met.agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.collect_list(F.struct("code", "tfs")).alias("x"))
    return rows.select("row", "doc_id", "n", F.col("x.code").alias("codes"), F.col("x.tfs").alias("tfs")), n_docs, n_terms


def _length_part(n: Column, n_docs: int, n_terms: int) -> Column:
    """100 - 50 + (50 * n * N) div L: the score's m, as it grows with a document's length."""
    return F.lit(50) + F.call_function("div", F.lit(50) * n * F.lit(n_docs), F.lit(max(1, n_terms)))


def _owner(df: Column, n_docs: int) -> Column:
    chain = F.lit(len(SHARES))
    for owner in reversed(range(len(SHARES))):
        chain = F.when(df <= F.lit(SHARES[owner] * n_docs), F.lit(owner)).otherwise(chain)
    return chain.cast("int")


def term_weights(counts: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(code, owner, weight, most): the weight of a term and the most that it can add to a score."""
    flat = counts.select("n", F.explode(F.arrays_zip("codes", "tfs")).alias("x")).select("n", F.col("x.codes").alias("code"), F.col("x.tfs").alias("tf"))
    stats = flat.groupBy("code").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("tf"), F.min("n").alias("n"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    m = _length_part(F.col("n"), n_docs, n_terms)
    most = F.call_function("div", F.col("tf") * 1_000_000_000, F.col("tf") * 1000 + m * 20)
    stats = stats.select("code", _owner(F.col("df"), n_docs).alias("owner"), weight.alias("weight"), (weight * most).alias("most"))
    return written(stats, "term-weights")


# --- postings and bundles ------------------------------------------------------------
def postings(counts: DataFrame, weights: DataFrame, n_docs: int, n_terms: int, ship_terms: int = SHIP_TERMS) -> DataFrame:
    """What the owners hold: for each slice and owner, documents, and (document, term, part of the score) triples.

    A part is the contribution without the term's weight; bundles bring the weights along.
    """
    small = at_most(weights, ship_terms)
    m = _length_part(F.col("n"), n_docs, n_terms)
    if small:
        held = counts.sparkSession.sparkContext.broadcast(weights.select("code", "owner").orderBy("code").toArrow())
        rows = counts.select("row", "doc_id", m.alias("m"), "codes", "tfs")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, owners = (held.value.column(c).to_numpy() for c in ("code", "owner"))
            for batch in batches:
                if batch.num_rows:
                    yield from _posting_rows(batch, codes, owners)

        made = rows.mapInArrow(run, _POSTINGS)
    else:
        flat = counts.select("row", "doc_id", m.alias("m"), F.explode(F.arrays_zip("codes", "tfs")).alias("x"))
        flat = flat.select("row", "doc_id", "m", F.col("x.codes").alias("code"), F.col("x.tfs").alias("tf")).join(weights.select("code", "owner"), "code")
        place = F.col("row").bitwiseAND(F.lit(SLICE_DOCS - 1)).cast("int")
        part = F.call_function("div", F.col("tf") * 1_000_000_000, F.col("tf") * 1000 + F.col("m") * 20)
        entry = F.struct(place.alias("place"), F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "code", part.alias("part"))
        grouped = flat.groupBy(F.shiftright("row", SLICE_BITS).alias("slice"), "owner").agg(F.collect_list(entry).alias("x"))
        made = grouped.select(
            "slice", "owner", F.col("x.place").alias("places"), F.col("x.id").alias("ids"), F.col("x.place").alias("at"),
            F.col("x.code").alias("codes"), F.col("x.part").alias("parts"),
        )
    return written(made, "postings")


def _posting_rows(batch: pa.RecordBatch, codes: np.ndarray, owners: np.ndarray) -> Iterator[pa.RecordBatch]:
    row, m = (batch.column(c).to_numpy() for c in ("row", "m"))
    ids = np.asarray(batch.column("doc_id").fill_null(NO_ID))
    lists = batch.column("codes")
    of = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
    code, tf = (np.asarray(batch.column(c).flatten()) for c in ("codes", "tfs"))
    owner = owners[np.searchsorted(codes, code)]
    part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[of])
    order = np.lexsort((of, owner, row[of] >> SLICE_BITS))
    of, code, part, owner = of[order], code[order], part[order], owner[order]
    slice_of = row[of] >> SLICE_BITS
    cuts = np.flatnonzero(np.r_[True, (slice_of[1:] != slice_of[:-1]) | (owner[1:] != owner[:-1])]) if len(of) else np.zeros(0, np.int64)
    out = {name: [] for name in ("slice", "owner", "places", "ids", "at", "codes", "parts")}
    for low, high in zip(cuts, np.r_[cuts[1:], len(of)]):
        docs = of[low : high][np.r_[True, of[low + 1 : high] != of[low : high - 1]]]
        values = (slice_of[low], owner[low], row[docs] & (SLICE_DOCS - 1), ids[docs], row[of[low:high]] & (SLICE_DOCS - 1), code[low:high], part[low:high])
        for name, value in zip(out, values):
            out[name].append(value)
    if len(cuts):
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


class _Slice:
    """The postings of one owner in one slice, by term."""

    def __init__(self, held: pa.Table):
        def flat(name: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, np.int64), *(np.asarray(c.flatten(), np.int64) for c in held.column(name).chunks)])

        self.ids = np.full(SLICE_DOCS, NO_ID, np.int64)
        self.ids[flat("places")] = flat("ids")
        codes = flat("codes")
        order = np.argsort(codes, kind="stable")
        self.codes, self.at, self.parts = codes[order], flat("at")[order], flat("parts")[order]

    def add(self, code: int, weight: int, scores: np.ndarray) -> None:
        low, high = np.searchsorted(self.codes, [code, code + 1])
        scores[self.at[low:high]] += weight * self.parts[low:high]


def _visit(owner: int, keep: int, bundles: pa.Table, held: pa.Table) -> Iterator[tuple[dict, list[dict], np.ndarray, np.ndarray, np.ndarray, int]]:
    """Every bundle after its visit: (bundle, terms to come, places, ids, scores, floor)."""
    here = _Slice(held)
    for bundle in bundles.to_batches(max_chunksize=1):
        row = bundle.to_pylist()[0]
        places, ids, scores = (np.array(row[c], np.int64) for c in ("places", "ids", "scores"))
        total, id_of = np.zeros(SLICE_DOCS, np.int64), here.ids.copy()
        total[places], id_of[places] = scores, ids
        mine, later = ([t for t in row["terms"] if f(t["owner"])] for f in (owner.__eq__, owner.__lt__))
        for term in mine:
            here.add(term["code"], term["weight"], total)
        if row["floor"] > sum(t["most"] for t in row["terms"]):  # a document that is not there yet cannot win
            seen = np.zeros(SLICE_DOCS, bool)
            seen[places] = True
            total[~seen] = 0
        to_come = sum(t["most"] for t in later)
        found = np.flatnonzero(total)
        floor = row["floor"]
        if len(found) >= keep:
            floor = max(floor, int(np.partition(total[found], len(found) - keep)[len(found) - keep]))
        found = found[total[found] + to_come >= floor]
        yield row, later, found, id_of[found], total[found], floor


def _pass_on(owner: int, keep: int):
    def run(bundles: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        for row, later, places, ids, scores, floor in _visit(owner, keep, bundles, held):
            if len(places) or later:
                out.append(row | {"terms": later, "floor": floor, "places": places, "ids": ids, "scores": scores})
        return pa.Table.from_pylist(out, schema=bundles.schema)

    return run


def _select(owner: int, keep: int):
    names = ["item", "doc_id", "place", "score"]

    def run(bundles: pa.Table, held: pa.Table) -> pa.Table:
        parts = [np.zeros((0, 4), np.int64)]
        for row, _, places, ids, scores, _ in _visit(owner, keep, bundles, held):
            best = np.lexsort((places, ids, -scores))[:keep]
            place = (row["slice"] << SLICE_BITS) + places[best]
            parts.append(np.column_stack([np.full(len(best), row["item"]), ids[best], place, scores[best]]))
        return pa.table(dict(zip(names, np.concatenate(parts).T.copy())), pa.schema([(n, pa.int64()) for n in names]))

    return run


def search(
    items: DataFrame, docs: DataFrame, keep: int = KEEP, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text",
    ship_terms: int = SHIP_TERMS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The `keep` documents of each item with the highest scores above 0: (item_id, rank, doc_id, score)."""
    asked = item_terms(items, item_col, text_col)
    vocabulary = _numbered(asked.select(F.explode("terms").alias("term")).distinct(), "code", "vocabulary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts, n_docs, n_terms = document_terms(rows, vocabulary, ship_terms)
    weights = term_weights(counts, n_docs, n_terms)
    held = postings(counts, weights, n_docs, n_terms, ship_terms)

    blocks = max(1, math.ceil(asked.count() / block_items))
    weighed = asked.select("item", F.explode("terms").alias("term")).join(vocabulary, "term").join(weights, "code")
    bundles = weighed.where("weight > 0").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("owner", "code", "weight", "most"))).alias("terms"))
    bundles = written(bundles.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "bundles")
    if at_most(bundles, BROADCAST_ROWS // 100):
        bundles = F.broadcast(bundles)
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    empty = [F.lit(0).cast("long").alias("floor"), *(F.array().cast(t).alias(c) for c, t in (("places", "array<int>"), ("ids", "array<long>"), ("scores", "array<long>")))]
    slices = written(held.select("slice").distinct(), "slices")
    state = slices.select("slice", every_block).join(bundles, "block").select("slice", "block", "item", "terms", *empty)
    assert state.schema.simpleString() == T.StructType.fromDDL(_BUNDLE).simpleString()
    for owner in range(len(SHARES) + 1):
        last = owner == len(SHARES)
        own = held.where(F.col("owner") == owner).select("slice", every_block, "places", "ids", "at", "codes", "parts")
        met = state.groupBy("slice", "block").cogroup(own.groupBy("slice", "block"))
        state = met.applyInArrow((_select if last else _pass_on)(owner, keep), _BEST if last else _BUNDLE)
    best = top_k(state, ["item"], [F.desc("score"), F.col("doc_id"), F.col("place")], keep, spread_by="place")
    doc_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return best.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")

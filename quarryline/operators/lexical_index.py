"""A stored inverted index, and exact BM25 top-k over it by block-max skipping.

A batch of documents is cut into slices of bounded size.  All postings of a term in a slice are one
block: the documents' places in the slice and counts, both as plain bytes, and the greatest count and
smallest length among them, from which the most that the block can add to a score follows for whatever
statistics hold later.  The ids and lengths of a slice's documents are stored once.  Blocks are
written by part (a hash range of terms), sorted by term and slice, in files of about equal size, so a
term that fills the corpus takes many files, not one.  Statistics of batches add up, so batches are
never rewritten when a new one comes.

A search reads only the parts of its own words, first without the postings: the heads of the blocks
bound every query's score in every slice.  The most promising slices are scored, which gives each
query a score to beat; of the rest, only slices that can beat it are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens
from ..session import BROADCAST_ROWS, at_most, read_table, written
from .ranking import top_k
from .search import DECIMALS

PARTS = 64  # parts of the terms, each a folder
SLICE_DOCS = 1024
SLICE_BYTES = 32 << 20  # words of a slice that are held at one time
FIRST_SLICES = 4  # scored for each query before any is skipped
BLOCK_QUERIES = 256  # queries that meet the blocks of a slice at one time
SLACK = 1e-8  # between a bound and a rounded score

LISTING = T.StructType([
    T.StructField("version", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("batch_id", T.LongType()),
])
_KEYS = ["batch_id", "slice"]
_HEAD = ["term", *_KEYS, "n", "max_tf", "min_length"]


def _part(term: Column | str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(PARTS)).cast("int")


# --- writing -------------------------------------------------------------------------
def _slice_blocks(ids: pa.Array, words: pa.ListArray, number: int) -> pa.RecordBatch:
    """The blocks of one slice; the empty term, which no text contains, stands for the slice itself and has its documents."""
    length = np.asarray(words.value_lengths(), np.int64)
    coded = words.flatten().dictionary_encode()
    n_docs, n_terms = len(length), len(coded.dictionary)
    cell = np.asarray(coded.indices, np.int64) * max(1, n_docs) + np.repeat(np.arange(n_docs), length)
    cell, tf = np.unique(cell, return_counts=True)
    code, doc = np.divmod(cell, max(1, n_docs))
    bounds = np.searchsorted(code, np.arange(n_terms + 1))
    n = np.diff(bounds)
    max_tf, min_length = (f.reduceat(v, bounds[:-1]) if n_terms else v[:0] for f, v in ((np.maximum, tf), (np.minimum, length[doc])))

    def packed(values: np.ndarray, most: int) -> pa.Array:
        """Each term's numbers as bytes, in the least width that holds all of the slice."""
        width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
        at = np.r_[bounds, bounds[-1]].astype(np.int32) * np.int32(width)
        return pa.Array.from_buffers(pa.binary(), n_terms + 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(values.astype(f"<u{width}").tobytes())])

    def of_slice(values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array([None] * n_terms + [0, n_docs], pa.int32()), values)

    def column(values: np.ndarray, last: int, kind: pa.DataType) -> pa.Array:
        return pa.array(np.r_[values, last], kind)

    return pa.RecordBatch.from_pydict({
        "term": pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([""])]),
        "slice": column(np.full(n_terms, number), number, pa.int64()),
        "n": column(n, n_docs, pa.int32()),
        "max_tf": column(max_tf, 0, pa.int32()),
        "min_length": column(min_length, 0, pa.int32()),
        "n_words": column(np.zeros(n_terms, np.int64), int(length.sum()), pa.int64()),
        "docs": of_slice(ids),
        "lengths": of_slice(pa.array(length, pa.int32())),
        "places": packed(doc, n_docs),
        "tfs": packed(tf, int(tf.max(initial=0))),
    })


def _blocks(batches: Iterator[pa.RecordBatch], slice_docs: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        return _slice_blocks(*(table.column(i).combine_chunks() for i in (0, 1)), number)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(np.asarray(batch.column(1).slice(at).value_lengths(), np.int64)) * 8 + size
            fit = max(int(np.searchsorted(ends, SLICE_BYTES, side="right")), 0 if held else 1)
            take = min(slice_docs - rows, fit, batch.num_rows - at)
            if take:
                held.append(batch.slice(at, take))
                rows, size, at = rows + take, int(ends[take - 1]), at + take
            if rows >= slice_docs or at < batch.num_rows:
                yield flush()
                held, rows, size, number = [], 0, 0, number + 1
    if held:
        yield flush()


def add_batch(
    docs: DataFrame, path: str, batch_id: int, row_id: str = "original_index", text: str = "text", slice_docs: int = SLICE_DOCS
) -> None:
    """Index a batch of documents; indexing it again replaces it.  Rows without a text are left out.

    The blocks of each run lie in a folder of their own, and the listing names the one that counts.  It is swapped
    when they are complete, so a run that fails leaves the batch as it was.
    """
    words = docs.select(F.col(row_id).alias("doc"), tokens(text).alias("words")).where("words IS NOT NULL")
    kind = words.schema["doc"].dataType.simpleString()
    schema = f"term string, slice bigint, n int, max_tf int, min_length int, n_words bigint, docs array<{kind}>, lengths array<int>, places binary, tfs binary"
    blocks = written(words.mapInArrow(lambda batches: _blocks(batches, slice_docs), schema).withColumn("part", _part("term")), "blocks")
    version = f"v{uuid.uuid4().hex}"
    order = ["part", "term", "slice"]
    dealt = blocks.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.partitionBy("part").parquet(f"{path}/postings/batch_id={batch_id}/version={version}")
    # The slices' own rows make one row of the listing.
    sums = blocks.where("term = ''").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("n_words"))
    row = sums.select(F.lit(version).alias("version"), "n_rows", "n_words", F.lit(batch_id).cast("bigint").alias("batch_id"))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/batches")


# --- reading --------------------------------------------------------------------------
def listing(spark: SparkSession, path: str) -> DataFrame:
    """The batches that count: (version, n_rows, n_words, batch_id)."""
    return read_table(spark, f"{path}/batches", LISTING)


def blocks_of(terms: DataFrame, path: str) -> DataFrame:
    """The stored blocks of the given distinct terms; only the folders of their parts are read."""
    spark = terms.sparkSession
    parts = [r["part"] for r in terms.select(_part("term").alias("part")).distinct().collect()]  # PARTS at most
    stored = spark.read.option("basePath", f"{path}/postings").parquet(f"{path}/postings").where(F.col("part").isin(parts))
    current = F.broadcast(listing(spark, path).select("batch_id", "version"))  # a row for each batch
    stored = stored.withColumn("batch_id", F.col("batch_id").cast("bigint")).join(current, ["batch_id", "version"], "left_semi")
    if at_most(terms, 500):  # few enough for the files' own statistics
        stored = stored.where(F.col("term").isin([r["term"] for r in terms.collect()]))
    return stored.join(_narrow(terms.select("term")), "term", "left_semi")


def _narrow(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if at_most(rows, BROADCAST_ROWS) else rows


class Search:
    """The steps of one search: weights, bounds of slices, and exact scores where a slice can win."""

    def __init__(self, queries: DataFrame, path: str, k: int, k1: float = 1.2, b: float = 0.75, block_queries: int = BLOCK_QUERIES):
        spark = queries.sparkSession
        self.k, self.k1, self.b = k, k1, b
        sums = listing(spark, path).agg(F.sum("n_rows").alias("rows"), F.sum("n_words").alias("words")).first()
        self.n_rows, self.mean_length = sums["rows"] or 0, max((sums["words"] or 0) / (sums["rows"] or 1), 1e-9)
        asked = queries.select("q_id", F.explode(tokens("query_text")).alias("term")).groupBy("q_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
        asked = written(asked, "query-terms")
        slices = spark.range(1).select(F.lit("").alias("term"))  # the blocks that stand for the slices themselves
        self.blocks = blocks_of(asked.select("term").distinct().union(slices), path)
        self.heads = written(self.blocks.where("term != ''").select(*_HEAD), "block-heads")
        idf = F.log(1 + (F.lit(float(self.n_rows)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        df = self.heads.groupBy("term").agg(F.sum("n").alias("df"))
        weights = asked.join(df, "term").select("q_id", "term", (F.col("qtf") * idf).alias("weight"))
        self.query_blocks = max(1, math.ceil(weights.select("q_id").distinct().count() / block_queries))
        weights = weights.withColumn("query_block", F.pmod(F.xxhash64("q_id"), F.lit(self.query_blocks)))
        self.weights = written(weights, "query-weights")

    def _part_of_score(self, tf: Column, length: Column) -> Column:
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.mean_length))

    def bounds(self) -> DataFrame:
        """(q_id, query_block, batch_id, slice, most): no document of the slice scores more than `most`."""
        met = self.heads.join(_narrow(self.weights), "term")
        most = F.col("weight") * self._part_of_score(F.col("max_tf"), F.col("min_length"))
        return met.groupBy("q_id", "query_block", *_KEYS).agg(F.sum(most).alias("most"))

    def scored(self, wanted: DataFrame) -> DataFrame:
        """(q_id, doc, score) in the wanted (q_id, query_block, batch_id, slice); the k best of each."""
        asked = wanted.select("q_id", "query_block", *_KEYS).join(self.weights, ["q_id", "query_block"])
        needed = asked.select("term", *_KEYS, "query_block").union(wanted.select(F.lit("").alias("term"), *_KEYS, "query_block"))
        needed = written(needed.distinct(), "needed-blocks")
        held = self.blocks.select("term", *_KEYS, "n", "docs", "lengths", "places", "tfs").join(_narrow(needed), ["term", *_KEYS])
        q_type, kind = self.weights.schema["q_id"].dataType, self.blocks.schema["docs"].dataType.elementType
        schema = f"q_id {q_type.simpleString()}, doc {kind.simpleString()}, score double"
        k, k1, b, mean = self.k, self.k1, self.b, self.mean_length

        def best(asked: pa.Table, held: pa.Table) -> pa.Table:
            return _best_of_slice(asked, held, k, k1, b, mean)

        key = [*_KEYS, "query_block"]
        return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(best, schema)

    def _ranked(self, found: DataFrame) -> DataFrame:
        return top_k(found, ["q_id"], [F.desc("score"), F.col("doc")], self.k, spread_by="doc")

    def wanted(self, bounds: DataFrame, first: DataFrame, found: DataFrame) -> DataFrame:
        """The slices still to read: they can hold a document that beats the k-th best of the first ones."""
        floor = self._ranked(found).where(F.col("rank") == self.k).select("q_id", F.col("score").alias("floor"))
        rest = bounds.join(_narrow(first.select("q_id", *_KEYS)), ["q_id", *_KEYS], "left_anti").join(_narrow(floor), "q_id", "left")
        return rest.where(F.col("floor").isNull() | (F.col("most") >= F.col("floor") - SLACK)).drop("floor")

    def run(self) -> DataFrame:
        bounds = written(self.bounds(), "bounds")
        order = [F.desc("most"), *(F.col(c) for c in _KEYS)]
        first = written(top_k(bounds, ["q_id"], order, FIRST_SLICES, spread_by="slice").drop("rank"), "first-slices")
        found = written(self.scored(first), "first-scores")
        rest = written(self.wanted(bounds, first, found), "wanted")
        return self._ranked(found.unionByName(self.scored(rest)))


def _best_of_slice(asked: pa.Table, held: pa.Table, k: int, k1: float, b: float, mean: float) -> pa.Table:
    """The k best documents of a slice for each query: one accumulator, as long as the slice, for one query at a time."""
    q_ids = asked.column("q_id").combine_chunks()
    at = {term: i for i, term in enumerate(held.column("term").to_pylist())}
    own = at.pop("")
    n = np.array(held.column("n"), np.int64)
    n[own] = 0
    starts = np.r_[0, np.cumsum(n)]
    ids, place = _numbered(held.column("docs")[own].values)
    rows, tf = (_unpacked(held.column(c), int(starts[-1])) for c in ("places", "tfs"))
    tf, length = tf.astype(np.float64), np.asarray(held.column("lengths")[own].values, np.float64)[rows]
    part, place = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean)), place[rows]
    coded = q_ids.dictionary_encode()
    codes, weight = np.asarray(coded.indices), np.asarray(asked.column("weight").combine_chunks())
    of_term = np.array([at.get(t, -1) for t in asked.column("term").to_pylist()], np.int64)
    order = np.argsort(codes, kind="stable")
    out_q, out_doc, out_score = [], [], []
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if len(order) else []:
        total = np.zeros(len(ids))
        for i in rows:
            if of_term[i] >= 0:
                low, high = starts[of_term[i]], starts[of_term[i] + 1]
                total[place[low:high]] += weight[i] * part[low:high]
        total = np.round(total, DECIMALS)
        found = np.flatnonzero(total > 0)
        if len(found) > k:
            found = found[total[found] >= np.partition(total[found], len(found) - k)[len(found) - k]]
        best = found[np.lexsort((found, -total[found]))[:k]]
        out_q.append(np.full(len(best), codes[rows[0]]))
        out_doc.append(best)
        out_score.append(total[best])
    q = np.concatenate([np.zeros(0, np.int64), *out_q]).astype(np.int64)
    doc = np.concatenate([np.zeros(0, np.int64), *out_doc]).astype(np.int64)
    return pa.table({"q_id": coded.dictionary.take(pa.array(q)), "doc": ids.take(pa.array(doc)), "score": np.concatenate([np.zeros(0), *out_score])})


def _unpacked(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """The n numbers that a slice's blocks hold as bytes of one width."""
    values = column.combine_chunks().cast(pa.large_binary())
    _, at, data = values.buffers()
    at = np.frombuffer(at, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data or b"", f"<u{(at[-1] - at[0]) // n if n else 1}", n, at[0])


def _numbered(docs: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct ids in rising order, and the place of each entry among them."""
    coded = docs.dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary), np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[np.asarray(coded.indices, np.int64)]


def search(queries: DataFrame, path: str, k: int, row_id: str = "original_index", **options) -> DataFrame:
    """The k best stored documents per query by BM25: (q_id, row_id, score, rank).

    Scores, ties and order are those of `search.lexical` over all indexed documents; no text is read.
    """
    return Search(queries, path, k, **options).run().withColumnRenamed("doc", row_id)

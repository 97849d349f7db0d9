"""Exact top-k search of a batch of queries over a corpus.

The corpus stays partitioned and is read once.  Each task keeps the best k rows
per query while it goes through its Arrow batches, so what is shuffled is k rows
per query and task, never query-row pairs.

The query side is shipped whole to the tasks only after its row count has been
checked.  A larger query batch is cut into blocks, the corpus into cells, and
every (block, cell) pair becomes one bounded group of a cogrouped job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import SHIP_ROWS, at_most, written
from .ranking import top_k

SCORE_CELLS = 1_000_000  # query-row scores held at one time
QUERY_TILE = 1024  # queries of a tile of scores
FIRST_ROWS = 512  # rows a task scores before its queries have bounds
PAIR_SLICE = 65_536  # candidate pairs examined at one time
MEASURED = 4096  # ... and measured exactly at one time
FEW_PAIRS = 16  # with more than one pair in so many measured exactly, rough scores are taken in double precision
PLAIN_SQUARES = 1e-20, 1e20  # lengths squared between which rough scores are taken in single precision
SHIP_BYTES = 64 << 20  # query vectors shipped whole to every task, in bytes
OUT_ROWS = 100_000  # rows of a batch that a task gives out
CELL_ROWS = 100_000  # corpus rows per cell of the cogrouped form
DECIMALS = 9  # scores equal to this many digits are ties, resolved by row id


class Leaders:
    """The best k rows per query that one task has seen (lower score first)."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.rows = 0  # corpus rows that were scored
        self.bound = np.full(n_queries, np.inf)
        self._held = np.zeros(n_queries, dtype=np.int64)
        self._score = np.empty((n_queries, k))
        self._ids = None

    @property
    def query(self) -> np.ndarray:
        return np.repeat(np.arange(len(self._held)), self._held)

    @property
    def score(self) -> np.ndarray:
        return self._score[self._filled(slice(None))]

    @property
    def ids(self) -> np.ndarray | None:
        return None if self._ids is None else self._ids[self._filled(slice(None))]

    def _filled(self, queries) -> np.ndarray:
        return np.arange(self.k) < self._held[queries][:, None]

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Only the queries that are given new rows are sorted anew."""
        if len(query) == 0:
            return
        if self._ids is None:
            self._ids = np.empty(self._score.shape, dtype=ids.dtype)
        self._ids = self._ids.astype(np.promote_types(self._ids.dtype, ids.dtype), copy=False)
        met = np.unique(query)
        old = self._filled(met)
        query = np.concatenate([np.repeat(met, self._held[met]), query])
        ids = np.concatenate([self._ids[met][old], ids])
        score = np.concatenate([self._score[met][old], score])
        order = np.lexsort((ids, score, query))
        query, ids, score = query[order], ids[order], score[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        count = np.diff(np.r_[starts, len(query)])
        place = np.arange(len(query)) - np.repeat(starts, count)
        kept = place < self.k
        query, place = query[kept], place[kept]
        self._ids[query, place], self._score[query, place] = ids[kept], score[kept]
        self._held[met] = np.minimum(count, self.k)
        full = met[count >= self.k]
        self.bound[full] = self._score[full, self.k - 1]


class VectorScorer:
    """Distances between query vectors and a list column of vectors."""

    def __init__(self, q_ids: pa.Array, matrix: np.ndarray, column: str, metric: str):
        self.q_ids, self.column, self.metric = q_ids, column, metric
        self.matrix = self._unit(matrix) if metric == "cosine" else matrix
        self.squares = _squares(self.matrix)
        self.largest = self.squares[~np.isnan(self.squares)].max(initial=0.0)
        self.sides: dict[type, np.ndarray] = {}
        self.single = True  # rough scores in single precision tell rows apart

    @staticmethod
    def from_table(table: pa.Table, vector: str, column: str, metric: str) -> VectorScorer:
        return VectorScorer(
            table.column("q_id").combine_chunks(), _matrix(table.column(vector).combine_chunks()), column, metric
        )

    @staticmethod
    def _unit(m: np.ndarray) -> np.ndarray:
        norms = np.sqrt((m * m).sum(axis=1))
        return m / np.where(norms > 0, norms, 1.0)[:, None]

    def feed(self, rows: pa.RecordBatch, ids: np.ndarray, best: Leaders) -> None:
        if not len(self.matrix):
            return
        lists = rows.column(self.column)
        if lists.null_count:
            present = lists.is_valid()
            lists, ids = lists.filter(present), ids[np.asarray(present)]
        vectors = _matrix(lists)
        if self.metric == "cosine":
            vectors = self._unit(vectors)
        squares = _squares(vectors)
        if (lost := np.isnan(squares)).any():
            vectors, ids, squares = vectors[~lost], ids[~lost], squares[~lost]
        at = 0
        while at < len(vectors):
            # The first rows give every query a bound; each stretch is as long as all before it, so that
            # few of its rows are within the bounds that those have left.
            to = at + max(FIRST_ROWS, 4 * best.k, best.rows)
            with np.errstate(over="ignore", invalid="ignore"):
                self._stretch(vectors[at:to], squares[at:to], ids[at:to], best)
            best.rows += len(vectors[at:to])
            at = to

    def _side(self, kind: type) -> np.ndarray:
        if kind not in self.sides:
            self.sides[kind] = np.column_stack([self.matrix, np.ones(len(self.matrix))]).astype(kind)
        return self.sides[kind]

    def _stretch(self, x: np.ndarray, squares: np.ndarray, ids: np.ndarray, best: Leaders) -> None:
        """Rough products in tiles of queries and rows; the few pairs that can still win are then measured exactly."""
        largest = max(self.largest, squares.max())
        kind = np.float32 if self.single and PLAIN_SQUARES[0] < largest < PLAIN_SQUARES[1] else np.float64
        # |q - x|^2 <= limit is the same as q.x - |x|^2 / 2 >= (|q|^2 - limit) / 2.
        offset = np.zeros(len(x)) if self.metric == "cosine" else -squares / 2
        side, other = self._side(kind), np.column_stack([x, offset]).astype(kind).T
        n_q = min(len(side), QUERY_TILE, SCORE_CELLS)
        n_x = max(1, SCORE_CELLS // n_q)
        n_x -= n_x % 8 if n_x > 8 else 0
        n_pairs = 0
        for q in range(0, len(side), n_q):
            queries, known = slice(q, q + n_q), None
            found, n_found = [], 0
            least = self._least(queries, largest, kind, best, known)
            for at in range(0, len(x), n_x):
                rough = side[queries] @ other[:, at : at + n_x]
                if known is None and rough.shape[1] > best.k and np.isinf(best.bound[queries]).any():
                    known = np.partition(rough, rough.shape[1] - best.k, axis=1)[:, rough.shape[1] - best.k]
                    least = self._least(queries, largest, kind, best, known)
                pair = _places(rough >= least[:, None]) if np.isfinite(largest) else np.arange(rough.size)
                query, row = np.divmod(pair, rough.shape[1])
                found.append((query + q, row + at))
                n_found += len(pair)
                n_pairs += len(pair)
                if n_found >= PAIR_SLICE:
                    self._measure(x, ids, found, best)
                    found, n_found = [], 0
                    least = self._least(queries, largest, kind, best, known)
            self._measure(x, ids, found, best)
        self.single &= n_pairs * FEW_PAIRS <= len(side) * len(x)

    def _least(self, queries: slice, largest: float, kind: type, best: Leaders, known: np.ndarray | None) -> np.ndarray:
        """The rough products from which on a row can still win, given the bounds or k products that are `known`.

        The slack covers the decimals that scores are rounded to, and the error of a sum of products of `kind`:
        its terms are no more than eight times the largest square, in all.
        """
        bound, width = best.bound[queries], self.matrix.shape[1]
        error = 8 * (width + 8) * np.finfo(kind).eps * largest
        if self.metric == "cosine":
            least = 1.0 - np.minimum(bound, 4.0) - 1e-8
        else:
            limit = np.minimum(bound * bound, 8 * largest) + 1e-8 * (1.0 + 2 * largest)
            least = (self.squares[queries] - limit) / 2
        if known is not None:
            least = np.maximum(least, known.astype(np.float64) - error - 1e-8 * (1.0 + 2 * largest))
        return (least - error).astype(kind)

    def _measure(self, x: np.ndarray, ids: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]], best: Leaders) -> None:
        query, row = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2
        for at in range(0, len(row), PAIR_SLICE):
            q, r = query[at : at + PAIR_SLICE], row[at : at + PAIR_SLICE]
            score = np.concatenate([self._exact(x[r[i : i + MEASURED]], self.matrix[q[i : i + MEASURED]]) for i in range(0, len(r), MEASURED)])
            kept = score <= best.bound[q]
            best.add(q[kept], ids[r[kept]], score[kept])

    def _exact(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.metric == "cosine":
            return np.round(1.0 - (x * q).sum(axis=1), DECIMALS)
        gap = x - q
        return np.round(np.sqrt((gap * gap).sum(axis=1)), DECIMALS)


class WordScorer:
    """Okapi BM25 scores between weighted query words and a list column of words."""

    def __init__(self, postings: pa.Table, column: str, mean_length: float, k1: float, b: float):
        self.column, self.mean_length, self.k1, self.b = column, mean_length, k1, b
        query = postings.column("q_id").combine_chunks().dictionary_encode()
        self.q_ids = query.dictionary
        word = postings.column("term").combine_chunks().dictionary_encode()
        self.words = word.dictionary
        codes = np.asarray(word.indices, dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.query = np.asarray(query.indices, dtype=np.int64)[order]
        self.weight = np.asarray(postings.column("weight").combine_chunks(), dtype=np.float64)[order]
        self.count = np.bincount(codes, minlength=len(self.words))
        self.start = np.cumsum(self.count) - self.count

    def feed(self, rows: pa.RecordBatch, ids: np.ndarray, best: Leaders) -> None:
        words = rows.column(self.column)
        step = max(1, min(1024, SCORE_CELLS // max(1, len(self.q_ids))))
        for at in range(0, len(words), step):
            self._block(words.slice(at, step), ids[at : at + step], best)

    def _block(self, words: pa.ListArray, ids: np.ndarray, best: Leaders) -> None:
        n, n_q = len(words), len(self.q_ids)
        length = np.asarray(words.value_lengths().fill_null(0), dtype=np.int64)
        code = pc.index_in(words.flatten(), value_set=self.words)
        known = np.asarray(code.is_valid())
        code = np.asarray(code.fill_null(0), dtype=np.int64)[known]
        row = np.repeat(np.arange(n), length)[known]
        cell, tf = np.unique(row * len(self.words) + code, return_counts=True)
        row, code = np.divmod(cell, max(1, len(self.words)))
        weight = tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length[row] / self.mean_length))
        scores = np.zeros(n * n_q)
        reach = np.cumsum(self.count[code])
        done = 0
        while done < len(code):
            base = reach[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(reach, base + SCORE_CELLS, side="right")))
            c, fan = code[done:stop], self.count[code[done:stop]]
            entry = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(self.start[c], fan)
            target = np.repeat(row[done:stop], fan) * n_q + self.query[entry]
            scores += np.bincount(target, weights=np.repeat(weight[done:stop], fan) * self.weight[entry],
                                  minlength=n * n_q)
            done = stop
        scores = -np.round(scores, DECIMALS).reshape(n, n_q)
        limit = best.bound
        if n > best.k and np.isinf(limit).any():
            limit = np.minimum(limit, np.partition(scores, best.k - 1, axis=0)[best.k - 1])
        row, query = np.nonzero((scores <= limit) & (scores < 0))
        for at in range(0, len(row), PAIR_SLICE):
            r, q = row[at : at + PAIR_SLICE], query[at : at + PAIR_SLICE]
            best.add(q, ids[r], scores[r, q])


def _matrix(lists: pa.ListArray) -> np.ndarray:
    sizes = pc.unique(lists.value_lengths())
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes.to_pylist())}")
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 1)


def _squares(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (m * m).sum(axis=1)


def _places(hit: np.ndarray) -> np.ndarray:
    """Flat places of the few true cells; eight cells are looked at together."""
    flat = hit.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    word = np.flatnonzero(flat.view(np.uint64))
    some, byte = np.nonzero(flat.reshape(-1, 8)[word])
    return word[some] * 8 + byte


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column) if pa.types.is_integer(column.type) else np.array(column.to_pylist(), dtype=str)


def _parts(batch: pa.RecordBatch, group: str | None) -> Iterator[tuple[str | None, pa.RecordBatch]]:
    if group is None:
        yield None, batch
        return
    names = batch.column(group)
    for name in pc.unique(names).to_pylist():
        yield name, batch.filter(pc.equal(names, name))


class RoutedScorer:
    """Vector scorers by group: each group's rows meet only the queries that are routed there."""

    def __init__(self, table: pa.Table, group: str, vector: str, column: str):
        self.table, self.group, self.vector, self.column = table, group, vector, column

    def of(self, name: str | None) -> VectorScorer:
        own = self.table.filter(pc.equal(self.table.column(self.group), name))
        return VectorScorer.from_table(own, self.vector, self.column, "l2")


def _best_rows(batches, scorer, k: int, row_id: str, group: str | None) -> Iterator[pa.RecordBatch]:
    routed = isinstance(scorer, RoutedScorer)
    held: dict[str | None, tuple] = {}
    for batch in batches:
        for name, rows in _parts(batch, group):
            if rows.num_rows:
                if name not in held:
                    own = scorer.of(name) if routed else scorer
                    held[name] = own, Leaders(len(own.q_ids), k)
                own, best = held[name]
                own.feed(rows, _ids(rows.column(row_id)), best)
    for name, (own, best) in held.items():
        if best.ids is None:
            continue
        query, ids, score = best.query, best.ids, best.score
        for at in range(0, len(query), OUT_ROWS):
            some = ids[at : at + OUT_ROWS]
            out = {"q_id": own.q_ids.take(pa.array(query[at : at + OUT_ROWS])),
                   row_id: pa.array(some if some.dtype.kind == "i" else some.tolist())}
            if group is not None:
                out[group] = pa.array([name] * len(some), pa.string())
            out["score"] = pa.array(score[at : at + OUT_ROWS])
            yield pa.RecordBatch.from_pydict(out)


def _scan(queries: DataFrame, corpus: DataFrame, make_scorer, k: int, row_id: str, group: str | None,
          ship_rows: int) -> DataFrame:
    """Run a scorer over the corpus: (q_id, row_id[, group], score), k per query and task."""
    id_type = corpus.schema[row_id].dataType.simpleString()
    q_type = queries.schema["q_id"].dataType.simpleString()
    schema = f"q_id {q_type}, {row_id} {id_type}" + (f", {group} string" if group else "") + ", score double"

    shipped = queries.limit(ship_rows + 1).toArrow()
    if shipped.num_rows <= ship_rows:
        held = queries.sparkSession.sparkContext.broadcast(shipped)

        def run(batches):
            yield from _best_rows(batches, make_scorer(held.value), k, row_id, group)

        return corpus.mapInArrow(run, schema)

    blocks = math.ceil(queries.count() / ship_rows)
    cells = max(1, math.ceil(corpus.count() / CELL_ROWS))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    left = queries.withColumn("_block", F.pmod(F.xxhash64("q_id"), F.lit(blocks))).withColumn("_cell", every(cells))
    right = corpus.withColumn("_cell", F.pmod(F.xxhash64(row_id), F.lit(cells))).withColumn("_block", every(blocks))

    def pair(q: pa.Table, c: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and c.num_rows:
            found = list(_best_rows(c.to_batches(max_chunksize=10_000), make_scorer(q), k, row_id, group))
        if found:
            return pa.Table.from_batches(found)
        empty = {"q_id": q.column("q_id").slice(0, 0), row_id: c.column(row_id).slice(0, 0)}
        if group is not None:
            empty[group] = pa.array([], pa.string())
        return pa.table({**empty, "score": pa.array([], pa.float64())})

    return (
        left.groupBy("_block", "_cell")
        .cogroup(right.groupBy("_block", "_cell"))
        .applyInArrow(pair, schema)
    )


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    row_id: str = "original_index",
    vector: str = "vec",
    query_vector: str = "query_vec",
    group: str | None = None,
    metric: str = "l2",
    ship_rows: int = SHIP_ROWS,
) -> DataFrame:
    """The k nearest corpus rows per query (and group): (q_id, row_id, distance, rank).

    A query without a vector has no hits; vectors of different lengths are an error.
    """
    columns = [row_id, vector] + ([group] if group else [])
    rows = corpus.select(*columns)
    asked = queries.select("q_id", query_vector).where(F.col(query_vector).isNotNull())
    width = asked.select(F.size(query_vector).alias("n")).first()
    ship_rows = min(ship_rows, max(1, SHIP_BYTES // (8 * max(1, width["n"] if width else 1))))

    def make(table: pa.Table) -> VectorScorer:
        return VectorScorer.from_table(table, query_vector, vector, metric)

    found = _scan(asked, rows, make, k, row_id, group, ship_rows).withColumnRenamed("score", "distance")
    keys = ["q_id"] + ([group] if group else [])
    return top_k(found, keys, [F.col("distance"), F.col(row_id)], k, spread_by=row_id)


def nearest_routed(
    routes: DataFrame,
    corpus: DataFrame,
    k: int,
    group: str,
    row_id: str = "original_index",
    vector: str = "vec",
    query_vector: str = "query_vec",
    ship_rows: int = SHIP_ROWS,
) -> DataFrame:
    """The k nearest rows per query among the groups it is routed to: (q_id, row_id, group, distance, rank).

    `routes` has a row (q_id, group, query vector) for each group of a query.  The corpus is read once, and only
    the groups that some query wants; a task scores a group's rows against that group's queries alone.
    """
    asked = routes.select("q_id", group, query_vector).where(F.col(query_vector).isNotNull())
    wanted = [r[group] for r in asked.select(group).distinct().collect()]  # names of groups
    rows = corpus.select(row_id, vector, group).where(F.col(group).isin(wanted))
    width = asked.select(F.size(query_vector).alias("n")).first()
    ship_rows = min(ship_rows, max(1, SHIP_BYTES // (8 * max(1, width["n"] if width else 1))))

    def make(table: pa.Table) -> RoutedScorer:
        return RoutedScorer(table, group, query_vector, vector)

    found = _scan(asked, rows, make, k, row_id, group, ship_rows).withColumnRenamed("score", "distance")
    return top_k(found, ["q_id"], [F.col("distance"), F.col(row_id)], k, spread_by=row_id)


def lexical(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    row_id: str = "original_index",
    text: str = "text",
    k1: float = 1.2,
    b: float = 0.75,
    ship_rows: int = SHIP_ROWS,
) -> DataFrame:
    """The k best rows per query by BM25: (q_id, row_id, score, rank).

    All words count, however common.  Document frequencies are summed on the map
    side for the words of the queries only; scoring never joins on a word.
    """
    postings = (
        queries.select("q_id", F.explode(tokens("query_text")).alias("term"))
        .groupBy("q_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    vocabulary = postings.select("term").union(queries.sparkSession.range(1).select(F.lit(""))).distinct()
    words = corpus.select(row_id, tokens(text).alias("words"))

    # The empty term, which no text contains, stands once for every row: its count
    # is the number of rows and the sum of `n` their total length.
    entries = words.select(
        F.explode(F.array_append(F.array_distinct("words"), F.lit(""))).alias("term"), F.size("words").alias("n")
    )
    if at_most(postings, ship_rows):
        entries = entries.join(F.broadcast(vocabulary), "term", "left_semi")
    counts = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("total"))
    # A word may fill a large part of the corpus, so a vocabulary too large to
    # broadcast meets the counts, not the words.
    stats = written(counts.join(vocabulary, "term", "left_semi"), "word-stats")
    size = stats.where("term = ''").select("df", "total").first()
    n_rows, mean_length = (size["df"], size["total"] / size["df"]) if size else (0, 1.0)
    idf = F.log(1 + (F.lit(float(n_rows)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = postings.join(stats, "term").select("q_id", "term", (F.col("tf") * idf).alias("weight"))

    def make(table: pa.Table) -> WordScorer:
        return WordScorer(table, "words", max(mean_length, 1e-9), k1, b)

    found = _scan(weighted, words, make, k, row_id, None, ship_rows).withColumn("score", -F.col("score"))
    return top_k(found, ["q_id"], [F.desc("score"), F.col(row_id)], k, spread_by=row_id)

"""Exact nearest rows of a stored corpus, of which most files are never opened.

Vectors are stored by cell, the nearest of a few centroids, and inside a cell by ring, a range of
distances from the centroid.  By the triangle inequality a row of a ring whose distances lie between
`low` and `high` is at least max(0, d - high, low - d) and at most d + high away from a query at distance d
from the centroid.  A search reads the rings that promise most, so that each query has k rows,
and then only rings that can hold a nearer one.  Rings are folders, so what is not wanted is pruned
before any file is opened.  A cell that a third of all rows share is cut by distance like any other; rows that
are equal share a ring, which takes as many files and tasks as it needs.

Centroids are fitted on a bounded sample and decide only how much can be skipped, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SHIP_ROWS, at_most, written
from .ranking import top_k
from .search import SHIP_BYTES, Leaders, VectorScorer, _ids, _matrix, nearest

SAMPLE_ROWS = 20_000  # the centroids and ring bounds are fitted on
CELLS = 64  # at most; a cell has CELL_SAMPLE rows of the sample at least, on average
CELL_SAMPLE = 100
RINGS = 8  # of a cell, of equal size in the sample
ROUNDS = 10  # of Lloyd's algorithm
SLACK = 1e-6  # of a distance, for rounding


# --- layout -----------------------------------------------------------------------------
def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _fit(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centroids of a sample: spread starting points, then Lloyd's algorithm."""
    sample = np.unique(sample, axis=0)
    centres = sample[:1]
    gap = _distances(sample, centres)[:, 0]
    while len(centres) < min(cells, len(sample)):  # the farthest point, so that no cluster stays without one
        centres = np.concatenate([centres, sample[gap.argmax()][None]])
        gap = np.minimum(gap, _distances(sample, centres[-1:])[:, 0])
    for _ in range(ROUNDS):
        near = _distances(sample, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _edges(sample: np.ndarray, centres: np.ndarray, rings: int) -> np.ndarray:
    """For each cell the distances at which a new ring begins."""
    all_gaps = _distances(sample, centres)
    near, gap = all_gaps.argmin(axis=1), all_gaps.min(axis=1)
    shares = np.arange(1, rings) / rings
    return np.array([np.quantile(gap[near == i], shares) if (near == i).any() else np.zeros(rings - 1) for i in range(len(centres))])


def store(
    vectors: DataFrame, path: str, row_id: str = "original_index", vector: str = "vec", cells: int = CELLS, rings: int = RINGS,
    sample_rows: int = SAMPLE_ROWS,
) -> None:
    """Write all rows that have a vector by (cell, ring), and the table of rings with what bounds them."""
    rows = vectors.select(row_id, F.col(vector).cast("array<double>").alias("vec")).where("vec IS NOT NULL")
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64(row_id), row_id).limit(sample_rows).select("vec").toArrow()
    points = _matrix(sample.column("vec").combine_chunks())
    if not len(points):
        return
    centres = _fit(points, max(1, min(cells, len(points) // CELL_SAMPLE)))
    held = spark.sparkContext.broadcast((centres, _edges(points, centres, rings)))  # cells * (dimensions + rings) numbers

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, edges = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            gaps = _distances(_matrix(batch.column("vec")), centres)
            cell, gap = gaps.argmin(axis=1), gaps.min(axis=1)
            ring = (gap[:, None] > edges[cell]).sum(axis=1)
            columns = [batch.column(0), batch.column(1), pa.array(gap), pa.array((cell * (edges.shape[1] + 1) + ring).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[row_id, "vec", "gap", "place"])

    kind = rows.schema[row_id].dataType.simpleString()
    placed = written(rows.mapInArrow(place, f"{row_id} {kind}, vec array<double>, gap double, place int"), "placed")
    placed.repartitionByRange("place", "gap", row_id).write.partitionBy("place").parquet(f"{path}/rows")
    bounds = placed.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("low"), F.max("gap").alias("high"))
    of_cell = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell bigint, centre array<double>")
    bounds = bounds.withColumn("cell", F.floor(F.col("place") / rings)).join(F.broadcast(of_cell), "cell").drop("cell")
    bounds.coalesce(1).write.parquet(f"{path}/rings")  # cells * rings rows at most


# --- search -----------------------------------------------------------------------------
class _Rings:
    """The bounds of all rings, a bounded table."""

    def __init__(self, spark: SparkSession, path: str):
        table = spark.read.parquet(f"{path}/rings").orderBy("place").toArrow()
        self.place, self.n, self.low, self.high = (table.column(c).to_numpy() for c in ("place", "n", "low", "high"))
        self.centres = _matrix(table.column("centre").combine_chunks())

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most): between them lie the distances of a ring's rows from each query."""
        d = _distances(queries, self.centres)
        slack = SLACK * (1.0 + d + self.high)
        return np.maximum(0.0, np.maximum(d - self.high, self.low - d) - slack), d + self.high + slack

    def promising(self, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(wanted first, reach): the rings with the smallest `most` that hold k rows, and how far these can be."""
        order = most.argsort(axis=1, kind="stable")
        held = np.cumsum(self.n[order], axis=1)
        last = np.minimum((held < k).sum(axis=1), len(self.n) - 1)
        first = np.zeros(most.shape, bool)
        np.put_along_axis(first, order, np.arange(len(self.n))[None, :] <= last[:, None], axis=1)
        reach = np.where(held[:, -1] >= k, np.take_along_axis(most, order, axis=1)[np.arange(len(most)), last], np.inf)
        return first, reach


def _read(stored: DataFrame, row_id: str, rings: _Rings, wanted: np.ndarray, q_ids: pa.Array, matrix: np.ndarray, reach: np.ndarray, k: int, q_type: str) -> DataFrame:
    """The k best of each task for each query, over the rings that some query wants; a ring meets only queries that want it."""
    places = rings.place[wanted.any(axis=0)]
    rows = stored.where(F.col("place").isin([int(p) for p in places])).select(row_id, "vec", "place")
    asked = {int(p): np.flatnonzero(wanted[:, i]) for i, p in enumerate(rings.place) if wanted[:, i].any()}
    held = stored.sparkSession.sparkContext.broadcast((asked, q_ids, matrix, reach))
    kind = stored.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, q_ids, matrix, reach = held.value
        seen: dict[int, tuple[VectorScorer, Leaders]] = {}
        for batch in batches:
            place = np.asarray(batch.column("place"))
            for p in np.unique(place):
                some = batch.filter(pa.array(place == p))
                if p not in seen:
                    mine = asked[int(p)]
                    best = Leaders(len(mine), k)
                    best.bound = reach[mine].copy()
                    seen[p] = VectorScorer(q_ids.take(pa.array(mine)), matrix[mine], "vec", "l2"), best
                scorer, best = seen[p]
                scorer.feed(some, _ids(some.column(row_id)), best)
        for scorer, best in seen.values():
            if best.ids is not None:
                yield pa.RecordBatch.from_pydict({"q_id": scorer.q_ids.take(pa.array(best.query)), row_id: pa.array(best.ids.tolist()), "distance": pa.array(best.score)})

    return rows.mapInArrow(run, f"q_id {q_type}, {row_id} {kind}, distance double")


def search(queries: DataFrame, path: str, k: int, row_id: str = "original_index", query_vector: str = "query_vec", ship_rows: int = SHIP_ROWS) -> DataFrame:
    """The k nearest stored rows per query by L2 distance: (q_id, row_id, distance, rank), as `search.nearest` gives them.

    A batch of queries too large to ship wants every ring, so it runs as the full search over the stored rows.
    """
    spark = queries.sparkSession
    stored = spark.read.parquet(f"{path}/rows")
    asked = queries.select("q_id", query_vector).where(F.col(query_vector).isNotNull())
    width = asked.select(F.size(query_vector).alias("n")).first()
    if not at_most(asked, min(ship_rows, max(1, SHIP_BYTES // (8 * max(1, width["n"] if width else 1))))):
        return nearest(queries, stored, k, row_id, query_vector=query_vector, ship_rows=ship_rows)
    table = asked.toArrow()
    q_ids, q_type = table.column("q_id").combine_chunks(), queries.schema["q_id"].dataType.simpleString()
    matrix = _matrix(table.column(query_vector).combine_chunks()) if len(table) else np.zeros((0, 1))
    if not len(table):
        return nearest(queries, stored, k, row_id, query_vector=query_vector)
    rings = _Rings(spark, path)
    least, most = rings.bounds(matrix)
    first, reach = rings.promising(most, k)
    found = written(_read(stored, row_id, rings, first, q_ids, matrix, reach, k, q_type), "first-hits")
    order = [F.col("distance"), F.col(row_id)]
    floor = {r["q_id"]: r["distance"] for r in top_k(found, ["q_id"], order, k, spread_by=row_id).where(F.col("rank") == k).collect()}  # a row a query
    reach = np.minimum(reach, np.array([floor.get(q, np.inf) for q in q_ids.to_pylist()]) * (1 + SLACK) + SLACK)
    rest = (least <= reach[:, None]) & ~first
    if rest.any():
        found = found.unionByName(_read(stored, row_id, rings, rest, q_ids, matrix, reach, k, q_type))
    return top_k(found, ["q_id"], order, k, spread_by=row_id)

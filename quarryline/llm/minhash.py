"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

Documents with equal shingle sets are one class from the start, however many they
are.  Classes that share a band bucket are compared by their signatures, a batch
of hashes at a time; a pair is given up as soon as the posterior probability that
its similarity reaches the threshold falls below `miss`.  A bucket only emits a
spanning forest of its surviving pairs, which keeps the families connected
without listing pairs.  Within a family whole shingle sets are compared, so every
link is exact, and again only a spanning forest of true links is emitted.
Buckets and families larger than a tile are compared tile against tile.

Chance of losing a link at the threshold t: b bands of r hashes miss it with
probability (1 - t ** r) ** b, which `banding` keeps under 2e-5 (1.2e-5 at 0.85); the
pruning adds 1e-6 a batch.  It matters only if no chain of other links joins the ends.

Defined results: null, empty or blank texts have no shingles, are linked with
nothing and stay; a row without an id is linked with nothing, has no component
and stays; repeated rows share one class.  An id should name one text: where it
names several, every row has the component of its own text, and texts that share
their smallest id count as linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, at_most, written
from . import arrays, graph

HASHES, BATCH = 144, 24
#: Chance of missing a pair at the threshold that the banding may have.
BAND_MISS = 2e-5
#: Members of a bucket or family that one task compares with each other.
TILE = 2048
#: Bytes of the sets of a family's tile; two tiles meet at a time.
TILE_BYTES = 64 << 20

_SIGNED = "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary, bands array<long>"


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of each text and the text of each; fewer words make one shingle."""
    counts = np.diff(bounds)
    rows, found = [], []
    n = len(words) - k + 1
    if n > 0:
        h = np.zeros(n, np.uint64)
        for i in range(k):
            h = (h + words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
            h ^= h >> np.uint64(29)
        of = arrays.row_of(bounds)
        whole = of[:n] == of[k - 1 : k - 1 + n]
        found.append(arrays.mix(h[whole]))
        rows.append(of[:n][whole])
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        value = counts[r : r + 1].astype(np.uint64)
        for i in range(bounds[r], bounds[r + 1]):
            value = arrays.mix(words[i : i + 1] ^ value) * np.uint64(3)
        found.append(value)
        rows.append(np.array([r]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(rows)


def shingle_sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block, and where each text's begin."""
    data, offsets = arrays.text_bytes(batch.column("text"))
    data = arrays.lowered(data)
    starts, ends, bounds = arrays.runs(data, offsets, arrays.NOT_SPACE)
    h, rows = shingle_hashes(arrays.span_hashes(data, starts, ends), bounds, k)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[new], rows[new]
    return h, np.searchsorted(rows, np.arange(batch.num_rows + 1))


@cache
def _seeds(n: int) -> np.ndarray:
    return arrays.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def signatures(h: np.ndarray, bounds: np.ndarray, n: int = HASHES) -> np.ndarray:
    """n minima of each non-empty set; 32-bit values."""
    out = np.zeros((len(bounds) - 1, n), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    low = (h >> np.uint64(7)).astype(np.uint32) ^ h.astype(np.uint32)
    for i, seed in enumerate(_seeds(n)):
        a, b = np.uint32(seed & np.uint64(0xFFFFFFFF) | np.uint64(1)), np.uint32(seed >> np.uint64(32))
        v = low * a
        v ^= v >> np.uint32(15)
        v *= b | np.uint32(1)
        v ^= v >> np.uint32(13)
        out[full, i] = np.minimum.reduceat(v, bounds[full])
    return out


def banding(threshold: float) -> tuple[int, int]:
    """(bands, rows): the most selective split of the signature within `BAND_MISS`."""
    fits = [(HASHES // r, r) for r in range(1, 13) if (1 - threshold**r) ** (HASHES // r) <= BAND_MISS]
    return fits[-1] if fits else (HASHES, 1)


def _sign(batches, k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "text", 2 << 20):
            h, bounds = shingle_sets(block, k)
            sizes = np.diff(bounds)
            sign = signatures(h, bounds)
            hi = arrays.segment_sums(h.view(np.int64), bounds)
            lo = arrays.segment_sums(arrays.mix(h ^ np.uint64(0x5DEECE66D)).view(np.int64), bounds)
            wide = sign[:, : bands * rows].astype(np.uint64).reshape(len(sign), bands, rows)
            band = np.tile(np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(sign), 1))
            for i in range(rows):
                band = arrays.mix(band ^ wide[:, :, i])
            small = (sign ^ (sign >> np.uint32(16))).astype("<u2")
            spots = pa.ListArray.from_arrays(np.arange(len(sign) + 1, dtype=np.int32) * bands, pa.array(band.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(hi), pa.array(lo), pa.array([r.tobytes() for r in small], pa.binary()), spots],
                names=["doc_id", "n_shingles", "set_hi", "set_lo", "signature", "bands"],
            )


@cache
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """For 1, 2, ... batches of hashes: the fewest matches that keep a pair.

    With a uniform prior the similarity is Beta(m + 1, n - m + 1) after m of n
    matches; its upper tail is a binomial sum.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def alike(one: np.ndarray, others: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which rows of `others` still can be similar to `one` after all batches."""
    live, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for i, fewest in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (others[live, part] == one[part]).sum(1)
        keep = matches >= fewest
        live, matches = live[keep], matches[keep]
    return live


def spanning_pairs(sign: np.ndarray, side: np.ndarray, least: tuple[int, ...], linked) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that survive pruning and that `linked` confirms.

    side: 0, 1 or 2.  0 and 1 are two tiles of which only pairs across matter; 2 is one
    tile, compared with itself.  Breadth-first: a row meets only rows not yet reached.
    """
    found = []
    waiting = np.arange(len(sign))
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            i = queue.pop()
            open_to = waiting if side[i] == 2 else waiting[side[waiting] != side[i]]
            if not len(open_to):
                continue
            near = open_to[alike(sign[i], sign[open_to], least)]
            near = np.array([j for j in near if linked(i, j)], np.int64)
            found.extend((i, j) for j in near)
            queue.extend(near)
            waiting = np.setdiff1d(waiting, near, assume_unique=True)
    return found


def _pairs(ids: list, sign: np.ndarray, side: np.ndarray, least, linked) -> pa.RecordBatch:
    found = spanning_pairs(sign, side, least, linked)
    return pa.RecordBatch.from_arrays(
        [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())], names=["a", "b"]
    )


def _groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted partition, one table each."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(cut), batch.num_rows]
        for a, b in zip(at, at[1:]):
            now = tuple(c[a] for c in columns)
            if held and now != key:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sides(table: pa.Table) -> np.ndarray:
    """2 for a tile met with itself, else 0 and 1 for its two parts."""
    part, first, second = (table.column(c).to_numpy() for c in ("part", "first", "second"))
    return np.where(first == second, 2, (part != first).astype(np.int64))


def _signature_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def _bucket_pairs(batches, threshold: float, miss: float) -> Iterator[pa.RecordBatch]:
    least = least_matches(threshold, miss)
    for table in _groups(batches, ["key", "first", "second"]):
        if table.num_rows > 1:
            yield _pairs(table.column("node").to_pylist(), _signature_rows(table.column("signature")), _sides(table), least, lambda i, j: True)


def _family_pairs(batches, percent: int, miss: float) -> Iterator[pa.RecordBatch]:
    least = least_matches(percent / 100, miss)
    for table in _groups(batches, ["key", "first", "second"]):
        if table.num_rows < 2:
            continue
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]

        def linked(i: int, j: int) -> bool:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                return False
            both = len(a) + len(b) - len(_union(a, b))
            return 100 * both >= percent * (len(a) + len(b) - both)

        yield _pairs(table.column("node").to_pylist(), _signature_rows(table.column("signature")), _sides(table), least, linked)


def _union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct values of two sorted arrays of distinct values."""
    c = np.sort(np.concatenate([a, b]), kind="stable")
    return c[np.concatenate([[True], c[1:] != c[:-1]])]


def _sets(batches, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, "text", 2 << 20):
            h, bounds = shingle_sets(block, k)
            cut = [h[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            kept = [block.column(c) for c in block.schema.names if c != "text"]
            names = [c for c in block.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(cut, pa.binary())], names=[*names, "shingles"])


def _tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Rows (key, size, bytes, node, ...) once for each pair of tiles they take part in; one pair up to `tile` members and `TILE_BYTES`."""
    parts = F.greatest(F.ceil(F.col("size") / tile), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    return (
        rows.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("first", F.least("part", "other"))
        .withColumn("second", F.greatest("part", "other"))
        .drop("other", "size", "bytes")
    )


def _met(rows: DataFrame) -> DataFrame:
    keys = ["key", "first", "second"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, miss: float = 1e-6, tile: int = TILE
) -> DataFrame:
    """Every row's (doc_id, n_shingles, component_id, kept).

    Links documents whose sets of k-word shingles have 100 * intersection >= percent * union.
    """
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bands, rows = banding(percent / 100)
    signed = written(plain.mapInArrow(partial(_sign, k=k, bands=bands, rows=rows), _SIGNED), "signed")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("node"))
    heads = known.join(classes, ["set_hi", "set_lo"]).where("doc_id = node").select("node", "n_shingles", "signature", "bands").dropDuplicates(["node", "signature"])
    heads = written(heads, "heads")

    spots = heads.select("node", F.explode("bands").alias("key"))
    shared = spots.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    spots = spots.join(shared, "key").select("key", "size", F.lit(0).alias("bytes"), "node")  # signatures are all of one size
    marked = spots.join(heads.select("node", "signature"), "node")
    pairs = written(
        _met(_tiled(marked, tile)).mapInArrow(partial(_bucket_pairs, threshold=percent / 100, miss=miss), "a long, b long").distinct(), "candidates"
    )

    family = written(graph.components(pairs).select("node", F.col("component").alias("key")), "families")
    sizes = family.join(heads.select("node", "n_shingles"), "node").groupBy("key").agg(F.count("*").alias("size"), F.sum(8 * F.col("n_shingles")).alias("bytes"))
    wanted = family.select(F.col("node").alias("doc_id"), "key")
    if at_most(wanted, BROADCAST_ROWS):  # two numbers a row
        wanted = F.broadcast(wanted)
    sets = plain.join(wanted, "doc_id").select("doc_id", "key", "text").mapInArrow(partial(_sets, k=k), "doc_id long, key long, shingles binary")
    sets = sets.select(F.col("doc_id").alias("node"), "key", "shingles").dropDuplicates(["node", "shingles"])
    members = sets.join(heads.select("node", "signature"), "node").join(sizes, "key")
    links = _met(_tiled(members, tile)).mapInArrow(partial(_family_pairs, percent=percent, miss=miss), "a long, b long")
    joined = graph.components(links).select("node", "component")

    labelled = classes.join(joined, "node", "left").select("set_hi", "set_lo", F.coalesce("component", "node").alias("component"))
    out = signed.join(labelled, ["set_hi", "set_lo"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )

"""Keys of a store: filters without misses, few folders read, the same answers as a scan of the rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarryline.operators import incremental, known
from quarryline.plans.ingest import ingest, ingest_whole
from quarryline.sources import sinks
from test_incremental import A, B, C, samples, stored, windows

DRAW = np.random.default_rng(13)


@pytest.mark.parametrize("n", [1, 3, 100, 20_000])
def test_filters_miss_nothing(n):
    hashes = DRAW.integers(-(1 << 63), 1 << 63, n)
    made = known.make_filter(hashes)
    assert known.may_hold(made, hashes).all()
    if n > 100:
        others = DRAW.integers(-(1 << 63), 1 << 63, 50_000)
        assert known.may_hold(made, others).mean() < 0.02 and len(made) <= 2 * n + 8


def test_filters_are_cut_by_bucket_and_size(monkeypatch):
    monkeypatch.setattr(known, "FILTER_KEYS", 100)
    buckets = np.repeat([2, 5, 9], [250, 100, 1]).astype(np.int32)
    hashes = DRAW.integers(-(1 << 63), 1 << 63, len(buckets))
    batches = [pa.RecordBatch.from_pydict({"bucket": buckets[i : i + 70], "hash": hashes[i : i + 70]}) for i in range(0, len(buckets), 70)]
    made = [r for b in known._filters(iter(batches)) for r in b.to_pylist()]
    assert [r["bucket"] for r in made] == [2, 2, 2, 5, 9]
    for b in (2, 5, 9):
        own = hashes[buckets == b]
        assert np.logical_or.reduce([known.may_hold(r["bits"], own) for r in made if r["bucket"] == b]).all()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("known") / "store")
    for batch_id in range(2):
        texts = {i: f"T {i}. U {i}." for i in range(batch_id * 200, batch_id * 200 + 200)}
        ingest(samples(spark, texts), path, batch_id, chunks=windows())
    return path


def test_a_small_batch_reads_few_folders(spark, store):
    keys = known.KnownKeys(spark, store, 2)
    batch = samples(spark, {i: f"T {i}. U {i}." for i in (3, 250, 1000, 1001, 1002, 1003, 1004, 1005, 1006, 1007)})
    hashed = known._hash("index", F.col("original_index"))
    asked = batch.select(known._bucket(hashed).alias("bucket"), hashed.alias("hash"))
    places = keys.places(asked).collect()
    assert 2 <= len({(r.version, r.bucket) for r in places}) <= 4  # of 2 * 64, for the two that are stored
    found = keys.touched(batch, "original_index")
    assert {r.original_index for r in found.collect()} == {3, 250}
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line and "_keys/rows" in line)
    assert "PartitionFilters: []" not in scan and "embedding" not in plan
    fresh = samples(spark, {9000 + i: "x" for i in range(10)})
    assert keys.touched(fresh, "original_index").collect() == []


def test_same_answers_as_the_rows(spark, store):
    keys, scan = known.KnownKeys(spark, store, 2), sinks.read_store(spark, store)
    batch = samples(spark, {i: f"T {i + 1}. U {i + 1}." for i in range(150, 500)})
    for skip_by in ("index", "hash"):
        got, want = (rows(incremental.skip_known_docs(batch, s, skip_by), "original_index") for s in (keys, scan))
        assert got == want and 0 < len(got) < 350
    earlier = known.KnownKeys(spark, store, 1)
    assert len(rows(incremental.skip_known_docs(batch, earlier), "original_index")) == 300


def test_keys_of_an_unlisted_batch_are_made_up_for(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest_whole(samples(spark, {7: A, 8: B + C}), path, 0)  # writes rows only
    assert rows(incremental.skip_known_docs(samples(spark, {7: A, 9: C}), known.KnownKeys(spark, path, 1)), "original_index") == [(9,)]
    assert rows(incremental.skip_known_docs(samples(spark, {1: A, 9: C}), known.KnownKeys(spark, path, 1), "hash"), "original_index") == [(9,)]
    ingest(samples(spark, {1: A}), path, 1, chunks=windows())  # a whole document is no chunk
    assert stored(spark, path, "batch_id", "code") == [(0, A), (0, B + C), (1, A)]


def test_an_empty_first_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest(samples(spark, {1: A}).limit(0), path, 0, chunks=windows())
    ingest(samples(spark, {1: A}), path, 1, chunks=windows())
    ingest(samples(spark, {1: A, 2: A}), path, 2, chunks=windows())
    assert stored(spark, path, "batch_id", "code") == [(1, A)]

"""What a task holds beside its batch, and what is moved to number and index rows."""

import glob

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarryline.functions import scan, slices, vectors
from quarryline.operators import chunking, known
from quarryline.session import written
from quarryline.sources import sinks


def test_cuts_lose_no_row():
    sizes = np.array([3, 0, 9, 1, 1, 0, 20, 2])
    at = slices.cuts(sizes, 5)
    assert at[0] == 0 and at[-1] == len(sizes) and at == sorted(set(at))
    assert all(sizes[a:b].sum() <= 5 or b - a == 1 for a, b in zip(at, at[1:]))
    assert slices.cuts(sizes[:0], 5) == [0]


def test_scan_takes_a_batch_in_slices(monkeypatch):
    seen, whole = [], scan.scan
    monkeypatch.setattr(scan, "scan", lambda data, *rest: (seen.append(len(data)), whole(data, *rest))[1])
    texts = pa.array(["x = 'a'\n" * 20_000, None, "", "# é\ny = 1\n"] * 10, pa.string())
    langs = pa.array(["python", "go", None, "python"] * 10, pa.string())
    for udf in (scan._mask_all.func, scan._mask_long.func):
        found = udf(texts, langs)
        assert found.to_pylist() == [udf(texts[i : i + 1], langs[i : i + 1])[0].as_py() for i in range(len(texts))]
    assert max(seen) <= slices.SLICE_BYTES < sum(len(t or "") for t in texts.to_pylist())


def test_chunks_and_vectors_take_a_batch_in_slices(monkeypatch):
    texts = pa.array(["some words. " * 30_000, None, "", "a\n\nb"] * 4, pa.string())
    seps = pa.array([["\n\n", " ", ""]] * 16)
    slice_rows, in_slices = [], slices.in_slices
    monkeypatch.setattr(chunking, "in_slices", lambda fn, *c: in_slices(lambda *s: (slice_rows.append(len(s[0])), fn(*s))[1], *c))
    found = chunking._splitter(512, 50, chunking.CHARACTERS).func(texts, seps).to_pylist()
    assert len(slice_rows) > 1 and sum(slice_rows) == 16
    assert [len(f) for f in found[:4]] == [len(f) for f in found[4:8]] and found[1] == [] and found[3] == ["a\n\nb"]
    monkeypatch.setattr(slices, "SLICE_WORDS", 7)
    words = pa.array([["a", "b"], None, [], ["c"] * 9, ["a"]], pa.list_(pa.string()))
    assert vectors._hashed_words.func(words).to_pylist() == vectors._hashed_slice(words).to_pylist()


def test_numbering_moves_keys_only(spark, tmp_path, monkeypatch):
    moved, whole = [], sinks.numbered
    monkeypatch.setattr(sinks, "numbered", lambda df, *rest: (moved.append(df.columns), whole(df, *rest))[1])
    rows = spark.createDataFrame([(i, f"d{i}", [float(i)], f"m{i}") for i in (3, 1, 2)], "n long, document string, embedding array<double>, metadata string")
    path = str(tmp_path / "c")
    for batch in (rows.where("n < 3"), rows, rows):
        sinks.extend_collection(batch, path, "all", ["n"])
    assert all("document" not in m and "embedding" not in m for m in moved)
    found = sinks.read_collections(spark, path).select("id", "document").collect()
    assert sorted(map(tuple, found)) == [("chunk_0", "d1"), ("chunk_1", "d2"), ("chunk_2", "d3")]


def test_kept_results_are_packed(spark, monkeypatch, tmp_path):
    names = []
    monkeypatch.setattr(known, "written", lambda df, name: (names.append(name), written(df, name))[1])
    store = spark.createDataFrame([(1, "d", "c", True, 0)], "original_index long, doc_hash string, code_hash string, summary_ok boolean, batch_id long")
    for c in known.CODE_DOCS.fields:
        if c.name not in store.columns:
            store = store.withColumn(c.name, F.lit(None).cast(c.dataType))
    path = str(tmp_path / "store")
    sinks.write_batch(store, path, 0)
    known.index_batch(spark, path, 0)
    assert "keys" not in names  # the keys are written once, where they stay
    held = known.KnownKeys(spark, path, 1)
    asked = spark.createDataFrame([(1,), (2,)], "original_index long")
    assert [tuple(r) for r in held.touched(asked, "original_index").collect()] == [(1, "c", True)]
    files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if "/batches/" not in f and "/filters/" not in f]
    assert files and all("zstd" in f for f in files)

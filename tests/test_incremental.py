"""Skipping, retrying, replaying, and stream against batch."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarryline.functions.vectors import guarded_text, guarded_vector
from quarryline.operators import incremental
from quarryline.operators.cache import answer_cache
from quarryline.operators.chunking import fixed_windows
from quarryline.plans.ingest import ingest, ingest_whole
from quarryline.schemas import CODE_SAMPLES, QUERY_LOG
from quarryline.sources import sinks
from quarryline.streaming.ingest import stream_ingest

DAY = datetime.date(2024, 1, 1)


def samples(spark, texts):
    data = [(i, t, "python", "repo", "org/repo", 5, 100, "a.py", DAY, DAY) for i, t in texts.items()]
    return spark.createDataFrame(data, CODE_SAMPLES)


def stored(spark, path, *columns):
    return rows(sinks.read_store(spark, path), *columns)


def windows():
    return fixed_windows("text", 20, 0)


A, B, C = "a" * 19 + ".", "b" * 19 + ".", "c" * 19 + "."


def test_first_of_equal_chunks_wins(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest(samples(spark, {2: A + B, 1: B + A + B, 3: C + A}), path, 0, chunks=windows())
    assert stored(spark, path, "chunk_id", "code") == [("1_0", B), ("1_1", A), ("3_0", C)]


def test_second_run_adds_nothing_and_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    first, second = samples(spark, {1: A + B}), samples(spark, {1: A + B, 2: B + C})
    ingest(first, path, 0, chunks=windows())
    ingest(second, path, 1, chunks=windows())
    before = stored(spark, path, "batch_id", "chunk_id", "code")
    assert before == [(0, "1_0", A), (0, "1_1", B), (1, "2_1", C)]
    ingest(second, path, 1, chunks=windows())
    ingest(second, path, 2, chunks=windows())
    assert stored(spark, path, "batch_id", "chunk_id", "code") == before


def test_skip_by_index_and_by_hash(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest(samples(spark, {1: A}), path, 0, chunks=windows())
    store = sinks.read_store(spark, path)
    changed = samples(spark, {1: B, 2: A})
    assert rows(incremental.skip_known_docs(changed, store), "original_index") == [(2,)]
    assert rows(incremental.skip_known_docs(changed, store, "hash"), "original_index") == [(1,)]
    with pytest.raises(ValueError):
        incremental.skip_known_docs(changed, store, "name")


def test_failed_summary_is_tried_again(spark, tmp_path):
    path = str(tmp_path / "store")

    def broken(texts: pd.Series) -> pd.Series:
        raise RuntimeError("model is down")

    docs = samples(spark, {1: A, 2: B})
    ingest(docs, path, 0, chunks=windows(), summarise=guarded_text(broken))
    assert stored(spark, path, "summary_ok", "summary") == [(False, "Summary unavailable due to LLM error.")] * 2
    ingest(docs, path, 1, chunks=windows(), summarise=guarded_text(broken))
    assert sinks.read_store(spark, path).count() == 2
    ingest(docs, path, 2, chunks=windows())
    usable = sinks.read_store(spark, path).where("summary_ok")
    assert rows(usable, "batch_id", "code", "summary") == [(2, A, A), (2, B, B)]
    ingest(docs, path, 3, chunks=windows())
    assert sinks.read_store(spark, path).where("batch_id = 3").count() == 0


def test_failed_vector_is_tried_again(spark, tmp_path):
    path = str(tmp_path / "store")

    def fragile(texts: pd.Series):
        if texts.str.contains("b").any():
            raise RuntimeError("model is down")
        return [[1.0, 2.0]] * len(texts)

    ingest(samples(spark, {1: B}), path, 0, chunks=windows(), embed=guarded_vector(fragile))
    assert stored(spark, path, "summary_ok", "embedding") == [(False, None)]
    ingest(samples(spark, {1: B}), path, 1, chunks=windows(), embed=guarded_vector(lambda t: [[1.0]] * len(t)))
    usable = sinks.read_store(spark, path).where("summary_ok")
    assert [(r.batch_id, r.embedding) for r in usable.collect()] == [(1, [1.0])]


def test_hot_chunk_in_every_document(spark, tmp_path):
    path = str(tmp_path / "store")
    docs = spark.range(3000).select(F.col("id").alias("original_index"), F.concat(F.lit(A), F.col("id").cast("string")).alias("text"))
    full = docs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in CODE_SAMPLES if f.name not in docs.columns])
    ingest(full, path, 0, chunks=windows())
    store = sinks.read_store(spark, path)
    assert store.count() == 3001
    assert rows(store.where(F.col("code") == A), "chunk_id") == [("0_0",)]


def test_whole_documents(spark, tmp_path):
    path = str(tmp_path / "store")
    ingest_whole(samples(spark, {1: A, 2: "no end mark"}), path, 0)
    assert stored(spark, path, "original_index", "code", "summary_ok", "chunk_id", "code_hash") == [
        (1, A, True, None, None), (2, "no end mark", False, None, None),
    ]


def test_stream_is_the_batch_job(spark, tmp_path):
    incoming, store, checkpoint, batch = (str(tmp_path / n) for n in ("in", "store", "checkpoint", "batch"))

    def run():
        query = stream_ingest(spark, incoming, CODE_SAMPLES, store, checkpoint, chunks=windows())
        query.awaitTermination()

    samples(spark, {1: A + B}).coalesce(1).write.parquet(incoming)
    run()
    run()
    assert stored(spark, store, "batch_id", "code") == [(0, A), (0, B)]
    samples(spark, {2: B + C}).coalesce(1).write.mode("append").parquet(incoming)
    run()
    assert stored(spark, store, "batch_id", "code") == [(0, A), (0, B), (1, C)]
    ingest(samples(spark, {1: A + B}), batch, 0, chunks=windows())
    ingest(samples(spark, {2: B + C}), batch, 1, chunks=windows())
    assert stored(spark, store, "id", "summary") == stored(spark, batch, "id", "summary")


def test_new_checkpoint_must_not_replace_stored_batches(spark, tmp_path):
    incoming, store = str(tmp_path / "in"), str(tmp_path / "store")
    ingest(samples(spark, {1: A}), store, 0, chunks=windows())
    samples(spark, {2: B}).coalesce(1).write.parquet(incoming)
    with pytest.raises(ValueError):
        stream_ingest(spark, incoming, CODE_SAMPLES, store, str(tmp_path / "c1"), chunks=windows())
    stream_ingest(
        spark, incoming, CODE_SAMPLES, store, str(tmp_path / "c2"), first_batch=1, chunks=windows()
    ).awaitTermination()
    assert stored(spark, store, "batch_id", "code") == [(0, A), (1, B)]


def test_blobs_are_stored_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "original_index bigint, text string")
    blobs, index = sinks.externalise(df, str(tmp_path / "blobs"), "b")
    assert [r.body for r in blobs.collect()] == ["x"]
    urls = dict(rows(index, "original_index", "url"))
    assert urls[1] == urls[2] and urls[1].startswith("https://b.s3.amazonaws.com/code_docs/")
    assert urls[3] == "Upload failed"
    more = spark.createDataFrame([(4, "x"), (5, "y")], "original_index bigint, text string")
    blobs, _ = sinks.externalise(more, str(tmp_path / "blobs"), "b")
    assert rows(blobs, "body") == [("x",), ("y",)]


def test_collections(spark, tmp_path):
    path = str(tmp_path / "collections")
    schema = "collection string, id string, document string, embedding array<float>, metadata struct<source_index bigint>"
    entries = spark.createDataFrame([("a", "code_0", "x", [1.0], (0,)), ("b", "code_0", "y", [2.0], (0,))], schema)
    sinks.write_collection(entries, path)
    clash = spark.createDataFrame([("a", "code_0", "changed", [1.0], (0,)), ("a", "code_9", "w", [3.0], (1,))], schema)
    with pytest.raises(ValueError, match="code_0"):
        sinks.write_collection(clash, path)
    more = spark.createDataFrame([("a", "code_0", "x", [1.0], (0,)), ("a", "code_1", "z", [3.0], (1,))], schema)
    sinks.write_collection(more, path)
    assert rows(sinks.read_collections(spark, path), "collection", "id", "document") == [
        ("a", "code_0", "x"), ("a", "code_1", "z"), ("b", "code_0", "y"),
    ]
    only = sinks.read_collections(spark, path, ["b"])
    assert rows(only, "id") == [("code_0",)]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [collection" in plan.replace("isnotnull(collection", "collection")


def test_a_collection_grows_by_every_new_row(spark, tmp_path):
    path = str(tmp_path / "growing")
    schema = "position long, document string, embedding array<float>, metadata struct<source_index bigint>"

    def add(*items):
        made = [(i, text, [1.0], (source,)) for i, (text, source) in enumerate(items)]
        sinks.extend_collection(spark.createDataFrame(made, schema), path, "c", ["position"])

    add(("a", 1), ("b", 2))
    add(("c", 3), ("a", 9))  # the same text from elsewhere is another row
    add(("c", 3), ("d", 4))  # one replayed
    found = rows(sinks.read_collections(spark, path), "id", "document")
    assert found == [("chunk_0", "a"), ("chunk_1", "b"), ("chunk_2", "c"), ("chunk_3", "a"), ("chunk_4", "d")]


def test_a_failing_replay_leaves_the_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    samples = spark.createDataFrame(
        [(1, "Some text. More.", "python", "r", "o/r", 1, 4, "a.py", None, None)], CODE_SAMPLES
    )
    ingest(samples, path, 0, chunks=windows())
    before = stored(spark, path, "batch_id", "code")
    with pytest.raises(Exception):
        ingest(samples, path, 0, chunks=windows(), summarise=lambda c: F.raise_error(F.lit("no model")).cast("string"))
    assert before and stored(spark, path, "batch_id", "code") == before


def test_a_retried_document_is_known(spark, tmp_path):
    path = str(tmp_path / "retried")
    samples = spark.createDataFrame(
        [(i, f"Text {i}. More.", "python", "r", "o/r", 1, 4, "a.py", None, None) for i in range(3)], CODE_SAMPLES
    )
    failing = lambda c: F.when(~F.contains(c, F.lit("Text 1")), c)
    ingest(samples, path, 0, chunks=windows(), summarise=failing)
    ingest(samples, path, 1, chunks=windows())
    assert stored(spark, path, "batch_id", "code") == [(0, "Text 0. More."), (0, "Text 1. More."), (0, "Text 2. More."), (1, "Text 1. More.")]
    left = incremental.skip_known_docs(samples, sinks.read_store(spark, path))
    assert left.count() == 0


def test_no_text_is_sorted_to_reduce_chunks(spark):
    chunks = spark.createDataFrame([(1, 0, "h", "text"), (0, 2, "h", "text"), (0, 1, "h", "text"), (0, 1, "h", "text"), (5, 0, "i", "more")],
                                   "original_index long, chunk_no long, code_hash string, chunk string")
    firsts = incremental.first_of_equal(chunks)
    assert rows(firsts) == [(0, 1, "h", "text"), (5, 0, "i", "more")]
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort" not in plan


@pytest.mark.parametrize("few, hash_joins", [(1000, "BroadcastHashJoin"), (20, "BroadcastHashJoin"), (1, "ShuffledHashJoin")])
def test_first_rows_by_winners_or_losers(spark, few, hash_joins):
    made = [(i % 90, i // 90, f"text {i}") for i in range(100)]  # 90 keys, 10 rows too many
    df = spark.createDataFrame(made, "key long, place long, text string").repartition(4)
    for order in (["place"], []):
        found = incremental.first_rows(df, "key", order, few)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert hash_joins in plan and found.count() == 90 and found.select("key").distinct().count() == 90
        if order:
            assert {r.place for r in found.collect()} == {0}


def test_log_twice_gives_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    answers = spark.createDataFrame([("", f"q{i % 3}", f"a{i % 3}", ["1"], ["1"]) for i in range(9)], QUERY_LOG)
    for _ in range(2):
        sinks.append_log(answers, path)
    assert rows(sinks.read_log(spark, path), "query") == [("q0",), ("q1",), ("q2",)]


def test_log_keeps_good_answers_only(spark, tmp_path):
    path = str(tmp_path / "log")
    assert sinks.read_log(spark, path).count() == 0
    answers = spark.createDataFrame(
        [("", "q1", "good", ["1"], ["1"]), ("", "q2", "bad", ["1"], ["1"]), ("", "q3", None, ["1"], ["1"])], QUERY_LOG
    )
    sinks.append_log(answers, path, good=F.col("final_answer") != "bad")
    assert rows(sinks.read_log(spark, path), "query") == [("q1",)]


def test_a_text_asked_very_often_is_read_in_pieces(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        asked = spark.range(20_000, numPartitions=8).select(
            F.col("id").alias("q_id"), F.when(F.col("id") % 20 > 0, F.lit("the same")).otherwise(F.concat(F.lit("q"), F.col("id"))).alias("query_text")
        )
        log = spark.createDataFrame([("1", "the same", "a", ["1"], ["1"]), ("2", "q40", "b", ["1"], ["1"])], QUERY_LOG)
        found = answer_cache(asked, log)
        assert found.where("cached").count() == 19_001 and found.count() == 20_000
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

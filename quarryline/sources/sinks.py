"""Writers and readers of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import UPLOAD_FAILED
from ..functions.text import content_hash
from ..operators.incremental import first_rows, touched_by
from ..operators.ranking import numbered
from ..schemas import BLOBS, CODE_DOCS, QUERY_LOG
from ..session import BROADCAST_ROWS, at_most, read_table, written


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, CODE_DOCS)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch as a whole; writing it again replaces it.

    The partition is swapped when the job commits, so a failing replay leaves the
    stored batch as it was.  A replay without any row also leaves it.
    """
    columns = [f.name for f in CODE_DOCS.fields if f.name != "batch_id"]
    batch = rows.select(*columns, F.lit(batch_id).cast("bigint").alias("batch_id"))
    batch.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def entry_key(*columns: str) -> Column:
    """What makes an entry the same one in a replay: a hash of the given columns."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def write_collection(entries: DataFrame, path: str) -> None:
    """Append entries (collection, id, document, embedding, metadata); one folder per collection.

    An entry that its collection already holds, by id and by content, is a replay and
    left out.  An id that is taken by other content is an error, never a lost row.
    """
    schema = T.StructType([*entries.schema.fields, T.StructField("entry_key", T.StringType())])
    offered = written(entries.withColumn("entry_key", entry_key("document", "metadata")), "entries")
    stored = read_table(entries.sparkSession, path, schema).select("collection", "id", F.col("entry_key").alias("stored_key"))
    stored = touched_by(offered, stored, "id")
    met = written(offered.select("collection", "id", "entry_key").join(stored, ["collection", "id"]), "met-entries")
    clash = met.where("entry_key <> stored_key").first()
    if clash is not None:
        raise ValueError(f"collection {clash['collection']!r} holds other content under id {clash['id']!r}")
    fresh = offered.join(met, ["collection", "id"], "left_anti").select(schema.fieldNames())
    fresh.write.mode("append").partitionBy("collection").parquet(path)


def extend_collection(rows: DataFrame, path: str, collection: str, order: list[str], prefix: str = "chunk_") -> None:
    """Append rows (document, embedding, metadata and the order columns) under new ids.

    Ids go on from the collection's current count, in the order given.  Rows that the
    collection already holds, by document and metadata, are a replay and left out.  Keys and order
    alone are compared and numbered; the numbers then pick the rows.
    """
    spark = rows.sparkSession
    columns = ["document", "embedding", "metadata"]
    schema = T.StructType(
        [T.StructField("collection", T.StringType()), T.StructField("id", T.StringType())]
        + [rows.schema[c] for c in columns]
        + [T.StructField("entry_key", T.StringType())]
    )
    keyed = rows.withColumn("entry_key", entry_key("document", "metadata"))
    offered = written(keyed.withColumn("_row", F.monotonically_increasing_id()), "offered")
    stored = read_table(spark, path, schema).where(F.col("collection") == collection)
    keys = offered.select("_row", "entry_key", *order)
    fresh = keys.join(touched_by(keys, stored.select("entry_key"), "entry_key"), "entry_key", "left_anti")
    numbers = written(numbered(fresh.drop("entry_key"), order[0], order[1:], "_number").select("_row", "_number"), "numbers")
    numbers = F.broadcast(numbers) if at_most(numbers, BROADCAST_ROWS) else numbers.hint("shuffle_hash")
    placed = offered.join(numbers, "_row")
    ids = F.concat(F.lit(prefix), (F.col("_number") + stored.count()).cast("string"))
    placed.select(F.lit(collection).alias("collection"), ids.alias("id"), *columns, "entry_key").write.mode("append").option(
        "compression", "zstd"
    ).partitionBy("collection").parquet(path)


def read_collections(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Entries of the named collections; only their folders are read."""
    entries = spark.read.parquet(path)
    return entries if names is None else entries.where(F.col("collection").isin(names))


def blob_key(text: Column | str) -> Column:
    """The object name of a text, from its content."""
    return F.concat(F.lit("code_docs/"), content_hash(text), F.lit(".txt"))


def blob_url(key: Column | str, bucket: str) -> Column:
    """Where the object is found; a missing key gives the failure text."""
    url = F.concat(F.lit(f"https://{bucket}.s3.amazonaws.com/"), F.col(key) if isinstance(key, str) else key)
    return F.coalesce(url, F.lit(UPLOAD_FAILED))


def externalise(
    samples: DataFrame, path: str, bucket: str, text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Write text bodies apart from their rows; return (stored blobs, rows with a url).

    The key comes from the content, so equal bodies are stored once, also over
    several runs.  A row without a body gets the failure text as url.
    """
    keyed = samples.withColumn("key", blob_key(text))
    bodies = first_rows(keyed.where(F.col("key").isNotNull()).select("key", F.col(text).alias("body")), "key", [])
    stored = read_table(samples.sparkSession, path, BLOBS).select("key")
    bodies.join(stored, "key", "left_anti").write.mode("append").parquet(path)
    rows = keyed.withColumn("url", blob_url("key", bucket)).drop(text)
    return read_table(samples.sparkSession, path, BLOBS), rows


def append_log(answers: DataFrame, path: str, good: Column | None = None) -> None:
    """Append answered queries to the log; answers that are not good stay out, and so do those it holds.

    Rows need query, final_answer, retrieved_doc_ids and final_doc_ids.
    """
    kept = answers.where(F.col("final_answer").isNotNull() & (F.lit(True) if good is None else good))
    rows = kept.withColumn(
        "id", F.sha2(F.concat_ws("\n", "query", "final_answer"), 256)
    )
    rows = written(rows.select(*QUERY_LOG.fieldNames()).dropDuplicates(["id"]), "answers")
    stored = touched_by(rows, read_log(rows.sparkSession, path).select("id"), "id")
    rows.join(stored, "id", "left_anti").select(*QUERY_LOG.fieldNames()).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, QUERY_LOG)

"""What a store holds, by key: small files that tell a batch which of its documents and chunks are known.

Beside the rows of each batch lie its keys (row position, document hash, chunk hash), dealt by hash into
buckets, a folder each, and for every bucket membership filters: blocked Bloom filters of a bounded number of
keys.  A batch asks the filters of its own buckets first; most of its keys are new, and a filter says so without
a look at the keys.  Only buckets of batches that may hold a key are then read, so what a batch reads follows its own
size and what it shares with the store, not the size of the store.

The listing names the run of each batch that counts and is swapped last, as the rows are there by then.  A stored
batch without an entry (a run that died in between, or a store from before) gets its keys at the next look-up.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CODE_DOCS
from ..session import BROADCAST_ROWS, at_most, read_table, written

BUCKETS = 64
FILTER_KEYS = 1 << 20  # keys of a filter at most
WORDS_PER_KEY = 1 / 4  # 16 bits a key
BITS = 6  # set for each key, all in one word, so a look-up touches one place
PLACES = 5_000  # (batch, bucket) folders that may be named one by one in a scan

KINDS = {"original_index": "index", "doc_hash": "doc", "code_hash": "chunk", "content": "content"}


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LISTING = _table(("version", T.StringType()), ("batch_id", T.LongType()))
_RUN = (("batch_id", T.LongType()), ("version", T.StringType()))
_BUCKET = ("bucket", T.IntegerType())
ROWS = _table(("hash", T.LongType()), ("kind", T.StringType()), ("key", T.StringType()), ("content", T.StringType()), ("ok", T.BooleanType()), *_RUN, _BUCKET)
FILTERS = _table(_BUCKET, ("bits", T.BinaryType()), *_RUN)


def _hash(kind: str, key: Column) -> Column:
    return F.xxhash64(F.lit(kind), key.cast("string"))


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


# --- filters ------------------------------------------------------------------------
def _cells(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each key, and the bits it sets there."""
    h = hashes.astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    word = (h >> np.uint64(40)) * np.uint64(words) >> np.uint64(24)
    g = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bits = np.zeros(len(h), np.uint64)
    for i in range(BITS):
        bits |= np.uint64(1) << ((g >> np.uint64(6 * i + 20)) & np.uint64(63))
    return word.astype(np.int64), bits


def make_filter(hashes: np.ndarray) -> bytes:
    """A filter that holds every hash."""
    words = max(1, int(np.ceil(len(hashes) * WORDS_PER_KEY)))
    out = np.zeros(words, np.uint64)
    word, bits = _cells(hashes, words)
    np.bitwise_or.at(out, word, bits)
    return out.tobytes()


def may_hold(made: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold; never False for one that it was made from."""
    held = np.frombuffer(made, np.uint64)
    word, bits = _cells(hashes, len(held))
    return (held[word] & bits) == bits


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter for every FILTER_KEYS keys of a bucket; rows come bucket by bucket."""
    bucket, parts, n = None, [], 0

    def flush() -> pa.RecordBatch:
        made = make_filter(np.concatenate(parts))
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([made], pa.binary())], names=["bucket", "bits"])

    for batch in batches:
        of, hashes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        at = 0
        while at < len(of):
            if n and (of[at] != bucket or n >= FILTER_KEYS):
                yield flush()
                parts, n = [], 0
            bucket = int(of[at])
            stop = min(int(np.searchsorted(of, bucket, side="right")), at + FILTER_KEYS - n)
            parts.append(hashes[at:stop])
            n, at = n + stop - at, stop
    if n:
        yield flush()


# --- writing ---------------------------------------------------------------------------
def _keys(rows: DataFrame) -> DataFrame:
    """(bucket, hash, kind, key, content, ok): a row for each key of each stored row, once each."""
    rows = rows.withColumn("content", F.coalesce("code_hash", "doc_hash", F.col("original_index").cast("string")))
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("key")) for c, kind in KINDS.items()])
    flat = rows.select(F.explode(entries).alias("e"), "content", F.col("summary_ok").alias("ok"))
    flat = flat.select("e.*", "content", "ok").where("key IS NOT NULL").distinct()
    hashed = F.xxhash64("kind", "key")
    return flat.select(_bucket(hashed).alias("bucket"), hashed.alias("hash"), "kind", "key", "content", "ok")


def index_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Write the keys and filters of a stored batch, then list them; doing it again replaces them."""
    stored = read_table(spark, path, CODE_DOCS).where(F.col("batch_id") == batch_id)
    version = f"v{uuid.uuid4().hex}"
    home = f"{path}/_keys"
    keys = _keys(stored.select("original_index", "doc_hash", "code_hash", "summary_ok"))
    # Ranges of equal size, so that neither a bucket nor a key that many rows share fills a file.
    dealt = keys.repartitionByRange("bucket", "hash", "content").sortWithinPartitions("bucket", "hash")
    rows = f"{home}/rows/batch_id={batch_id}/version={version}"
    dealt.write.option("compression", "zstd").partitionBy("bucket").parquet(rows)
    hashes = read_table(spark, rows, ROWS).select("bucket", "hash").distinct().repartitionByRange("bucket", "hash").sortWithinPartitions("bucket", "hash")
    made = hashes.mapInArrow(_filters, "bucket int, bits binary")
    made.write.parquet(f"{home}/filters/batch_id={batch_id}/version={version}")
    row = spark.range(0, 1, 1, 1).select(F.lit(version).alias("version"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{home}/batches")


# --- looking up --------------------------------------------------------------------------
class KnownKeys:
    """The keys of a store's batches before `before`."""

    def __init__(self, spark: SparkSession, path: str, before: int):
        self.spark, self.home = spark, f"{path}/_keys"
        # File names only; the rows are not read.
        names = read_table(spark, path, CODE_DOCS).inputFiles()
        batches = {int(m[1]) for name in names if (m := re.search(r"/batch_id=(-?\d+)/", name))}
        listed = self._listing()
        for batch_id in sorted(b for b in batches if b < before and b not in listed):
            index_batch(spark, path, batch_id)
        # A row a batch.
        self.versions = [v for b, v in self._listing().items() if b < before and b in batches]

    def _listing(self) -> dict[int, str]:
        return {r["batch_id"]: r["version"] for r in read_table(self.spark, f"{self.home}/batches", LISTING).collect()}

    def _stored(self, what: str, schema: T.StructType) -> DataFrame:
        return read_table(self.spark, f"{self.home}/{what}", schema).where(F.col("version").isin(self.versions))

    def places(self, asked: DataFrame) -> DataFrame:
        """(version, bucket, hash) where a stored batch may hold one of the asked (bucket, hash)."""
        size = asked.groupBy("bucket").count().collect()  # BUCKETS rows at most
        filters = self._stored("filters", FILTERS).where(F.col("bucket").isin([r["bucket"] for r in size])).select("bucket", "version", "bits")

        def ask(keys: pa.Table, filters: pa.Table) -> pa.Table:
            hashes = np.unique(np.asarray(keys.column("hash")))
            out = {"version": [], "bucket": [], "hash": []}
            for row in filters.to_batches(max_chunksize=1) if len(hashes) else []:
                row = row.to_pylist()[0]
                found = hashes[may_hold(row["bits"], hashes)]
                out["version"] += [row["version"]] * len(found)
                out["bucket"] += [row["bucket"]] * len(found)
                out["hash"] += found.tolist()
            return pa.table(out, pa.schema([("version", pa.string()), ("bucket", pa.int32()), ("hash", pa.int64())]))

        # A bucket's keys are cut further, so that a large batch makes groups of bounded size.
        cuts = 1 + max((r["count"] for r in size), default=0) // FILTER_KEYS
        cut = F.pmod(F.shiftright("hash", 8), F.lit(cuts)).alias("cut")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cuts - 1).cast("bigint"))).alias("cut")
        left = asked.select("bucket", "hash", cut).groupBy("bucket", "cut")
        return left.cogroup(filters.select("*", every).groupBy("bucket", "cut")).applyInArrow(ask, "version string, bucket int, hash bigint")

    def touched(self, batch: DataFrame, column: str) -> DataFrame:
        """(column[, content], ok) of the stored keys that the batch offers in a column."""
        kind, data_type = KINDS[column], batch.schema[column].dataType
        names = [column, "ok"] if column == "content" else [column, "content", "ok"]
        kinds = {"content": T.StringType(), "ok": T.BooleanType(), column: data_type}
        empty = self.spark.createDataFrame([], _table(*((name, kinds[name]) for name in names)))
        if not self.versions:
            return empty
        hashed = _hash(kind, F.col(column))
        asked = batch.where(F.col(column).isNotNull()).select(_bucket(hashed).alias("bucket"), hashed.alias("hash"))
        asked = written(asked.distinct(), "asked-keys")
        found = written(self.places(asked), "places")
        places = found.select("version", "bucket").distinct().limit(PLACES + 1).collect()
        if not places:
            return empty
        stored = self._stored("rows", ROWS)
        if len(places) <= PLACES:
            folder = F.concat_ws("/", "version", F.col("bucket").cast("string"))
            stored = stored.where(folder.isin([f"{r['version']}/{r['bucket']}" for r in places]))
        wanted = found.select("hash").distinct()
        wanted = F.broadcast(wanted) if at_most(found, BROADCAST_ROWS) else wanted
        hits = stored.where(F.col("kind") == kind).join(wanted, "hash", "left_semi")
        return hits.withColumn(column, F.col("key").cast(data_type)).select(names)

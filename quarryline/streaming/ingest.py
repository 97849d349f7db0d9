"""Ingest as a stream of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import ingest
from ..session import at_most, spread
from ..sources.sinks import read_store


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has begun with this checkpoint."""
    try:
        spark.read.text(f"{checkpoint}/metadata")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stream_ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    store: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    files: str = "*.parquet",
    files_per_batch: int = 1000,
    first_batch: int = 0,
    **options,
) -> StreamingQuery:
    """Ingest every new file once and stop.

    Each micro-batch runs the batch job under its own batch number, so a batch that
    is replayed after a failure replaces itself.  What is known is looked up in the
    store and not held as stream state.  A new checkpoint counts from `first_batch`,
    which must lie above the batches that the store already holds.
    """
    if not _started(spark, checkpoint):
        taken = read_store(spark, store).where(F.col("batch_id") >= first_batch)
        if not at_most(taken, 0):
            raise ValueError("the store has batches from first_batch on; a new checkpoint would replace them")

    def run(batch: DataFrame, number: int) -> None:
        ingest(spread(prepare(batch), "original_index"), store, first_batch + number, **options)

    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Session, shared folders and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Rows a DataFrame may have to be shipped whole to every task.  Beyond it every
# operator here switches to a shuffled form.
SHIP_ROWS = 50_000


def local_session(app: str = "quarryline", cores: str = "*") -> SparkSession:
    """A session for tests and single-node benches."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="quarryline-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    The files survive the loss of executors, and the plan starts from them.  Hashes in hex and texts
    take much less room with zstd.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# Rows of a narrow table (ids and scores) that may be broadcast to a join.
BROADCAST_ROWS = 1_000_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether `df` has no more than `rows` rows, counting no further than that."""
    return df.limit(rows + 1).count() <= rows


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    A large table already has many splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)

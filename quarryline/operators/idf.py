"""Word vectors weighted by inverse document frequency, without ever rewriting a stored vector.

Stored rows hold plain word counts, which depend on their text alone.  Beside them lie, for each
batch, the number of rows and for each cell the rows that hold it.  Such statistics add up, so the
weights of any version (all batches up to one) are a sum over a row a batch, and a search weighs
stored counts and queries by the version it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import COUNT_DIM, count_words, weighted_vector
from ..session import read_table

#: The rows of a batch that hold a cell; cell -1 stands for the batch itself.
FREQUENCIES = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("df", T.LongType()), T.StructField("batch_id", T.LongType())])


def _swap(rows: DataFrame, path: str, batch_id: int) -> None:
    batch = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def frequencies(counts: DataFrame) -> DataFrame:
    """(cell, df): how many rows hold each cell, combined on the map side; under -1, how many rows there are."""
    held = F.filter(F.transform("counts", lambda n, i: F.when(n > 0, i)), lambda i: i.isNotNull())
    return counts.select(F.explode(F.array_append(held, F.lit(-1))).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("df"))


def add_batch(samples: DataFrame, path: str, batch_id: int, text: str = "text", keep: tuple[str, ...] = ("original_index",)) -> None:
    """Store the counts of a batch with the columns to keep, then its frequencies; adding it again replaces both."""
    rows = samples.select(*keep, count_words(text).alias("counts"))
    _swap(rows, f"{path}/counts", batch_id)
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    stored = read_table(samples.sparkSession, f"{path}/counts", schema).where(F.col("batch_id") == batch_id)
    _swap(frequencies(stored.select("counts")), f"{path}/frequencies", batch_id)


def statistics(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """(rows, rows that hold each cell) of all batches, or of those up to `version`; COUNT_DIM + 1 rows come back."""
    stored = read_table(spark, f"{path}/frequencies", FREQUENCIES)
    if version is not None:
        stored = stored.where(F.col("batch_id") <= version)
    found = {r["cell"]: r["df"] for r in stored.groupBy("cell").agg(F.sum("df").alias("df")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(COUNT_DIM)]


def idf_weights(spark: SparkSession, path: str, version: int | None = None) -> Column:
    """ln((rows + 1) / (rows that hold a cell + 1)) of each cell, COUNT_DIM numbers, as a literal."""
    n, df = statistics(spark, path, version)
    return F.transform(F.lit(df).cast("array<double>"), lambda d: F.log(F.lit(float(n + 1)) / (d + 1)))


def stored_vectors(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Stored rows up to `version` with their weighted vector as `vec`."""
    rows = spark.read.parquet(f"{path}/counts")
    if version is not None:
        rows = rows.where(F.col("batch_id") <= version)
    return rows.withColumn("vec", weighted_vector("counts", idf_weights(spark, path, version))).drop("counts", "batch_id")


def query_vectors(queries: DataFrame, path: str, version: int | None = None) -> DataFrame:
    """Queries with their vector under the same weights as `query_vec`."""
    weights = idf_weights(queries.sparkSession, path, version)
    return queries.withColumn("query_vec", weighted_vector(count_words("query_text"), weights))

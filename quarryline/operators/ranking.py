"""Per-group ranking and dense numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def top_k(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    spread_by: str | None = None,
    salts: int = 32,
) -> DataFrame:
    """The first k rows per key, with their `rank`.

    With `spread_by`, a group is first cut to k rows in each of `salts` slices,
    so the task that finishes a key never sees more than k * salts of its rows.
    """
    if spread_by is not None:
        slices = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
            .withColumn("_place", F.row_number().over(slices))
            .where(F.col("_place") <= k)
            .drop("_slice", "_place")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def numbered(df: DataFrame, major: str, minor: list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of (major, *minor), without one global sort.

    Spark samples the rows to deal them out in ranges of about equal size, so neither an
    outlier nor a frequent value fills one.  The dealt rows are written, as a second
    sampling might differ; then only one count per range meets in a single task.
    """
    ranged = written(df.repartitionByRange(major, *minor).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(major, *minor)
    return (
        ranged.withColumn("_place", F.row_number().over(inside))
        .join(offsets, "_range")
        .withColumn(name, F.col("_offset") + F.col("_place") - 1)
        .drop("_range", "_place", "_offset")
    )

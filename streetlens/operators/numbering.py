"""Positions in the order of a key, without one task for all keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetlens.session import cut


def numbered(keys: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out): the distinct values of ``key`` with their 0-based position (int).

    Values are dealt into ranges; a position is the place within the range plus
    the sizes of the ranges before, of which there are as many as partitions.
    Runs one job.
    """
    dealt = cut(keys.select(key).distinct().repartitionByRange(key).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return dealt.withColumn("_place", place).join(F.broadcast(starts), "_range").select(
        key, (F.col("_start") + F.col("_place") - 1).cast("int").alias(out)
    )

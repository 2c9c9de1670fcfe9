"""The incident table: load-or-ignore, clean copy, aggregate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streetlens.operators import aggregates
from streetlens.schema import BRONZE, BRONZE_COLUMNS, REQUIRED, TABLE_COLUMNS, UNIQUE_KEY
from streetlens.session import scratch_path
from streetlens.sources import files, landing


def anti_existing(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``."""
    return batch.join(existing.select(*keys), list(keys), "left_anti")


def new_rows(
    batch: DataFrame,
    target: DataFrame | None = None,
    key: Sequence[str] = UNIQUE_KEY,
    required: Sequence[str] = REQUIRED,
    order_by: Sequence[str] = (),
    row_id: str | None = None,
) -> DataFrame:
    """The rows of ``batch`` that an insert-or-ignore would add.

    Rows that lack a required value go; of equal keys the first in
    ``order_by`` stays; keys already in ``target`` go. A key with a null in it
    equals no other key, so those rows take a short cut past both steps; with
    ``row_id`` such a row goes if the target has its id already, which makes a
    repeated load add nothing.
    """
    present = batch.na.drop(subset=list(required))
    has_null = F.lit(False)
    for c in key:
        has_null = has_null | F.col(c).isNull()
    free, keyed = present.filter(has_null), present.filter(~has_null)
    order = list(order_by) or [c for c in batch.columns if c not in key] or list(key)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    first = keyed.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    if target is not None:
        first = anti_existing(first, target, key)
        if row_id is not None:
            free = anti_existing(free, target.filter(has_null), [row_id])
    return first.unionByName(free)


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """The incident table; an empty frame of the right shape before the first load."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], BRONZE)
    return spark.read.schema(BRONZE).parquet(path)


WELL_FORMED_MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"


def insert_or_ignore(batch: DataFrame, path: str, order_by: Sequence[str] = ()) -> int:
    """Append new rows to the table at ``path``; the number of added rows.

    Only the months of the batch are read from the table: it is partitioned by
    month, and the month is part of the key. Rows get their id here unless the
    batch has one; rows with a null in the key are known again by it, so that
    loading the same files twice adds nothing.
    """
    spark = batch.sparkSession
    if "id" not in batch.columns:
        batch = landing.with_row_id(batch)
    proper = F.col("month").rlike(WELL_FORMED_MONTH)
    # one entry per calendar month; other texts stand together
    months = [r["m"] for r in batch.select(F.when(proper, F.col("month")).alias("m")).filter(F.col("month").isNotNull()).distinct().collect()]
    if not months:
        return 0
    touched = F.col("month").isin([m for m in months if m is not None])
    if None in months:
        touched = touched | ~proper
    target = load_raw(spark, path).filter(touched)
    before = target.count()  # from file footers, as is the count afterwards
    # few files per month: small months are merged, large ones split
    fresh = new_rows(batch, target, order_by=(*order_by, "id"), row_id="id").select(*TABLE_COLUMNS)
    fresh.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(path)
    return load_raw(spark, path).filter(touched).count() - before


def ingest_months(spark: SparkSession, landing_path: str, table_path: str, quarantine_path: str | None = None,
                  months: Sequence[str] | None = None, multi_line: bool = True) -> int:
    """Scan month files, flatten, load; unreadable ones go to quarantine. Rows added."""
    scan = landing.scan_incident_json(spark, landing_path, multi_line, None if months is None else list(months))
    # parsed once into columns, of which the quarantine, the months and the rows each read their own
    staged = scratch_path(spark, "staged")
    scan.write.parquet(staged)
    scan = spark.read.schema(scan.schema).parquet(staged)
    if quarantine_path is not None:
        landing.quarantined(scan).write.mode("append").parquet(quarantine_path)
    flat = landing.flatten_record(landing.good_records(scan), keep=("file_month", "source_file"))
    return insert_or_ignore(flat, table_path, order_by=("file_month", *[c for c in BRONZE_COLUMNS if c not in UNIQUE_KEY]))


def save_clean(clean: DataFrame, path: str, replace: str = "static") -> None:
    """Write the clean table, partitioned by month so that scans can skip months.

    ``replace`` is ``static`` for the whole table, ``dynamic`` for the months of ``clean`` alone.
    """
    write_months(clean, path, replace)


def write_months(rows: DataFrame, path: str, replace: str) -> None:
    rows.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", replace).partitionBy("month").parquet(path)


def persist_aggregates(features: DataFrame, path: str, replace: str = "static") -> None:
    """Write the three aggregate tables, partitioned by month; ``replace`` as for the clean table.

    The (category, month) counts are made once; the other two follow from
    them. A week belongs to the month that its Monday lies in, so every table's
    rows follow from those of one month.
    """
    month = F.date_format("month_date", "yyyy-MM").alias("month")
    counts = aggregates.count_by(features, "category", "month_date").persist()
    try:
        write_months(counts.groupBy("month_date").agg(F.sum("crime_count").alias("crime_count")).select("*", month), f"{path}/agg_monthly", replace)
        write_months(counts.select("*", month), f"{path}/agg_monthly_category", replace)
        weekly = aggregates.weekly_from_monthly(counts)
        write_months(weekly.select("*", F.date_format("week_start", "yyyy-MM").alias("month")), f"{path}/agg_weekly_category", replace)
    finally:
        counts.unpersist()

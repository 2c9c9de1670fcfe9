"""From landed files to clean, feature and aggregate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetlens.operators.clean import clean
from streetlens.operators.features import coord_extent, engineer
from streetlens.plans.eda import eda_tables
from streetlens.session import cut
from streetlens.sources import files, store


def build(
    spark: SparkSession,
    landing_path: str | None,
    folder: str,
    months: Sequence[str] | None = None,
    multi_line: bool = True,
    bounds: tuple[float, float, float, float] | None = None,
    with_eda: bool = True,
) -> DataFrame:
    """Load new files (if a landing path is given), clean, engineer, save; returns the feature table.

    Only months whose raw rows have changed since the last build are made anew:
    cleaning, features and aggregates work within a month. A table beside the
    results says how many raw rows of each month they were made from; it is
    written last, so a build that failed is done again. Without fixed
    ``bounds`` the grid follows the extent of all clean rows; if that moves, the
    features of all months are made anew. A build without changes writes nothing.
    """
    base = folder.rstrip("/")
    if landing_path is not None:
        store.ingest_months(spark, landing_path, f"{base}/incidents", f"{base}/quarantine", months, multi_line)
    raw = store.load_raw(spark, f"{base}/incidents")
    if raw.isEmpty():
        raise ValueError("the incident table is empty")
    changed, first = changed_months(spark, raw, base)
    if first or changed:
        touched = raw if first else raw.filter(F.col("month").isin(changed))
        store.save_clean(clean(touched), f"{base}/clean", "static" if first else "dynamic")
        silver = spark.read.parquet(f"{base}/clean")
        extent = bounds or tuple(coord_extent(silver).first())
        moved = first or [float(v) for v in _known(spark, base, "bounds")] != [float(v) for v in extent]
        mine = silver if moved else silver.filter(F.col("month").cast("string").isin(changed))
        replace = "static" if moved else "dynamic"
        store.write_months(engineer(mine, bounds=extent), f"{base}/features", replace)
        gold = spark.read.parquet(f"{base}/features")
        fresh = gold if first else gold.filter(F.col("month").cast("string").isin(changed))
        store.persist_aggregates(fresh, f"{base}/aggregates", "static" if first else "dynamic")
        if with_eda:
            for name, table in eda_tables(gold).items():
                table.write.mode("overwrite").parquet(f"{base}/eda/{name}")
        facts = raw.groupBy("month").count().select(F.lit("rows").alias("kind"), "month", F.col("count").cast("string").alias("value"))
        places = spark.createDataFrame([("bounds", str(k), repr(float(v))) for k, v in enumerate(extent)], facts.schema)
        cut(facts.unionByName(places)).coalesce(1).write.mode("overwrite").parquet(f"{base}/built")
    return spark.read.parquet(f"{base}/features")


def _known(spark: SparkSession, base: str, kind: str) -> list[str]:
    rows = spark.read.parquet(f"{base}/built").filter(F.col("kind") == kind).select("month", "value").collect()
    return [r["value"] for r in sorted(rows, key=lambda r: int(r["month"]))]


def changed_months(spark: SparkSession, raw: DataFrame, base: str) -> tuple[list[str], bool]:
    """(months with other raw rows than at the last build, whether there is no build yet). Counts come from file footers."""
    if not files.exists(spark, f"{base}/built") or not files.exists(spark, f"{base}/features"):
        return [], True
    built = spark.read.parquet(f"{base}/built").filter("kind = 'rows'").select("month", F.col("value").cast("long").alias("count"))
    now = raw.groupBy("month").count()
    return [r["month"] for r in now.join(built, ["month", "count"], "left_anti").collect() if r["month"] is not None], False

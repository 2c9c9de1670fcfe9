"""Result tables as CSV or Parquet, filtered exports, labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streetlens.schema import RESULT_TABLES
from streetlens.sources import files


def read_result_csv(spark: SparkSession, path: str, table: str | T.StructType) -> DataFrame:
    """A result table with typed columns; an empty frame of the same shape if it is absent."""
    schema = RESULT_TABLES[table] if isinstance(table, str) else table
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_results(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Replace the named result tables below ``folder``."""
    for name, df in tables.items():
        write_result_csv(df, f"{folder.rstrip('/')}/{name}")


def save_labels(labels: DataFrame, path: str) -> None:
    """Cluster labels per incident, keyed by id so that an overlay joins one to one."""
    columns = ["id", "latitude", "longitude", "month", "category", "kmeans_label", "dbscan_label"]
    labels.select(*columns).write.mode("overwrite").parquet(path)


def export_filtered(filtered: DataFrame, path: str) -> None:
    """The rows that pass the active filters, as CSV with a header."""
    write_result_csv(filtered, path)

"""Intermediate tables in the shared folder, and the size of Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from streetlens.session import scratch_path

ROWS_PER_BATCH = 1000  # texts of a few kilobytes, so some megabytes
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def text_batches(df: DataFrame) -> None:
    """Send texts to Python in batches of ``ROWS_PER_BATCH`` rows, unless the session has a setting of its own."""
    conf = df.sparkSession.conf
    if conf.get(_SETTING) == _DEFAULT:
        conf.set(_SETTING, str(ROWS_PER_BATCH))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: lineage ends, columns stay prunable."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

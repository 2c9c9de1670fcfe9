"""Loading month files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlens.schema import BRONZE_COLUMNS, RECORD, UNIQUE_KEY
from streetlens.sources import landing, store


def stream_records(spark: SparkSession, landing_path: str, multi_line: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """The landing folder as a stream of nested records."""
    schema = T.StructType([*RECORD.fields, T.StructField(landing.CORRUPT, T.StringType())])
    month = F.regexp_extract(F.col("_metadata.file_path"), landing.FILE_MONTH, 1)
    return (
        spark.readStream.schema(schema)
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", landing.CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing_path)
        .withColumns({"file_month": F.nullif(month, F.lit("")), "source_file": F.col("_metadata.file_path")})
    )


def incremental_load(
    spark: SparkSession,
    landing_path: str,
    table_path: str,
    checkpoint_path: str,
    quarantine_path: str | None = None,
    multi_line: bool = False,
    files_per_batch: int = 1000,
) -> None:
    """Load every file that has not been seen yet, then stop.

    Known rows are ignored by key, or by their id where the key has a null, and
    the quarantine of a batch is a folder of its own that a repeated batch
    replaces; so a batch that is repeated after a failure adds nothing twice. There is no watermark: files for old months are
    accepted at any time, and no state grows with the table.
    """

    def load(batch: DataFrame, number: int) -> None:
        # the batch is read for the months, the rows and the quarantine
        batch = batch.persist()
        try:
            if quarantine_path is not None:
                landing.quarantined(batch).write.mode("overwrite").parquet(f"{quarantine_path}/batch={number}")
            flat = landing.flatten_record(landing.good_records(batch), keep=("file_month", "source_file"))
            order = ("file_month", *[c for c in BRONZE_COLUMNS if c not in UNIQUE_KEY])
            store.insert_or_ignore(flat, table_path, order)
        finally:
            batch.unpersist()

    query = (
        stream_records(spark, landing_path, multi_line, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

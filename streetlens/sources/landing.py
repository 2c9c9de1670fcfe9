"""Monthly JSON files: landing, scanning, flattening, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlens.functions import geo
from streetlens.schema import BRONZE_COLUMNS, RECORD
from streetlens.sources import files

CORRUPT = "_corrupt_record"
# crimes_YYYY-MM.json, or a folder month=YYYY-MM
FILE_MONTH = r"(?:crimes_|file_month=)(\d{4}-\d{2})"
FOLDER, MARKS = "file_month=", "_landed"


def scan_incident_json(spark: SparkSession, path: str, multi_line: bool = True, only_months: list[str] | None = None) -> DataFrame:
    """Read month files as nested records with ``file_month``, ``source_file`` and the corrupt-record text.

    ``multi_line`` is for one JSON array per file; landed tables hold one
    record per line, which Spark can split within a file.
    """
    schema = T.StructType([*RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(schema).option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    )
    if only_months is None:
        found = reader.json(path)
    else:  # of the landed months only the folders asked for are listed and read
        base, wanted = path.rstrip("/"), list(dict.fromkeys(only_months))
        names = set(files.child_names(spark, path))
        chosen = [f"{base}/{n}" for m in wanted for n in (f"{FOLDER}{m}", f"crimes_{m}.json") if n in names]
        if any(n.startswith(FOLDER) for n in names):
            if not chosen:
                none = F.lit(None).cast("string")
                return spark.createDataFrame([], schema).withColumns({"file_month": none, "source_file": none})
            found = reader.json(chosen)
        else:
            found = reader.option("pathGlobFilter", "crimes_{" + ",".join(wanted) + "}.json").json(path)
    month = F.regexp_extract(F.col("_metadata.file_path"), FILE_MONTH, 1)
    return found.withColumns({"file_month": F.nullif(month, F.lit("")), "source_file": F.col("_metadata.file_path")})


# True for every row. The JSON source refuses to fill the corrupt-record column
# alone, so both filters below must also look at an ordinary column.
def _any_id() -> Column:
    return F.coalesce(F.col("id"), F.lit(0)) >= F.lit(-(2**63))


def good_records(scan: DataFrame) -> DataFrame:
    return scan.filter(F.col(CORRUPT).isNull() & _any_id()).drop(CORRUPT)


def quarantined(scan: DataFrame) -> DataFrame:
    """Unreadable files or lines, with the month they were meant for."""
    return scan.filter(F.col(CORRUPT).isNotNull() & _any_id()).select("file_month", F.col(CORRUPT).alias("payload"))


def flatten_record(records: DataFrame, null_category: str = "unknown", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested records to the flat columns; rows without a usable coordinate are dropped.

    A missing month is taken from ``file_month``. A missing category becomes
    'unknown', or drops the row with ``null_category='drop'``.
    """
    if null_category not in ("unknown", "drop"):
        raise ValueError(null_category)

    def blank_to_null(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    category = F.col("category")
    flat = records.select(
        *keep,
        F.col("id").alias("api_id"),
        (F.coalesce(category, F.lit("unknown")) if null_category == "unknown" else category).alias("category"),
        F.coalesce(blank_to_null(F.col("month")), F.col("file_month")).alias("month"),
        geo.coordinate(F.col("location.latitude")).alias("latitude"),
        geo.coordinate(F.col("location.longitude")).alias("longitude"),
        F.col("location.location_type").alias("location_type"),
        F.col("location.street.id").alias("street_id"),
        F.col("location.street.name").alias("street_name"),
        blank_to_null(F.col("context")).alias("context"),
        F.col("outcome_status.category").alias("outcome_category"),
        F.col("outcome_status.date").alias("outcome_date"),
        blank_to_null(F.col("persistent_id")).alias("persistent_id"),
    )
    usable = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    if null_category == "drop":
        usable = usable & F.col("category").isNotNull()
    return flat.filter(usable).select(*keep, *BRONZE_COLUMNS)


def with_row_id(flat: DataFrame) -> DataFrame:
    """Add ``id``: a hash of the source file (if known), the record and its number among equal records of that file.

    The same file gives the same ids whenever and in whatever order it is read.
    """
    known = [c for c in ("source_file", *BRONZE_COLUMNS) if c in flat.columns]
    copies = Window.partitionBy("_record").orderBy(*known)
    return (
        flat.withColumn("_record", F.xxhash64(*known))
        .withColumn("id", F.xxhash64("_record", F.row_number().over(copies), *known)).drop("_record")
    )


def landed_months(spark: SparkSession, path: str) -> list[str]:
    """Months that were landed completely: those with a mark, which is written after the month's files."""
    return sorted(n for n in files.child_names(spark, f"{path.rstrip('/')}/{MARKS}") if n[:1].isdigit())


def land_month(records: DataFrame, path: str, reuse: bool = True, rows_per_file: int = 2_000_000) -> None:
    """Write nested records below ``path``, one folder per ``file_month``, and mark the months that are complete.

    With ``reuse``, marked months are left as they are; otherwise they are
    replaced. A month's folder without a mark is what a failure left half
    written: it is replaced as a whole. A large month is spread over several files.
    """
    spark = records.sparkSession
    if not reuse:  # nothing counts as complete while it is being replaced
        files.remove(spark, f"{path.rstrip('/')}/{MARKS}")
    done = landed_months(spark, path)
    todo = records.filter(~F.col("file_month").isin(done)) if done else records
    (
        todo.hint("rebalance", "file_month").write.partitionBy("file_month").option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic" if reuse else "static").mode("overwrite").json(path)
    )
    written = [n[len(FOLDER):] for n in files.child_names(spark, path) if n.startswith(FOLDER)]
    wanted = {r["file_month"] for r in todo.select("file_month").distinct().collect()} if done else set(written)
    for month in sorted(wanted & set(written)):
        files.touch(spark, f"{path.rstrip('/')}/{MARKS}/{month}")

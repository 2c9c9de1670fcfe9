"""Checks of landing, loading and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    ALIASED, CANON, NORMAL, WITH_CLEAN, WITH_COV, WITH_FEATURES, WITH_INC, _list, check, cleaned, features, month_sql, on, raw,
)
from streetlens import config
from streetlens.functions import dates, geo, text
from streetlens.incident_view import nested_records
from streetlens.operators import clean as ops
from streetlens.schema import BRONZE_COLUMNS
from streetlens.session import scratch_path
from streetlens.sources import landing, results, store

INC_COLUMNS = "id, api_id, category, month, latitude, longitude, street_id, street_name, outcome_category"

# nested records in SQL, already flat; the coordinate texts are cast here
REC = """rec AS (
  SELECT o_orderkey AS id, o_orderkey % 50 AS odd, o_custkey % 200 AS k, strftime(o_orderdate, '%Y-%m') AS file_month,
    o_orderstatus AS status,
    (533100 + (o_custkey % 200 % 8) * 200 + ((o_custkey % 200 // 8) % 5) * 5) / 10000.0::DOUBLE AS lat,
    -((16200 - ((o_custkey % 200 % 8 * 5) % 8) * 350 - ((o_custkey % 200 // 8) // 5) * 5) / 10000.0::DOUBLE) AS lng
  FROM orders),
flat AS (
  SELECT id AS api_id, CASE WHEN odd = 7 THEN 'unknown' ELSE cat END AS category, file_month AS month,
    lat AS latitude, lng AS longitude, 'Force' AS location_type,
    CASE WHEN odd <> 6 THEN k END AS street_id,
    CASE WHEN odd <> 6 THEN 'On or near Street ' || CAST(k AS VARCHAR) END AS street_name,
    CASE WHEN odd % 2 = 1 THEN 'note' END AS context,
    CASE WHEN odd <> 10 THEN status END AS outcome_category,
    CASE WHEN odd <> 10 THEN file_month END AS outcome_date,
    CASE WHEN odd <> 11 THEN 'p' || CAST(id AS VARCHAR) END AS persistent_id
  FROM rec JOIN (SELECT id, category AS cat FROM inc) USING (id)
  WHERE odd NOT IN (1, 2, 3, 4, 5))"""


def _records(spark, folder):
    return nested_records(spark.read.parquet(f"{folder}/orders.parquet"))


@check("scan_incident_json", on(
    WITH_INC, """SELECT file_month, CAST(count(*) AS BIGINT) AS records, CAST(count(CASE WHEN odd <> 5 THEN 1 END) AS BIGINT) AS located
  FROM rec GROUP BY 1""", REC))
def scan_incident_json(spark, folder):
    path = scratch_path(spark, "landing")
    landing.land_month(_records(spark, folder), path)
    scan = landing.good_records(landing.scan_incident_json(spark, path, multi_line=False))
    return scan.groupBy("file_month").agg(
        F.count(F.lit(1)).alias("records"), F.count("location").alias("located")
    )


@check("quarantine_corrupt", """SELECT strftime(o_orderdate, '%Y-%m') AS file_month, CAST(count(*) AS BIGINT) AS bad_lines
  FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""")
def quarantine_corrupt(spark, folder):
    """Orders in status P are landed as truncated lines, all others as good ones."""
    path = scratch_path(spark, "landing")
    line = F.to_json(F.struct("id", "category", "month", "location", "outcome_status"))
    records = _records(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    lines = records.join(orders, "id").select(
        F.when(F.col("o_orderstatus") == "P", F.substring(line, 1, 20)).otherwise(line).alias("value"), "file_month"
    )
    lines.hint("rebalance", "file_month").write.partitionBy("file_month").text(path)
    # the reader fills the corrupt-record column only together with the others
    scan = landing.scan_incident_json(spark, path, multi_line=False)
    bad = landing.quarantined(scan)
    return bad.groupBy("file_month").agg(F.count("payload").alias("bad_lines"))


@check("land_month", on(
    WITH_INC, "SELECT file_month, CAST(count(*) AS BIGINT) AS records FROM rec GROUP BY 1", REC))
def land_month(spark, folder):
    """Landing the same months again changes nothing."""
    path = scratch_path(spark, "landing")
    records = _records(spark, folder)
    landing.land_month(records, path)
    landing.land_month(records, path)
    return (
        landing.scan_incident_json(spark, path, multi_line=False)
        .groupBy("file_month").agg(F.count("id").alias("records"))
    )


@check("flatten_record", on(WITH_INC, f"SELECT {', '.join(BRONZE_COLUMNS)} FROM flat", REC))
def flatten_record(spark, folder):
    return landing.flatten_record(_records(spark, folder))


@check("json_extract", on(
    WITH_INC, """SELECT id, CASE WHEN odd NOT IN (5, 6) THEN 'On or near Street ' || CAST(k AS VARCHAR) END AS street_name,
  CASE WHEN odd <> 10 THEN status END AS outcome FROM rec""", REC))
def json_extract(spark, folder):
    """Nested access on records that went through JSON text."""
    from streetlens.schema import RECORD

    line = F.to_json(F.struct("id", "category", "month", "location", "outcome_status"))
    parsed = _records(spark, folder).select(F.from_json(line, RECORD).alias("r"))
    return parsed.select("r.id", F.col("r.location.street.name").alias("street_name"),
                         F.col("r.outcome_status.category").alias("outcome"))


NEW = """old AS (SELECT * FROM flat WHERE month <= '1998-06'),
twice AS (SELECT *, 1 AS turn FROM flat UNION ALL SELECT *, 2 AS turn FROM flat),
fresh AS (
  SELECT * FROM twice WHERE api_id IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM old o WHERE o.api_id = twice.api_id AND o.month = twice.month AND o.category = twice.category
      AND o.latitude = twice.latitude AND o.longitude = twice.longitude)
  QUALIFY row_number() OVER (PARTITION BY api_id, month, category, latitude, longitude ORDER BY turn) = 1
  UNION ALL SELECT * FROM twice WHERE api_id IS NULL)"""
# every 89th id is unknown in this batch
NULLED = "SELECT * REPLACE (CASE WHEN api_id % 89 <> 0 THEN api_id END AS api_id) FROM flat"


def _batch(spark, folder):
    flat = landing.flatten_record(_records(spark, folder))
    return flat.withColumn("api_id", F.when(F.col("api_id") % 89 != 0, F.col("api_id")))


@check("insert_or_ignore", on(
    WITH_INC, f"SELECT {', '.join(BRONZE_COLUMNS)} FROM fresh",
    REC.replace("flat AS", "flat1 AS"), f"flat AS ({NULLED.replace('FROM flat', 'FROM flat1')})", NEW))
def insert_or_ignore(spark, folder):
    """Every record arrives twice; the months up to 1998-06 are in the table already."""
    batch = _batch(spark, folder)
    twice = batch.withColumn("turn", F.lit(1)).unionByName(batch.withColumn("turn", F.lit(2)))
    target = batch.filter(F.col("month") <= "1998-06")
    return store.new_rows(twice, target, order_by=("turn",)).select(*BRONZE_COLUMNS)


@check("anti_existing", on(
    WITH_INC, """SELECT DISTINCT month, street_id FROM inc WHERE (month, street_id) NOT IN (
  SELECT (month, street_id) FROM inc WHERE outcome_category = 'P')"""))
def anti_existing(spark, folder):
    """Months and streets without an incident in status P."""
    df = raw(spark, folder)
    keys = ["month", "street_id"]
    return store.anti_existing(df.select(*keys).distinct(), df.filter("outcome_category = 'P'"), keys)


@check("ingest_months", on(
    WITH_INC, """SELECT month, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT api_id) AS BIGINT) AS ids FROM flat GROUP BY 1""", REC))
def ingest_months(spark, folder):
    """Land, scan, flatten, load; a second run adds nothing."""
    landed, table = scratch_path(spark, "landing"), scratch_path(spark, "incidents")
    landing.land_month(_records(spark, folder), landed)
    for _ in range(2):
        store.ingest_months(spark, landed, table, multi_line=False)
    return store.load_raw(spark, table).groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("api_id").alias("ids")
    )


@check("load_raw", on(WITH_INC, f"""SELECT {', '.join(BRONZE_COLUMNS)}, count(*) OVER () AS ids FROM inc WHERE latitude IS NOT NULL"""))
def load_raw(spark, folder):
    """The stored columns; the row ids are hashes that SQL cannot repeat, so the distinct ones are counted beside."""
    path = scratch_path(spark, "incidents")
    store.insert_or_ignore(raw(spark, folder).select(*BRONZE_COLUMNS), path)
    stored = store.load_raw(spark, path)
    return stored.select(*BRONZE_COLUMNS).withColumn("ids", stored.agg(F.count_distinct("id").alias("ids")).scalar())


@check("save_clean", on(WITH_CLEAN, "SELECT id, category, month, latitude, longitude, street_name, month_date FROM cl"))
def save_clean(spark, folder):
    path = scratch_path(spark, "clean")
    store.save_clean(cleaned(spark, folder), path)
    return spark.read.option("inferSchema", True).parquet(path).select(
        "id", "category", F.col("month").cast("string").alias("month"), "latitude", "longitude", "street_name", "month_date"
    )


@check("persist_aggregates", on(WITH_CLEAN, """SELECT 'monthly' AS name, month_date, CAST(NULL AS VARCHAR) AS category,
    count(*)::DOUBLE AS crime_count FROM cl GROUP BY month_date
  UNION ALL SELECT 'category', month_date, category, count(*)::DOUBLE FROM cl GROUP BY month_date, category
  UNION ALL SELECT 'weekly', CAST(d AS DATE), category, round(n / len(ds), 6) FROM (
    SELECT category, n, ds, unnest(ds) AS d FROM (
      SELECT category, count(*)::DOUBLE AS n, [x FOR x IN generate_series(month_date::TIMESTAMP, last_day(month_date)::TIMESTAMP,
        INTERVAL 1 DAY) IF dayofweek(x) = 1] AS ds FROM cl GROUP BY category, month_date))"""))
def persist_aggregates(spark, folder):
    path = scratch_path(spark, "aggregates")
    store.persist_aggregates(cleaned(spark, folder), path)
    monthly = spark.read.parquet(f"{path}/agg_monthly").withColumn("category", F.lit(None).cast("string"))
    by_category = spark.read.parquet(f"{path}/agg_monthly_category")
    weekly = spark.read.parquet(f"{path}/agg_weekly_category").withColumnRenamed("week_start", "month_date")
    parts = [("monthly", monthly), ("category", by_category), ("weekly", weekly)]
    out = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("name"), "month_date", "category",
                         F.round(F.col("crime_count").cast("double"), 6).alias("crime_count"))
        out = part if out is None else out.unionByName(part)
    return out


@check("read_result_csv", on(WITH_CLEAN, """SELECT month_date, category, count(*)::DOUBLE AS rf_forecast FROM cl GROUP BY 1, 2"""))
def read_result_csv(spark, folder):
    path = scratch_path(spark, "results")
    table = cleaned(spark, folder).groupBy("month_date", "category").agg(F.count(F.lit(1)).cast("double").alias("rf_forecast"))
    results.write_results({"forecast_rf_future": table}, path)
    absent = results.read_result_csv(spark, f"{path}/absent", "forecast_rf_future")
    return results.read_result_csv(spark, f"{path}/forecast_rf_future", "forecast_rf_future").unionByName(absent)


@check("write_results", on(WITH_CLEAN, """SELECT month_date, count(*)::DOUBLE AS rf_forecast FROM cl GROUP BY 1"""))
def write_results(spark, folder):
    path = scratch_path(spark, "results")
    table = cleaned(spark, folder).groupBy("month_date").agg(F.count(F.lit(1)).cast("double").alias("rf_forecast"))
    results.write_results({"forecast_rf_future_total": table}, path)
    return results.read_result_csv(spark, f"{path}/forecast_rf_future_total", "forecast_rf_future_total")


# ---- cleaning steps ----------------------------------------------------------
@check("valid_coords", on(WITH_INC, f"""SELECT {INC_COLUMNS} FROM inc WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""))
def valid_coords(spark, folder):
    return ops.validate_coords(raw(spark, folder), None).select(*INC_COLUMNS.split(", "))


@check("in_polygon", on(WITH_COV, f"SELECT {INC_COLUMNS} FROM cov"))
def in_polygon(spark, folder):
    return ops.validate_coords(raw(spark, folder)).select(*INC_COLUMNS.split(", "))


@check("normalise_text", on(WITH_INC, f"SELECT id, {NORMAL} AS text FROM inc"))
def normalise_text(spark, folder):
    return raw(spark, folder).select("id", text.normalise_text(F.col("category")).alias("text"))


@check("alias_map", on(WITH_INC, f"SELECT id, {ALIASED} AS category FROM inc"))
def alias_map(spark, folder):
    return raw(spark, folder).select("id", text.alias_map(text.normalise_text(F.col("category"))).alias("category"))


@check("unknown_to_other", on(WITH_INC, f"SELECT id, {CANON} AS category FROM inc"))
def unknown_to_other(spark, folder):
    return ops.normalise_categories(raw(spark, folder)).select("id", "category")


@check("unknown_categories", on(WITH_INC, f"""SELECT DISTINCT {ALIASED} AS category FROM inc
  WHERE {ALIASED} NOT IN ({_list(config.CANONICAL_CATEGORIES)})"""))
def unknown_categories(spark, folder):
    return ops.unknown_categories(raw(spark, folder))


@check("dedupe_keep_first", on(WITH_CLEAN, f"SELECT {INC_COLUMNS} FROM ded"))
def dedupe_keep_first(spark, folder):
    df = ops.normalise_categories(ops.validate_coords(raw(spark, folder)))
    return ops.deduplicate(df).select(*INC_COLUMNS.split(", "))


@check("month_to_date", on(WITH_INC, f"SELECT id, {month_sql('month')} AS month_date FROM inc"))
def month_to_date(spark, folder):
    return raw(spark, folder).select("id", dates.month_to_date(F.col("month")).alias("month_date"))


@check("drop_bad_month", on(WITH_INC, f"SELECT id, month, {month_sql('month')} AS month_date FROM inc WHERE {month_sql('month')} IS NOT NULL"))
def drop_bad_month(spark, folder):
    return ops.parse_month(raw(spark, folder)).select("id", "month", "month_date")


@check("clean", on(WITH_CLEAN, f"SELECT {INC_COLUMNS}, month_date FROM cl"))
def clean(spark, folder):
    return cleaned(spark, folder).select(*INC_COLUMNS.split(", "), "month_date")


@check("cleaning_counts", on(WITH_CLEAN, """SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(a AS BIGINT) AS rows_before,
    CAST(b AS BIGINT) AS rows_after, CAST(a - b AS BIGINT) AS dropped FROM (
  SELECT 1 AS step_no, 'coordinates' AS step, (SELECT count(*) FROM inc) AS a, (SELECT count(latitude) FROM inc) AS b
  UNION ALL SELECT 2, 'polygon', (SELECT count(latitude) FROM inc), (SELECT count(*) FROM cov)
  UNION ALL SELECT 3, 'duplicates', (SELECT count(*) FROM cov), (SELECT count(*) FROM ded)
  UNION ALL SELECT 4, 'month', (SELECT count(*) FROM ded), (SELECT count(*) FROM cl))"""))
def cleaning_counts(spark, folder):
    return ops.cleaning_counts(raw(spark, folder))


@check("fine_cell_id", on(WITH_CLEAN, """SELECT id, CAST(round_even(latitude * 1000, 0) AS BIGINT) AS fine_lat,
  CAST(round_even(longitude * 1000, 0) AS BIGINT) AS fine_lng FROM cl"""))
def fine_cell_id(spark, folder):
    lat, lng = geo.fine_cell(F.col("latitude"), F.col("longitude"))
    return cleaned(spark, folder).select("id", lat.alias("fine_lat"), lng.alias("fine_lng"))


@check("engineer", on(WITH_FEATURES, """SELECT id, category, month_date, year, month_num, quarter, season, is_violent, grid_lat,
  grid_lng, grid_id FROM ft"""))
def engineer(spark, folder):
    return features(spark, folder).select(
        "id", "category", "month_date", "year", "month_num", "quarter", "season", "is_violent", "grid_lat", "grid_lng", "grid_id"
    )


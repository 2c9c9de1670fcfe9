"""Incidents derived from an orders table, for checks and benchmarks.

Only integer arithmetic and fixed steps are used, so that other engines derive
the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spelling variants by order key modulo 18
RAW_CATEGORIES = (
    "anti-social", "Anti-Social-Behaviour ", "bicycle-theft", "burglary", "criminal-damage-arson", "drugs",
    "other-theft", "possession-of-weapons", "public-order", "robbery", "shoplifting", "theft-from-the-person",
    "vehicle-crime", "violence-and-sexual-offences", " Violent-Crime", "other-crime", "unknown-new-cat", "Burglary",
)


def incidents(orders: DataFrame) -> DataFrame:
    """One raw incident per order.

    The coordinates pass through a generator, so that later filters see plain
    columns, as in a stored table, and do not repeat the arithmetic below.
    """
    key = F.col("o_orderkey")
    k = F.col("o_custkey") % 200
    hub = k % 8
    spot = F.floor(k / 8)
    lat = F.lit(53.31) + hub * F.lit(0.02) + (spot % 5) * F.lit(0.0005)
    lng = F.lit(-1.62) + ((hub * 5) % 8) * F.lit(0.035) + F.floor(spot / 5) * F.lit(0.0005)
    categories = F.array(*[F.lit(c) for c in RAW_CATEGORIES])
    place = F.struct(F.when(key % 101 != 0, lat).alias("latitude"), lng.alias("longitude"))
    return orders.select(
        key.alias("id"),
        F.when(key % 89 != 0, key).alias("api_id"),
        F.element_at(categories, (key % 18 + 1).cast("int")).alias("category"),
        F.when(key % 997 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
        F.inline(F.array(place)),
        F.lit("Force").alias("location_type"),
        k.alias("street_id"),
        F.concat(F.lit("On or near Street "), k.cast("string")).alias("street_name"),
        F.lit(None).cast("string").alias("context"),
        F.col("o_orderstatus").alias("outcome_category"),
        F.date_format("o_orderdate", "yyyy-MM").alias("outcome_date"),
        F.concat(F.lit("p"), key.cast("string")).alias("persistent_id"),
    )


def read_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return incidents(spark.read.parquet(f"{folder}/orders.parquet"))


def nested_records(orders: DataFrame) -> DataFrame:
    """The same incidents as nested records with coordinates as text, and ``file_month``.

    Every so often a coordinate, the month, the category or the whole location
    is missing or malformed, as in published files. The records pass through a
    generator for the same reason as above.
    """
    key = F.col("o_orderkey")
    k = F.col("o_custkey") % 200
    # latitude and longitude as decimal text with a fixed number of digits
    lat_units = 533100 + (k % 8) * 200 + (F.floor(k / 8) % 5) * 5
    lat_text = F.concat(
        F.floor(lat_units / 10000).cast("string"), F.lit("."), F.lpad((lat_units % 10000).cast("string"), 4, "0")
    )
    lng_units = 16200 - ((k % 8 * 5) % 8) * 350 - F.floor(F.floor(k / 8) / 5) * 5
    lng_text = F.concat(
        F.lit("-"), F.floor(lng_units / 10000).cast("string"), F.lit("."), F.lpad((lng_units % 10000).cast("string"), 4, "0")
    )
    base = orders.select(
        key.alias("id"),
        (key % 50).alias("odd"),
        F.element_at(F.array(*[F.lit(c) for c in RAW_CATEGORIES]), (key % 18 + 1).cast("int")).alias("cat"),
        F.date_format("o_orderdate", "yyyy-MM").alias("file_month"),
        lat_text.alias("lat"),
        lng_text.alias("lng"),
        k.alias("k"),
        F.col("o_orderstatus").alias("status"),
    )
    odd = F.col("odd")
    street = F.struct(F.col("k").alias("id"), F.concat(F.lit("On or near Street "), F.col("k").cast("string")).alias("name"))
    location = F.struct(
        F.when(odd == 1, F.lit("n/a")).when(odd == 2, F.lit("53.38d")).when(odd != 3, F.col("lat")).alias("latitude"),
        F.when(odd == 4, F.lit("nan")).otherwise(F.col("lng")).alias("longitude"),
        F.lit("Force").alias("location_type"),
        F.when(odd != 6, street).alias("street"),
    )
    record = F.struct(
        F.col("id"),
        F.when(odd != 7, F.col("cat")).alias("category"),
        F.when(odd == 8, F.lit("")).when(odd != 9, F.col("file_month")).alias("month"),
        F.when(odd != 5, location).alias("location"),
        F.when(odd % 2 == 0, F.lit("")).otherwise(F.lit("note")).alias("context"),
        F.when(odd != 10, F.struct(F.col("status").alias("category"), F.col("file_month").alias("date"))).alias("outcome_status"),
        F.when(odd == 11, F.lit("")).otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("persistent_id"),
        F.col("file_month"),
    )
    return base.select(F.inline(F.array(record)))

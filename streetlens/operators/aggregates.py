"""Counts and summaries over the feature frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions import dates, geo
from streetlens.operators.features import bounds_struct, coord_extent
from streetlens.session import cut


def count_by(df: DataFrame, *keys: str, name: str = "crime_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def monthly_totals(df: DataFrame) -> DataFrame:
    return count_by(df, "month_date").orderBy("month_date")


def monthly_by_category(df: DataFrame) -> DataFrame:
    return count_by(df, "category", "month_date").orderBy("category", "month_date")


def weekly_by_category(df: DataFrame) -> DataFrame:
    """The monthly count spread evenly over the Mondays inside that month."""
    return weekly_from_monthly(count_by(df, "category", "month_date"))


def weekly_from_monthly(counts: DataFrame) -> DataFrame:
    """The same from (category, month) counts."""
    mondays = dates.mondays_of_month(F.col("month_date"))
    return counts.select(
        "category",
        F.explode(mondays).alias("week_start"),
        (F.col("crime_count") / F.size(mondays)).alias("crime_count"),
    ).select("week_start", "category", "crime_count")


def category_counts(df: DataFrame, ascending: bool = True) -> DataFrame:
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return count_by(df, "category", name="count").orderBy(order, "category")


def year_month_pivot(df: DataFrame, months: Sequence[int] = tuple(range(1, 13))) -> DataFrame:
    """Years down, months across; a fixed month list saves the job that would look for it."""
    wide = df.groupBy("year").pivot("month_num", list(months)).agg(F.count(F.lit(1)))
    return wide.select(
        "year", *[F.coalesce(F.col(f"`{m}`"), F.lit(0)).cast("bigint").alias(f"m{m:02d}") for m in months]
    ).orderBy("year")


def hexbin_density(df: DataFrame, cells: int = config.GRID.hex_cells) -> DataFrame:
    """Non-empty hexagons with their centre and count.

    Rows are first counted per distinct coordinate, which removes most of the
    work where many incidents share a point; the extent comes from the same
    counts.
    """
    points = cut(count_by(df, "latitude", "longitude", name="n"))
    return (
        points.withColumn("bounds", bounds_struct(coord_extent(points)).scalar())
        .withColumn("hex", geo.hex_cell(F.col("longitude"), F.col("latitude"), F.col("bounds"), cells))
        .groupBy("hex.lattice", "hex.hx", "hex.hy")
        .agg(F.first("hex.lng_c").alias("lng_c"), F.first("hex.lat_c").alias("lat_c"), F.sum("n").alias("count"))
    )


def grid_choropleth(df: DataFrame, bounds: DataFrame, cells: int = config.GRID.cells) -> DataFrame:
    """Count per grid cell with its centre, from the bounds that made the grid."""
    b = F.col("bounds")
    return (
        df.groupBy("grid_id", "grid_lat", "grid_lng")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bounds", bounds_struct(bounds).scalar())
        .withColumns({
            "lat_c": geo.grid_centre(F.col("grid_lat"), b["lat_min"], b["lat_max"], cells),
            "lng_c": geo.grid_centre(F.col("grid_lng"), b["lng_min"], b["lng_max"], cells),
        })
        .drop("bounds")
    )


def kpis(df: DataFrame) -> DataFrame:
    """total, months, avg_per_month, top_category, streets in one row.

    One shuffle counts (category, month, street); the distinct counts and the
    top category are then read from that much smaller table.
    """
    cube = cut(count_by(df, "category", "month_date", "street_name", name="n"))
    top = (
        cube.groupBy("category").agg(F.sum("n").alias("n"))
        .agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("top"))
    )
    return (
        cube.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count_distinct("month_date").alias("months"),
            F.count_distinct("street_name").alias("streets"),
        )
        .select(
            "total", "months",
            F.round(F.coalesce(F.try_divide("total", "months"), F.lit(0.0)), 1).alias("avg_per_month"),
            top.scalar().alias("top_category"),
            "streets",
        )
    )


def category_list(df: DataFrame) -> DataFrame:
    return df.select("category").distinct().orderBy("category")


def month_list(df: DataFrame) -> DataFrame:
    return df.select("month").distinct().orderBy("month")


def month_span(df: DataFrame) -> DataFrame:
    return df.agg(
        F.trunc(F.min("month_date"), "MM").alias("first_month"), F.trunc(F.max("month_date"), "MM").alias("last_month")
    )


def street_list(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Street names in alphabetical order; only the first ``limit`` if that is given."""
    streets = df.select("street_name").filter(F.col("street_name").isNotNull()).distinct().orderBy("street_name")
    return streets if limit is None else streets.limit(limit)

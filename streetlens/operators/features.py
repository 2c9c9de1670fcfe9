"""Row features: calendar, target flag, spatial grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions import dates, geo, text


def add_temporal(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "year": F.year("month_date"),
        "month_num": F.month("month_date"),
        "quarter": F.quarter("month_date"),
        "season": dates.season(F.month("month_date")),
    })


def add_target(df: DataFrame) -> DataFrame:
    return df.withColumn("is_violent", text.violent_flag(F.col("category")))


def coord_extent(df: DataFrame) -> DataFrame:
    """One row: lat_min, lat_max, lng_min, lng_max."""
    return df.agg(
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lng_min"), F.max("longitude").alias("lng_max"),
    )


def bounds_struct(extent: DataFrame) -> DataFrame:
    return extent.select(F.struct("lat_min", "lat_max", "lng_min", "lng_max").alias("bounds"))


def with_bounds(df: DataFrame, bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Attach the extent of the whole frame to each row as the struct ``bounds``.

    Given fixed bounds (lat_min, lat_max, lng_min, lng_max) no second pass over
    the data is needed, and cells do not move when data is added. Otherwise the
    extent is a scalar subquery with a single row.
    """
    if bounds is None:
        return df.withColumn("bounds", bounds_struct(coord_extent(df)).scalar())
    names = ("lat_min", "lat_max", "lng_min", "lng_max")
    return df.withColumn("bounds", F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, bounds)]))


def add_spatial_bins(
    df: DataFrame,
    cells: int = config.GRID.cells,
    bounds: tuple[float, float, float, float] | None = None,
    keep_bounds: bool = False,
) -> DataFrame:
    """Grid row, column and text id. With ``keep_bounds`` the extent stays as a column."""
    b = F.col("bounds")
    out = (
        with_bounds(df, bounds)
        .withColumns({
            "grid_lat": geo.grid_bin(F.col("latitude"), b["lat_min"], b["lat_max"], cells),
            "grid_lng": geo.grid_bin(F.col("longitude"), b["lng_min"], b["lng_max"], cells),
        })
        .withColumn("grid_id", F.concat_ws("_", "grid_lat", "grid_lng"))
    )
    return out if keep_bounds else out.drop("bounds")


def engineer(
    df: DataFrame,
    cells: int = config.GRID.cells,
    bounds: tuple[float, float, float, float] | None = None,
    keep_bounds: bool = False,
) -> DataFrame:
    """Clean frame to feature frame."""
    return (
        df.transform(add_temporal).transform(add_target).transform(add_spatial_bins, cells, bounds, keep_bounds)
    )

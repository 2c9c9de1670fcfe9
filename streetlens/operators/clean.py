"""Cleaning: coordinates, categories, duplicates, months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions import dates, geo, text


def validate_coords(df: DataFrame, polygon: Sequence[tuple[float, float]] | None = config.AREA_POLYGON) -> DataFrame:
    """Keep rows with a usable coordinate, covered by ``polygon`` if one is given."""
    lat, lng = F.col("latitude"), F.col("longitude")
    keep = geo.valid_coords(lat, lng)
    if polygon is not None:
        keep = keep & geo.covered_by(lat, lng, polygon)
    return df.filter(keep)


def normalise_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("category", text.canonical_category(F.col("category")))


def unknown_categories(df: DataFrame, known: Sequence[str] = config.CANONICAL_CATEGORIES) -> DataFrame:
    """Categories that normalisation does not know."""
    seen = df.select(text.alias_map(text.normalise_text(F.col("category"))).alias("category"))
    return seen.filter(F.col("category").isNotNull() & ~F.col("category").isin(*known)).distinct()


def deduplicate(
    df: DataFrame,
    key: Sequence[str] = config.CLEAN.dedup_key,
    order_by: Sequence[str] = config.CLEAN.order_by,
    tolerance: float | None = config.CLEAN.coord_tolerance,
) -> DataFrame:
    """Keep the first row, in ``order_by`` order, of each key and rounded coordinate.

    Ranking with a limit of one lets Spark drop all but one row per key in
    each task before the shuffle, so a key with very many copies stays cheap.
    """
    parts = [F.col(c) for c in key]
    if tolerance is not None:
        scale = round(1.0 / tolerance)
        parts += [geo.fixed_cell(F.col("latitude"), scale), geo.fixed_cell(F.col("longitude"), scale)]
    rank = F.row_number().over(Window.partitionBy(*parts).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def parse_month(df: DataFrame) -> DataFrame:
    """Add ``month_date`` and drop rows whose month does not parse."""
    return df.withColumn("month_date", dates.month_to_date(F.col("month"))).filter(F.col("month_date").isNotNull())


def clean(df: DataFrame, settings: config.CleanSettings = config.CLEAN) -> DataFrame:
    """The whole chain. Categories are normalised before duplicates are sought,
    so that spelling variants of one report collapse."""
    return (
        df.transform(validate_coords, settings.polygon)
        .transform(normalise_categories)
        .transform(deduplicate, settings.dedup_key, settings.order_by, settings.coord_tolerance)
        .transform(parse_month)
    )


def cleaning_counts(df: DataFrame, settings: config.CleanSettings = config.CLEAN) -> DataFrame:
    """Rows before and after each step, as (step_no, step, rows_before, rows_after, dropped).

    The row rules are counted in one pass. Only the duplicate step needs the
    ranking, which is done once for both of the last two steps.
    """
    lat, lng = F.col("latitude"), F.col("longitude")
    bounded = geo.valid_coords(lat, lng)
    covered = bounded & geo.covered_by(lat, lng, settings.polygon)
    first = df.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(bounded).alias("bounded"),
        F.count_if(covered).alias("covered"),
    )
    unique = (
        df.transform(validate_coords, settings.polygon)
        .transform(normalise_categories)
        .transform(deduplicate, settings.dedup_key, settings.order_by, settings.coord_tolerance)
        .agg(
            F.count(F.lit(1)).alias("unique"),
            F.count_if(dates.month_to_date(F.col("month")).isNotNull()).alias("dated"),
        )
    )
    both = first.withColumn("u", unique.select(F.struct("unique", "dated")).scalar())
    steps = [
        ("coordinates", F.col("raw"), F.col("bounded")),
        ("polygon", F.col("bounded"), F.col("covered")),
        ("duplicates", F.col("covered"), F.col("u.unique")),
        ("month", F.col("u.unique"), F.col("u.dated")),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"),
            before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("dropped"),
        )
        for i, (name, before, after) in enumerate(steps, start=1)
    ])
    return both.select(F.inline(rows))

"""Leakage-safe rates per cell, street or area, and the classifier's feature frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions import dates, geo, numbers
from streetlens.operators.joins import lookup_join
from streetlens.session import cut

SEASONS = tuple(config.SEASON_MONTHS)


def overall_rate(train: DataFrame, target: str = config.CLASSIFIER.target) -> Column:
    return train.agg(F.avg(target)).scalar()


def _group_counts(train: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Rows and positives per key, null keys included: the only pass over the rows."""
    return cut(train.groupBy(*keys).agg(
        F.count(target).alias("n"), F.sum(target).cast("bigint").alias("positives"), F.count(F.lit(1)).alias("rows")
    ))


def _rate_of(counts: DataFrame) -> Column:
    """The overall rate, from the counts."""
    return counts.agg(F.try_divide(F.sum("positives").cast("double"), F.sum("n").cast("double"))).scalar()


def key_counts(train: DataFrame, keys: Sequence[str], target: str = config.CLASSIFIER.target) -> DataFrame:
    """Rows and positives per key; rows without a key are left out."""
    return _group_counts(train, keys, target).na.drop(subset=list(keys))


def smoothed(n: Column, positives: Column, rate: Column, k: float) -> Column:
    """(positives + k * rate) / (n + k); plain mean for k = 0."""
    return F.try_divide(positives + F.lit(float(k)) * rate, n + F.lit(float(k)))


def rate_table(
    train: DataFrame,
    keys: Sequence[str],
    k: float,
    target: str = config.CLASSIFIER.target,
    out: str = "rate",
    rate: Column | None = None,
) -> DataFrame:
    """Smoothed rate per key. The overall rate follows from the same counts unless it is given."""
    counts = _group_counts(train, keys, target)
    mean = _rate_of(counts) if rate is None else rate
    return counts.na.drop(subset=list(keys)).select(
        *keys, smoothed(F.col("n"), F.col("positives"), mean, k).alias(out)
    )


def share_counts(train: DataFrame, key: str) -> DataFrame:
    return train.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def frequency_table(train: DataFrame, key: str, out: str = "freq") -> DataFrame:
    """Share of the rows that have a key, per key."""
    counts = cut(share_counts(train, key))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(key, F.try_divide(F.col("n").cast("double"), total.cast("double")).alias(out))


def with_fine_cells(df: DataFrame) -> DataFrame:
    fine_lat, fine_lng = geo.fine_cell(F.col("latitude"), F.col("longitude"))
    return df.withColumns({"fine_lat": fine_lat, "fine_lng": fine_lng})


def map_rate(
    df: DataFrame, table: DataFrame, keys: Sequence[str], columns: dict[str, Column], known_rows: int | None = None
) -> DataFrame:
    """Attach per-key values, with a stated value for keys not in the table."""
    joined = lookup_join(df, table, keys, "left", known_rows=known_rows)
    return joined.withColumns({c: F.coalesce(F.col(c), fallback) for c, fallback in columns.items()})


def calendar_columns(df: DataFrame) -> DataFrame:
    sine, cosine = dates.cyclic_month(F.col("month_num"))
    return df.withColumns({"month_sin": sine, "month_cos": cosine})


def season_columns(df: DataFrame) -> DataFrame:
    return df.select("*", *dates.season_onehot(F.col("season")))


def build_features(
    df: DataFrame,
    train: DataFrame | None = None,
    settings: config.ClassifierSettings = config.CLASSIFIER,
    street_col: str | None = "street_name",
    lsoa_col: str | None = None,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Feature frame with ``keep``, the current feature list and ``label``.

    Rates come from ``train`` only (the whole frame if it is not given).
    """
    target, priors = settings.target, settings.priors
    src = with_fine_cells(train if train is not None else df)
    out = with_fine_cells(df)

    counts = _group_counts(src, ["grid_id"], target)
    rate, grid = _rate_of(counts), counts.na.drop(subset=["grid_id"])
    grid_total = grid.agg(F.sum("rows")).scalar()
    grid = grid.select(
        "grid_id",
        F.try_divide(F.col("rows").cast("double"), grid_total.cast("double")).alias("grid_freq"),
        smoothed(F.col("n"), F.col("positives"), rate, priors.grid_k).alias("violent_rate_grid"),
    )
    out = map_rate(out, grid, ["grid_id"], {"grid_freq": F.lit(0.0), "violent_rate_grid": rate})
    fine = rate_table(src, ["fine_lat", "fine_lng"], priors.fine_k, target, "violent_rate_grid_fine", rate)
    out = map_rate(out, fine, ["fine_lat", "fine_lng"], {"violent_rate_grid_fine": rate})
    names = feature_names(street_col is not None, lsoa_col is not None)
    if street_col is not None:
        street = key_counts(src, [street_col], target).select(
            street_col,
            smoothed(F.col("n"), F.col("positives"), rate, priors.street_k).alias("violent_rate_street"),
            numbers.log_count(F.col("rows")).alias("log_street_crimes"),
        )
        out = map_rate(out, street, [street_col], {"violent_rate_street": rate, "log_street_crimes": F.lit(0.0)})
    if lsoa_col is not None:
        lsoa = rate_table(src, [lsoa_col], priors.lsoa_k, target, "violent_rate_lsoa", rate)
        out = map_rate(out, lsoa, [lsoa_col], {"violent_rate_lsoa": rate})
    out = (
        out.transform(calendar_columns)
        .transform(season_columns)
        .withColumns({
            "dist_to_centre": geo.dist_to_centre(F.col("latitude"), F.col("longitude")),
            "log_grid_freq": numbers.log_density(F.col("grid_freq")),
            "label": F.col(target).cast("int"),
        })
    )
    return out.select(*keep, *names, "label")


def feature_names(street: bool = True, lsoa: bool = False) -> list[str]:
    """Names of the current feature list, in order."""
    names = [
        "latitude", "longitude", "month_num", "month_sin", "month_cos", "quarter", "dist_to_centre",
        "grid_freq", "log_grid_freq", "violent_rate_grid", "violent_rate_grid_fine",
    ]
    if street:
        names += ["violent_rate_street", "log_street_crimes"]
    if lsoa:
        names.append("violent_rate_lsoa")
    return names + [f"season_{s}" for s in SEASONS]


BASIC_FEATURES = [
    "latitude", "longitude", "month_num", "year", "quarter", "grid_freq", *[f"season_{s}" for s in SEASONS],
]


def build_features_basic(df: DataFrame, target: str = config.CLASSIFIER.target, keep: Sequence[str] = ("id",)) -> DataFrame:
    """The oldest feature list: no rates, cell frequency over the whole frame."""
    out = lookup_join(df, frequency_table(df, "grid_id", "grid_freq"), ["grid_id"])
    out = season_columns(out).withColumn("label", F.col(target).cast("int"))
    return out.select(*keep, *BASIC_FEATURES, "label")


def raw_prior_features(lsoa: bool = False) -> list[str]:
    names = ["latitude", "longitude", "month_num", "quarter", "grid_freq", "violent_rate_grid"]
    if lsoa:
        names.append("violent_rate_lsoa")
    return names + [f"season_{s}" for s in SEASONS]


def build_features_raw_prior(
    df: DataFrame,
    train: DataFrame | None = None,
    target: str = config.CLASSIFIER.target,
    lsoa_col: str | None = None,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """The middle feature list: unsmoothed training mean per grid cell (and area)."""
    src = train if train is not None else df
    every = _group_counts(src, ["grid_id"], target)
    rate, counts = _rate_of(every), every.na.drop(subset=["grid_id"])
    total = counts.agg(F.sum("rows")).scalar()
    grid = counts.select(
        "grid_id",
        F.try_divide(F.col("rows").cast("double"), total.cast("double")).alias("grid_freq"),
        smoothed(F.col("n"), F.col("positives"), rate, 0).alias("violent_rate_grid"),
    )
    out = map_rate(df, grid, ["grid_id"], {"grid_freq": F.lit(0.0), "violent_rate_grid": rate})
    if lsoa_col is not None:
        lsoa = rate_table(src, [lsoa_col], 0, target, "violent_rate_lsoa", rate)
        out = map_rate(out, lsoa, [lsoa_col], {"violent_rate_lsoa": rate})
    out = season_columns(out).withColumn("label", F.col(target).cast("int"))
    return out.select(*keep, *raw_prior_features(lsoa_col is not None), "label")

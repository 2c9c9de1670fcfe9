"""Monthly series and (category, month) panels with lags and calendar columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens import config
from streetlens.session import cut
from streetlens.operators.numbering import numbered


def _span(counts: DataFrame, month: str = "month_date") -> Column:
    return counts.agg(F.struct(F.min(month).alias("lo"), F.max(month).alias("hi")).alias("span")).scalar()


def panel_counts(df: DataFrame, key: str = "category") -> DataFrame:
    return df.groupBy(key, "month_date").agg(F.count(F.lit(1)).alias("count"))


def panel_grid(counts: DataFrame, key: str = "category") -> DataFrame:
    """Every key with every month between the first and last of the whole table.

    The month list is generated per key from a one-row span, so nothing is joined.
    """
    span = _span(counts)
    return (
        counts.select(key).distinct()
        .withColumn("_span", span)
        .select(key, F.explode(F.sequence("_span.lo", "_span.hi", F.expr("interval 1 month"))).alias("month_date"))
    )


def panel_pad(counts: DataFrame, key: str = "category") -> DataFrame:
    """The grid with its counts, 0 where there were none."""
    return panel_grid(counts, key).join(counts, [key, "month_date"], "left").na.fill(0, ["count"])


def month_spine(series: DataFrame, keys: Sequence[str] = (), value: str = "crime_count") -> DataFrame:
    """Per key, every month between its own first and last, as double, 0 for missing months."""
    keys = list(keys)
    series = cut(series.select(*keys, "month_date", value))
    span = series.groupBy(*keys).agg(F.min("month_date").alias("lo"), F.max("month_date").alias("hi"))
    spine = span.filter(F.col("lo").isNotNull()).select(
        *keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_date")
    )
    return spine.join(series, [*keys, "month_date"], "left").select(
        *keys, "month_date", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("y")
    )


def add_lags(panel: DataFrame, lags: Sequence[int] = config.PANEL.lags, key: str = "category", value: str = "count") -> DataFrame:
    w = Window.partitionBy(key).orderBy("month_date")
    return panel.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in lags})


def add_rolling_mean(panel: DataFrame, roll: int = config.PANEL.roll, key: str = "category", value: str = "count") -> DataFrame:
    """Mean of up to ``roll`` earlier values, the current one left out."""
    w = Window.partitionBy(key).orderBy("month_date").rowsBetween(-roll, -1)
    return panel.withColumn(f"roll{roll}", F.avg(value).over(w))


def add_time_index(panel: DataFrame, base_year: Column | int | None = None) -> DataFrame:
    """month_n, year and t = months since the base year (by default the first year of the table)."""
    if base_year is None:
        base = panel.agg(F.min(F.year("month_date"))).scalar()
    else:
        base = F.lit(base_year) if isinstance(base_year, int) else base_year
    return panel.withColumns({
        "month_n": F.month("month_date"),
        "year": F.year("month_date"),
        "t": (F.year("month_date") - base) * 12 + F.month("month_date"),
    })


def drop_incomplete_lags(panel: DataFrame, lags: Sequence[int] = config.PANEL.lags) -> DataFrame:
    return panel.na.drop(subset=[f"lag_{k}" for k in lags])


def cat_codes(panel: DataFrame, key: str = "category") -> DataFrame:
    """Distinct keys with their 0-based alphabetical position.

    The ranking runs over the distinct list only, in ranges of keys. Runs one job.
    """
    return numbered(panel, key, "cat_enc")


def add_cat_code(panel: DataFrame, key: str = "category") -> DataFrame:
    return panel.join(cat_codes(panel, key), key)


def distinct_pairs(panel: DataFrame, key: str = "category") -> DataFrame:
    return panel.select(key, "cat_enc").dropDuplicates()


def build_panel(df: DataFrame, settings: config.PanelSettings = config.PANEL, key: str = "category") -> DataFrame:
    """Feature frame to padded panel with lags, rolling mean, time index and key code."""
    # one pass over the rows; everything after that works on this small table
    counts = cut(panel_counts(df, key))
    return (
        panel_pad(counts, key)
        .transform(add_lags, settings.lags, key)
        .transform(add_rolling_mean, settings.roll, key)
        .transform(add_time_index)
        .transform(drop_incomplete_lags, settings.lags)
        .transform(add_cat_code, key)
    )


def feature_names(settings: config.PanelSettings = config.PANEL) -> list[str]:
    return [*[f"lag_{k}" for k in settings.lags], f"roll{settings.roll}", "month_n", "year", "t", "cat_enc"]


def temporal_split(panel: DataFrame, horizon: int = config.PANEL.horizon) -> DataFrame:
    """Add ``is_test``: 1 for the last ``horizon`` months of the table."""
    last = panel.agg(F.max("month_date")).scalar()
    return panel.withColumn("is_test", (F.col("month_date") > F.add_months(last, -horizon)).cast("int"))


def difference(series: DataFrame, keys: Sequence[str] = (), order: int = 1, value: str = "y", time: str = "month_date") -> DataFrame:
    """``order``-fold first difference within each key, the leading rows dropped."""
    w = Window.partitionBy(*keys).orderBy(time)
    out = series
    for _ in range(order):
        out = out.withColumn(value, F.col(value) - F.lag(value).over(w)).filter(F.col(value).isNotNull())
    return out


def last_observed(history: DataFrame, key: str = "category", value: str = "count") -> DataFrame:
    """Per key the last month and its value."""
    return history.groupBy(key).agg(
        F.max("month_date").alias("month_date"), F.max_by(value, "month_date").alias(value)
    )

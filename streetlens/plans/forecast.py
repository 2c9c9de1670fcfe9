"""Walk-forward validation and final forecasts for one or many monthly series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import metrics
from streetlens.operators.arima import arima_order_search, order_text
from streetlens.operators.folds import fold_cutoffs, fold_tests
from streetlens.operators.panel import month_spine
from streetlens.operators.seasonal import seasonal_trend_fit
from streetlens.session import cut


@dataclass
class ForecastRun:
    cv: DataFrame
    summary: DataFrame
    future: DataFrame
    full: DataFrame
    arima: DataFrame


def _arima_steps(fits: DataFrame, by: Sequence[str]) -> DataFrame:
    return fits.filter(F.col("error").isNull()).select(
        *by, order_text().alias("order"), F.posexplode("forecast").alias("_pos", "yhat")
    ).withColumn("step", F.col("_pos") + 1).drop("_pos")


def score_folds(series: DataFrame, arima: DataFrame, seasonal: DataFrame, keys: Sequence[str],
                settings: config.ForecastSettings = config.FORECAST) -> DataFrame:
    """(keys, fold, model, cutoff, rmse, mae, order) from the fits of all folds."""
    by = [*keys, "fold"]
    tests = fold_tests(series, keys, settings).select(*by, "month_date", "y", "step")
    arima_steps = _arima_steps(arima.filter("fold > 0"), by).withColumn("model", F.lit("ARIMA"))
    a = metrics.forecast_vs_actual(arima_steps, tests, [*by, "step"]).select(*by, "model", "order", "y", "yhat")
    future = seasonal.filter("is_future = 1 AND fold > 0 AND yhat IS NOT NULL").select(*by, "month_date", "yhat")
    b = metrics.forecast_vs_actual(future, tests, [*by, "month_date"]).select(
        *by, F.lit("Seasonal").alias("model"), F.lit(None).cast("string").alias("order"), "y", "yhat"
    )
    errors = metrics.forecast_errors(a.unionByName(b), [*by, "model", "order"])
    cutoffs = fold_cutoffs(series, keys, settings).select(*by, F.col("cutoff_month").alias("cutoff"))
    return errors.join(cutoffs, by).select(*by, "model", "cutoff", "rmse", "mae", "order")


def walk_forward_cv(series: DataFrame, keys: Sequence[str], settings: config.ForecastSettings = config.FORECAST) -> DataFrame:
    """All folds of all series at once. A model that fails on a fold only loses its own row there."""
    arima = arima_order_search(series, keys, settings, folds=True)
    seasonal = seasonal_trend_fit(series, keys, settings, folds=True)
    return score_folds(series, arima, seasonal, keys, settings)


def forecast_run(counts: DataFrame, keys: Sequence[str] = (), settings: config.ForecastSettings = config.FORECAST,
                 value: str = "crime_count") -> ForecastRun:
    """Spine, validation, final fits, coming months and fitted history with band.

    ``counts`` holds (keys, month_date, value). Without keys there is one series.
    """
    if not keys:
        counts, keys = counts.withColumn("series", F.lit("all")), ["series"]
    keys = list(keys)
    series = cut(month_spine(counts, keys, value))
    arima = cut(arima_order_search(series, keys, settings, folds=True))
    seasonal = cut(seasonal_trend_fit(series, keys, settings, folds=True))
    cv = cut(score_folds(series, arima, seasonal, keys, settings))
    final = seasonal.filter("fold = 0")
    last = series.groupBy(*keys).agg(F.max("month_date").alias("last"))
    steps = _arima_steps(arima.filter("fold = 0"), keys).join(last, keys).select(
        *keys, F.add_months("last", F.col("step")).alias("date"), F.col("yhat").alias("arima_forecast")
    )
    coming = final.filter("is_future = 1").select(*keys, F.col("month_date").alias("date"), F.col("yhat").alias("seasonal_forecast"))
    return ForecastRun(
        cv=cv,
        summary=metrics.cv_summary(cv),
        future=coming.join(steps, [*keys, "date"], "full").select(*keys, "date", "arima_forecast", "seasonal_forecast"),
        full=final.select(*keys, F.col("month_date").alias("date"), "yhat", "yhat_lower", "yhat_upper"),
        arima=arima.filter("fold = 0"),
    )

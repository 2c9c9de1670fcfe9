"""Checks of spines, panels, lags, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import PANEL, WITH_CLEAN, WITH_FEATURES, check, cleaned, features, on
from streetlens.operators import folds, metrics, panel
from streetlens.plans import dashboard

# a plain forecast to score: the value of the month before
NAIVE = """naive AS (SELECT category, month_date, count::DOUBLE AS y, lag_1::DOUBLE AS yhat FROM pnl)"""
PNL_COLUMNS = "category, month_date, count, lag_1, lag_2, lag_3, lag_6, round(roll3, 6) AS roll3, month_n, year, t, cat_enc"


def r(c, digits=6):
    return F.round(c, digits)


def _pad(spark, folder):
    return panel.panel_pad(panel.panel_counts(cleaned(spark, folder)))


def _panel(spark, folder):
    return panel.build_panel(cleaned(spark, folder))


def _naive(spark, folder):
    return _panel(spark, folder).select(
        "category", "month_date", F.col("count").cast("double").alias("y"), F.col("lag_1").cast("double").alias("yhat"))


CL_PANEL = [PANEL[0].replace("FROM ft", "FROM cl"), *PANEL[1:]]


@check("panel_grid", on(WITH_CLEAN, "SELECT category, month_date FROM grid", *CL_PANEL[:2]))
def panel_grid(spark, folder):
    return panel.panel_grid(panel.panel_counts(cleaned(spark, folder)))


@check("panel_pad", on(WITH_CLEAN, "SELECT category, month_date, count FROM pad", *CL_PANEL[:3]))
def panel_pad(spark, folder):
    return _pad(spark, folder)


@check("lags", on(WITH_CLEAN, "SELECT category, month_date, lag_1, lag_2, lag_3, lag_6 FROM lagged", *CL_PANEL[:4]))
def lags(spark, folder):
    return panel.add_lags(_pad(spark, folder)).drop("count")


@check("rolling_mean", on(WITH_CLEAN, "SELECT category, month_date, round(roll3, 6) AS roll3 FROM lagged", *CL_PANEL[:4]))
def rolling_mean(spark, folder):
    return panel.add_rolling_mean(_pad(spark, folder)).select("category", "month_date", r("roll3").alias("roll3"))


@check("time_index", on(WITH_CLEAN, "SELECT category, month_date, month_n, year, t FROM timed", *CL_PANEL[:5]))
def time_index(spark, folder):
    return panel.add_time_index(_pad(spark, folder)).drop("count")


@check("cat_code", on(WITH_CLEAN, "SELECT category, month_date, cat_enc FROM pnl", *CL_PANEL))
def cat_code(spark, folder):
    return _panel(spark, folder).select("category", "month_date", "cat_enc")


@check("drop_incomplete_lags", on(WITH_CLEAN, """SELECT category, month_date, lag_6 FROM lagged WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL
  AND lag_3 IS NOT NULL AND lag_6 IS NOT NULL""", *CL_PANEL[:4]))
def drop_incomplete_lags(spark, folder):
    return panel.drop_incomplete_lags(panel.add_lags(_pad(spark, folder))).select("category", "month_date", "lag_6")


@check("build_panel", on(WITH_CLEAN, f"SELECT {PNL_COLUMNS} FROM pnl", *CL_PANEL))
def build_panel(spark, folder):
    return _panel(spark, folder).withColumn("roll3", r("roll3"))


@check("distinct_pairs", on(WITH_CLEAN, "SELECT DISTINCT category, cat_enc FROM pnl", *CL_PANEL))
def distinct_pairs(spark, folder):
    return panel.distinct_pairs(_panel(spark, folder))


@check("temporal_split", on(WITH_CLEAN, """SELECT category, month_date, CAST(month_date > (SELECT max(month_date) FROM pnl) - INTERVAL 3 MONTH AS INTEGER)
  AS is_test FROM pnl""", *CL_PANEL))
def temporal_split(spark, folder):
    return panel.temporal_split(_panel(spark, folder)).select("category", "month_date", "is_test")


SERIES = """spine AS (SELECT category, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month_date
  FROM (SELECT category, min(month_date) AS lo, max(month_date) AS hi FROM cl GROUP BY 1)),
series AS (SELECT category, month_date, coalesce(n, 0)::DOUBLE AS y FROM spine
  LEFT JOIN (SELECT category, month_date, count(*) AS n FROM cl GROUP BY 1, 2) USING (category, month_date))"""


def _series(spark, folder):
    return panel.month_spine(panel.panel_counts(cleaned(spark, folder)), ["category"], "count")


@check("month_spine", on(WITH_CLEAN, "SELECT category, month_date, y FROM series", SERIES))
def month_spine(spark, folder):
    return _series(spark, folder)


@check("difference", on(WITH_CLEAN, """SELECT category, month_date, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS y FROM series
  WINDOW w AS (PARTITION BY category ORDER BY month_date) QUALIFY row_number() OVER w > 2""", SERIES))
def difference(spark, folder):
    """Second difference."""
    return panel.difference(_series(spark, folder), ["category"], 2)


NUMBERED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY month_date) - 1 AS idx,
  count(*) OVER (PARTITION BY category) AS n FROM series),
cuts AS (SELECT category, CAST(f AS INTEGER) AS fold, CAST(10 + 2 * (f - 1) AS INTEGER) AS cutoff FROM (
  SELECT category, unnest(generate_series(1, (n - 3 - 10) // 2 + 1)) AS f FROM (
    SELECT category, max(n) AS n FROM numbered GROUP BY 1) WHERE n - 3 >= 10))"""


@check("fold_cutoffs", on(WITH_CLEAN, """SELECT category, fold, cutoff, month_date AS cutoff_month FROM cuts JOIN numbered USING (category)
  WHERE idx = cutoff - 1""", SERIES, NUMBERED))
def fold_cutoffs(spark, folder):
    return folds.fold_cutoffs(_series(spark, folder), ["category"])


@check("fold_expand", on(WITH_CLEAN, """SELECT category, fold, month_date, y, CAST(idx >= cutoff AS INTEGER) AS is_test FROM cuts
  JOIN numbered USING (category) WHERE idx < cutoff + 3""", SERIES, NUMBERED))
def fold_expand(spark, folder):
    return folds.fold_expand(_series(spark, folder), ["category"]).select("category", "fold", "month_date", "y", "is_test")


@check("forecast_vs_actual", on(WITH_CLEAN, """SELECT c.category, c.fold, n.month_date, last.y AS yhat, n.y FROM cuts c
  JOIN numbered n ON n.category = c.category AND n.idx >= c.cutoff AND n.idx < c.cutoff + 3
  JOIN numbered last ON last.category = c.category AND last.idx = c.cutoff - 1""", SERIES, NUMBERED))
def forecast_vs_actual(spark, folder):
    """The last training value as forecast for each step, beside the actual values."""
    rows = folds.fold_expand(_series(spark, folder), ["category"])
    last = rows.filter("is_test = 0").groupBy("category", "fold").agg(
        F.max_by("y", "month_date").alias("yhat"), F.max("month_date").alias("last"))
    steps = last.select("category", "fold", "yhat", F.explode(F.sequence(
        F.add_months("last", 1), F.add_months("last", 3), F.expr("interval 1 month"))).alias("month_date"))
    actual = rows.filter("is_test = 1").select("category", "fold", "month_date", "y")
    return metrics.forecast_vs_actual(steps, actual, ["category", "fold", "month_date"])


@check("forecast_errors", on(WITH_CLEAN, """SELECT category, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae
  FROM naive GROUP BY 1""", *CL_PANEL, NAIVE))
def forecast_errors(spark, folder):
    return metrics.forecast_errors(_naive(spark, folder), ["category"]).withColumns({"rmse": r("rmse"), "mae": r("mae")})


@check("mae_pct_of_mean", on(WITH_CLEAN, """SELECT category, round(avg(abs(y - yhat)), 6) AS mae, round(avg(abs(y - yhat)) / avg(y) * 100, 5) AS mae_pct_of_mean
  FROM naive GROUP BY 1""", *CL_PANEL, NAIVE))
def mae_pct_of_mean(spark, folder):
    return metrics.mae_pct_of_mean(_naive(spark, folder), ["category"]).withColumns(
        {"mae": r("mae"), "mae_pct_of_mean": r("mae_pct_of_mean", 5)})


@check("cv_summary", on(WITH_CLEAN, """SELECT model, round(avg(rmse), 2) AS rmse_mean, round(avg(mae), 2) AS mae_mean FROM (
  SELECT category AS model, year, sqrt(avg((count - lag_1) * (count - lag_1))) AS rmse, avg(abs(count - lag_1)) AS mae FROM pnl GROUP BY 1, 2)
  GROUP BY 1""", *CL_PANEL))
def cv_summary(spark, folder):
    rows = _panel(spark, folder).withColumn("model", F.col("category"))
    errors = metrics.forecast_errors(rows, ["model", "year"], "count", "lag_1")
    return metrics.cv_summary(errors)


@check("rf_total", on(WITH_CLEAN, "SELECT month_date, round(sum(roll3), 1) AS rf_forecast FROM pnl GROUP BY 1", *CL_PANEL))
def rf_total(spark, folder):
    """The rolling mean stands in for a forecast."""
    return metrics.rf_total(_panel(spark, folder).withColumn("rf_forecast", F.col("roll3")))


@check("rf_total_for_categories", on(WITH_CLEAN, """SELECT month_date, round(sum(roll3), 6) AS rf_forecast FROM pnl
  WHERE category IN ('drugs', 'robbery') GROUP BY 1""", *CL_PANEL))
def rf_total_for_categories(spark, folder):
    return metrics.rf_total(_panel(spark, folder).withColumn("rf_forecast", F.col("roll3")), ["drugs", "robbery"], 6)


@check("last_observed", on(WITH_CLEAN, """SELECT category, max(month_date) AS month_date, arg_max(n, month_date) AS count FROM (
  SELECT category, month_date, count(*) AS n FROM cl GROUP BY 1, 2) GROUP BY 1"""))
def last_observed(spark, folder):
    return panel.last_observed(panel.panel_counts(cleaned(spark, folder)))


HISTORY = "hist AS (SELECT month_date, count(*) AS n FROM cl WHERE category = 'drugs' GROUP BY 1)"
LAST_ROLL = "SELECT CAST(month_date + INTERVAL 3 MONTH AS DATE) AS month_date, category, roll3 AS rf_forecast FROM pnl WHERE month_date > (SELECT max(month_date) FROM pnl) - INTERVAL 3 MONTH"


def _shifted_forecast(pnl):
    """Rolling means of the last three months, moved three months ahead, as a stand-in forecast."""
    return panel.temporal_split(pnl).filter("is_test = 1").select(
        F.add_months("month_date", 3).alias("month_date"), "category", F.col("roll3").alias("rf_forecast"))


@check("category_history_forecast", on(WITH_CLEAN, """SELECT 'observed' AS layer, month_date, n::DOUBLE AS value FROM hist
  UNION ALL SELECT 'forecast', max(month_date), arg_max(n, month_date)::DOUBLE FROM hist
  UNION ALL SELECT 'forecast', month_date, round(rf_forecast, 6) FROM fc WHERE category = 'drugs'""", *CL_PANEL, HISTORY, f"fc AS ({LAST_ROLL})"))
def category_history_forecast(spark, folder):
    df = cleaned(spark, folder)
    out = dashboard.history_with_forecast(df, _shifted_forecast(panel.build_panel(df)), "drugs")
    return out.withColumn("value", r("value"))


@check("concat_rows", on(WITH_CLEAN, """SELECT category, month_date, n::DOUBLE AS value FROM (SELECT category, month_date, count(*) AS n FROM cl GROUP BY 1, 2)
  UNION ALL SELECT category, month_date, round(rf_forecast, 6) FROM fc""", *CL_PANEL, f"fc AS ({LAST_ROLL})"))
def concat_rows(spark, folder):
    df = cleaned(spark, folder)
    history = panel.panel_counts(df).select("category", "month_date", F.col("count").cast("double").alias("value"))
    future = _shifted_forecast(panel.build_panel(df)).select("month_date", r("rf_forecast").alias("value"), "category")
    return history.unionByName(future)


@check("rf_summary", on(WITH_CLEAN, """SELECT strftime(month_date, '%b %Y') AS title, format('{:,}', CAST(round_even(rf_forecast, 0) AS BIGINT)) AS text,
    CAST(month_date AS VARCHAR) AS position FROM fc WHERE category = 'drugs'
  UNION ALL SELECT 'Held-out', 'MAE ' || format('{:.1f}', mae) || ', RMSE ' || format('{:.1f}', rmse) || ', MAE ' || format('{:.1f}', pct) ||
    '% of mean, train ' || format('{:,}', train) || ', test ' || format('{:,}', test), '~' FROM (
    SELECT avg(abs(count - lag_1)) AS mae, sqrt(avg((count - lag_1) * (count - lag_1))) AS rmse,
      avg(abs(count - lag_1)) / avg(count) * 100 AS pct, count(*) AS train, count(*) AS test FROM pnl)""", *CL_PANEL, f"fc AS ({LAST_ROLL})"))
def rf_summary(spark, folder):
    pnl = _panel(spark, folder)
    gap = F.col("count") - F.col("lag_1")
    table = pnl.agg(
        F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.avg(F.abs(gap)) / F.avg("count") * 100.0).alias("mae_pct_of_mean"),
        F.count(F.lit(1)).alias("train_rows"), F.count(F.lit(1)).alias("test_rows")).withColumn("model", F.lit("RandomForest"))
    other = table.withColumns({"model": F.lit("Baseline"), "mae": F.col("mae") + 1.0})
    table = table.unionByName(other)
    return dashboard.rf_summary(_shifted_forecast(pnl), table, "drugs")


@check("trend_layers", on(WITH_FEATURES, """SELECT date, layer, round(value, 6) AS value, round(lower, 6) AS lower, round(upper, 6) AS upper FROM (
  SELECT month_date AS date, 'observed' AS layer, count(*)::DOUBLE AS value, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper FROM cl GROUP BY 1
  UNION ALL SELECT month_date, 'seasonal_fit', sum(roll3), sum(lag_1)::DOUBLE, sum(lag_2)::DOUBLE FROM pnl GROUP BY 1
  UNION ALL SELECT month_date, 'arima_forecast', sum(lag_1)::DOUBLE, NULL, NULL FROM pnl GROUP BY 1
  UNION ALL SELECT month_date, 'seasonal_forecast', sum(lag_2)::DOUBLE, NULL, NULL FROM pnl GROUP BY 1
  UNION ALL SELECT month_date, 'rf_forecast', sum(rf_forecast), NULL, NULL FROM fc WHERE category IN ('drugs', 'robbery') GROUP BY 1)""",
  *PANEL, f"fc AS ({LAST_ROLL})"))
def trend_layers(spark, folder):
    df = features(spark, folder)
    pnl = panel.build_panel(df)
    by_month = pnl.groupBy(F.col("month_date").alias("date"))
    seasonal = by_month.agg(F.sum("roll3").alias("yhat"), F.sum("lag_1").cast("double").alias("yhat_lower"),
                            F.sum("lag_2").cast("double").alias("yhat_upper"))
    future = by_month.agg(F.sum("lag_1").cast("double").alias("arima_forecast"), F.sum("lag_2").cast("double").alias("seasonal_forecast"))
    out = dashboard.trend_layers(df, seasonal, future, _shifted_forecast(pnl), ["drugs", "robbery"])
    return out.withColumns({c: r(c) for c in ("value", "lower", "upper")})



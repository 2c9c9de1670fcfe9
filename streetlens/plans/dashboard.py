"""Filtered queries behind the dashboard: frames in, frames out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions import text
from streetlens.operators import aggregates, metrics, panel, sampling
from streetlens.operators.features import coord_extent
from streetlens.operators.joins import lookup_join
from streetlens.session import cut


def dashboard_filter(
    df: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    categories: Sequence[str] | None = None,
    streets: Sequence[str] | None = None,
) -> DataFrame:
    """Inclusive date range, category list and street list; an empty argument filters nothing."""
    out = df
    if start:
        out = out.filter(F.col("month_date") >= F.lit(str(start)).cast("date"))
    if end:
        out = out.filter(F.col("month_date") <= F.lit(str(end)).cast("date"))
    if categories:
        out = out.filter(F.col("category").isin(*categories))
    if streets:
        out = out.filter(F.col("street_name").isin(*streets))
    return out


def kpi_cards(df: DataFrame) -> DataFrame:
    """The KPI row as display texts."""
    k = aggregates.kpis(df)
    return k.select(
        text.thousands(F.col("total")).alias("total"),
        F.concat(F.col("months").cast("string"), F.lit(" months")).alias("months"),
        F.col("avg_per_month"),
        text.pretty_label(F.coalesce("top_category", F.lit("—"))).alias("top_category"),
        text.thousands(F.col("streets")).alias("streets"),
    )


def category_history(df: DataFrame, category: str) -> DataFrame:
    return panel.panel_counts(df.filter(F.col("category") == category)).select("month_date", "count")


def history_with_forecast(df: DataFrame, forecast: DataFrame, category: str) -> DataFrame:
    """(layer, month_date, value): observed counts, then the forecast, led in by the last observed point."""
    history = cut(panel.panel_counts(df.filter(F.col("category") == category)))
    future = forecast.filter(F.col("category") == category)
    observed = history.select(F.lit("observed").alias("layer"), "month_date", F.col("count").cast("double").alias("value"))
    steps = future.select(F.lit("forecast").alias("layer"), "month_date", F.col("rf_forecast").alias("value"))
    # the connector exists only if there is a forecast to connect to
    anchor = future.select("category").distinct()
    connector = panel.last_observed(history).join(anchor, "category", "left_semi").select(
        F.lit("forecast").alias("layer"), "month_date", F.col("count").cast("double").alias("value")
    )
    return observed.unionByName(connector).unionByName(steps)


def trend_layers(
    df: DataFrame,
    seasonal: DataFrame | None = None,
    future: DataFrame | None = None,
    rf_future: DataFrame | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """(date, layer, value, lower, upper): observed counts and every forecast layer that exists.

    With a category list the forest forecast is summed over those categories
    only, unrounded; without one it is the rounded grand total.
    """
    none = F.lit(None).cast("double")
    out = aggregates.count_by(df, "month_date", name="n").select(
        F.col("month_date").alias("date"), F.lit("observed").alias("layer"), F.col("n").cast("double").alias("value"),
        none.alias("lower"), none.alias("upper"),
    )
    if seasonal is not None:
        out = out.unionByName(seasonal.select(
            "date", F.lit("seasonal_fit").alias("layer"), F.col("yhat").alias("value"),
            F.col("yhat_lower").alias("lower"), F.col("yhat_upper").alias("upper"),
        ))
    if future is not None:
        for name in ("arima_forecast", "seasonal_forecast"):
            out = out.unionByName(future.select(
                "date", F.lit(name).alias("layer"), F.col(name).alias("value"), none.alias("lower"), none.alias("upper")
            ))
    if rf_future is not None:
        total = metrics.rf_total(rf_future, categories, None if categories else 1)
        out = out.unionByName(total.select(
            F.col("month_date").alias("date"), F.lit("rf_forecast").alias("layer"), F.col("rf_forecast").alias("value"),
            none.alias("lower"), none.alias("upper"),
        ))
    return out


def cluster_overlay(df: DataFrame, labels: DataFrame, by_id: bool = True) -> DataFrame:
    """Attach cluster labels.

    By id each incident gets its own label. The older form joins on
    (latitude, longitude, month), which multiplies rows where several
    incidents share them.
    """
    wanted = [c for c in ("kmeans_label", "dbscan_label") if c in labels.columns]
    keys = ["id"] if by_id else ["latitude", "longitude", "month"]
    return df.join(labels.select(*keys, *wanted), keys, "left")


def heatmap_rows(df: DataFrame) -> DataFrame:
    return df.select("latitude", "longitude", "category", "month")


def scatter_rows(df: DataFrame, labels: DataFrame | None = None, mode: str | None = None, limit: int = 8000) -> DataFrame:
    """At most ``limit`` points, coloured by cluster if a mode is given, else by category."""
    points = sampling.sample_n(df, limit)
    columns = ["id", "latitude", "longitude", "category", "month"]
    if mode in ("kmeans", "dbscan") and labels is not None:
        # the sample is bounded by its limit
        chosen = labels.join(F.broadcast(points.select("id")), "id", "left_semi").select("id", f"{mode}_label")
        shown = lookup_join(points.select(*columns), chosen, ["id"], known_rows=limit)
        return shown.withColumn("colour", F.col(f"{mode}_label").cast("string")).drop(f"{mode}_label")
    return points.select(*columns, F.col("category").alias("colour"))


def choropleth_rows(filtered: DataFrame, whole: DataFrame, cells: int = config.GRID.cells) -> DataFrame:
    """Cells of the filtered rows, centred by the extent of the frame the grid was made from."""
    return aggregates.grid_choropleth(filtered, coord_extent(whole), cells)


def rf_summary(forecast: DataFrame, metrics_table: DataFrame, category: str, model: str = "RandomForest") -> DataFrame:
    """Display rows: predicted count per coming month, then the held-out scores of ``model``."""
    cards = forecast.filter(F.col("category") == category).select(
        F.date_format("month_date", "MMM yyyy").alias("title"),
        text.thousands(F.rint("rf_forecast").cast("bigint")).alias("text"),
        F.col("month_date").cast("string").alias("position"),
    )
    scores = metrics_table.filter(F.col("model") == model).select(
        F.lit("Held-out").alias("title"),
        F.concat(
            F.lit("MAE "), F.format_number("mae", 1), F.lit(", RMSE "), F.format_number("rmse", 1),
            F.lit(", MAE "), F.format_number("mae_pct_of_mean", 1), F.lit("% of mean, train "),
            text.thousands(F.col("train_rows")), F.lit(", test "), text.thousands(F.col("test_rows")),
        ).alias("text"),
        F.lit("~").alias("position"),
    )
    return cards.unionByName(scores)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Every double column rounded."""
    return df.select(*[
        F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ])


def metrics_tables(classifier: DataFrame, forest: DataFrame, cv: DataFrame, sweep: DataFrame) -> dict[str, DataFrame]:
    return {
        "classifier_metrics": rounded(classifier, 3),
        "forecast_rf_metrics": rounded(forest, 2),
        "forecast_cv": metrics.cv_summary(cv).withColumnsRenamed({"rmse_mean": "rmse", "mae_mean": "mae"}),
        "kmeans_sweep": rounded(sweep, 3),
    }

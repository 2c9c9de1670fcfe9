"""Clustering, forecasting and classification runs with their result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import classify, forest_forecast, kmeans, metrics, quality
from streetlens.operators import dbscan as density
from streetlens.operators.aggregates import monthly_totals
from streetlens.operators.panel import build_panel, distinct_pairs
from streetlens.plans.forecast import ForecastRun, forecast_run
from streetlens.session import cut
from streetlens.sources import models, results


@dataclass
class ClusterRun:
    sweep: kmeans.Sweep
    labels: DataFrame
    density_scores: DataFrame


def density_scores(labels: DataFrame, kind: str = config.CLUSTER.silhouette) -> DataFrame:
    """clusters, noise, silhouette, its kind and Davies-Bouldin (plane of radians) of the points that are not noise.

    Both scores are null unless there are more points than clusters and more
    than one cluster. The ``exact`` silhouette is by great-circle distance over
    all pairs, the ``linear`` one by squared distance in the plane of radians.
    """
    kept = density.drop_noise(labels, "dbscan_label")
    points = cut(
        kept.groupBy("latitude", "longitude", F.col("dbscan_label").alias("label")).agg(F.count(F.lit(1)).alias("w"))
        .withColumns({"x": F.col("latitude"), "y": F.col("longitude")})
    )
    counts = metrics.cluster_counts(labels.withColumnRenamed("dbscan_label", "label"))
    facts = points.agg(F.count_distinct("label").alias("k"), F.sum("w").alias("n")).first()
    none = F.lit(None).cast("double")
    if not (facts["n"] or 0) > facts["k"] > 1:
        return counts.select("*", none.alias("silhouette"), none.alias("davies_bouldin"), F.lit(kind).alias("silhouette_kind"))
    flat = points.withColumns({"x": F.radians("latitude"), "y": F.radians("longitude")})
    if kind == "exact":
        silhouette = quality.silhouette_exact(points, quality.haversine)
    else:
        silhouette = quality.silhouette_fast(flat)
    return counts.select(
        "*", silhouette.scalar().alias("silhouette"), quality.davies_bouldin(flat).scalar().alias("davies_bouldin"),
        F.lit(kind).alias("silhouette_kind"),
    )


def cluster_run(df: DataFrame, settings: config.ClusterSettings = config.CLUSTER, folder: str | None = None) -> ClusterRun:
    """K-Means sweep and density clustering; labels, models and the sweep table are saved below ``folder``."""
    df = df.select("id", "latitude", "longitude", "month", "category")
    sweep = kmeans.kmeans_sweep(df, settings)
    labelled = density.dbscan(kmeans.with_kmeans_labels(df, sweep), settings.eps_metres, settings.min_samples)
    labels = cut(labelled)
    scores = density_scores(labels, settings.silhouette)
    if folder is not None:
        base = folder.rstrip("/")
        results.save_labels(labels, f"{base}/cluster_labels")
        results.write_results({"kmeans_sweep": sweep.table}, base)
        models.save_models(
            df.sparkSession, {"kmeans": sweep.model}, f"{base}/models/clusters",
            {"kmeans_n": sweep.best_k, "eps_metres": settings.eps_metres, "min_samples": settings.min_samples},
        )
    return ClusterRun(sweep, labels, scores)


@dataclass
class ForestRun:
    metrics: DataFrame
    future: DataFrame
    total: DataFrame
    forest: forest_forecast.PanelForest


def rf_run(df: DataFrame, settings: config.PanelSettings = config.PANEL, folder: str | None = None) -> ForestRun | None:
    """Panel, forest, recursive forecast and totals; nothing for an empty panel."""
    panel = cut(build_panel(df, settings))
    if panel.isEmpty():
        return None
    forest = forest_forecast.fit_panel_forest(panel, settings)
    future = cut(forest_forecast.recursive_forecast(panel, forest))
    total = metrics.rf_total(future)
    if folder is not None:
        base = folder.rstrip("/")
        results.write_results(
            {"forecast_rf_metrics": forest.metrics, "forecast_rf_future": future, "forecast_rf_future_total": total}, base
        )
        first = panel.agg(F.min("year")).first()[0]
        models.save_models(
            df.sparkSession, {"panel_forest": forest.model}, f"{base}/models/forest",
            {"features": ",".join(forest_forecast.feature_names(settings)), "first_year_of_panel": first, "horizon": settings.horizon},
        )
        distinct_pairs(panel).write.mode("overwrite").parquet(f"{base}/models/forest/category_codes")
    return ForestRun(forest.metrics, future, total, forest)


def forecast_all(df: DataFrame, settings: config.ForecastSettings = config.FORECAST, folder: str | None = None) -> ForecastRun:
    """The one series of monthly totals."""
    run = forecast_run(monthly_totals(df), settings=settings)
    if folder is not None:
        base = folder.rstrip("/")
        results.write_results(
            {"forecast_cv": run.cv.drop("series"), "future_forecast": run.future.drop("series"), "seasonal_full": run.full.drop("series")},
            base,
        )
        models.save_series_fits(run.arima, f"{base}/models/arima")
    return run


def classify_run(df: DataFrame, settings: config.ClassifierSettings = config.CLASSIFIER, folder: str | None = None) -> classify.ClassifierRun:
    run = classify.fit_classifiers(df, settings)
    if folder is not None:
        base = folder.rstrip("/")
        results.write_results({"classifier_metrics": run.metrics}, base)
        stages = {name: stage for fitted in run.fitted.values() for name, stage in fitted.stages.items()}
        facts = {k: v for fitted in run.fitted.values() for k, v in fitted.facts.items()}
        models.save_models(df.sparkSession, stages, f"{base}/models/classifiers", facts)
    return run

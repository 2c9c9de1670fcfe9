"""Checks of learned operators; tree counts and rounds are below their defaults."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.base import DED, NRM, PANEL, WITH_CLEAN, WITH_FEATURES, WITH_INC, check, cleaned, features, month_sql, on, polygon_sql
from checks.cleaning import REC, _records
from checks.clusters import ASSIGN, HUBS, dbscan_sql
from checks.rates import SPLIT
from streetlens import config
from streetlens.operators import classify, forest_forecast, priors, quality, sampling
from streetlens.operators.kmeans import best_fits, fit_all, kmeans_model, prepared_points
from streetlens.operators.panel import build_panel
from streetlens.plans import build, train
from streetlens.session import cut, scratch_path
from streetlens.sources import landing, models, results, store
from streetlens.streaming.incremental import incremental_load

SMALL = replace(config.CLASSIFIER, forest_trees=20, forest_depth=8, boost_rounds=5, logistic_iter=100, svm_features=64)
FOREST = replace(config.PANEL, trees=20, max_depth=10)


HUBS_USED = on(WITH_CLEAN, f"SELECT CAST(count(DISTINCT {ASSIGN.replace('x -', 'latitude -').replace('y -', 'longitude -')}) AS INTEGER) AS best_k FROM cl")
CLUSTER_RUN_SQL = f"""SELECT clusters, noise, scored, best_k FROM (SELECT count(DISTINCT CASE WHEN dbscan_label <> -1 THEN dbscan_label END) AS clusters,
  count(*) FILTER (WHERE dbscan_label = -1) AS noise, true AS scored FROM ({dbscan_sql(250, 25)})), ({HUBS_USED})"""
SCORED_SQL = on(WITH_FEATURES, """SELECT is_violent AS label, count(*) AS rows, true AS in_range, true AS agrees, true AS better_than_chance
  FROM split WHERE is_test = 1 GROUP BY 1""", SPLIT)


def _scored(spark, folder, name):
    """Held-out rows per class, whether scores lie in 0..1, agree with the prediction, and rank a planted signal above chance."""
    split = cut(sampling.stratified_split(features(spark, folder)))
    rows = cut(priors.build_features(split, split.filter("is_test = 0"), keep=("id", "is_test")))
    # the label itself with one in four rows turned over, by id: a signal that every model must find
    planted = F.when(F.pmod(F.xxhash64("id"), F.lit(4)) == 0, 1 - F.col("label")).otherwise(F.col("label")).cast("double")
    rows = rows.withColumn("planted", planted)
    fitted = classify.FITTERS[name](rows.filter("is_test = 0"), [*priors.feature_names(), "planted"], SMALL)
    scored = cut(fitted.score(rows.filter("is_test = 1")).select("label", "prediction", "score"))
    auc = classify.evaluate(scored).first()["roc_auc"]
    # the kernel machine's probability is fitted on its margin, so its own threshold may differ
    agrees = F.lit(True) if name == "svm" else (F.col("score") > 0.5).cast("int") == F.col("prediction")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("score").between(0, 1)).alias("in_range"),
        F.bool_and(agrees | (F.col("score") == 0.5)).alias("agrees"),
    ).withColumn("better_than_chance", F.lit(auc > 0.6))


@check("logistic_regression", SCORED_SQL)
def logistic_regression(spark, folder):
    return _scored(spark, folder, "logistic_regression")


@check("random_forest_classifier", SCORED_SQL)
def random_forest_classifier(spark, folder):
    return _scored(spark, folder, "random_forest")


@check("gradient_boosting", SCORED_SQL)
def gradient_boosting(spark, folder):
    return _scored(spark, folder, "gradient_boosting")


@check("svm", SCORED_SQL)
def svm(spark, folder):
    return _scored(spark, folder, "svm")


@check("fit_classifiers", "SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosting']) AS model, true AS in_range, true AS validated")
def fit_classifiers(spark, folder):
    """One row of scores per model, all between 0 and 1, with a cross-validated one."""
    small = replace(SMALL, forest_trees=10, boost_rounds=3, cv_folds=2)
    scores = ("accuracy", "f1", "precision", "recall", "roc_auc")
    return classify.fit_classifiers(features(spark, folder), small).metrics.select(
        "model", F.least(*(F.col(c).between(0, 1) for c in scores)).alias("in_range"), F.col("cv_roc_auc_mean").between(0, 1).alias("validated")
    )


@check("rf_panel_fit", on(WITH_CLEAN, """SELECT 'RandomForest' AS model, count(*) FILTER (WHERE month_date <= m) AS train_rows,
  count(*) FILTER (WHERE month_date > m) AS test_rows FROM pnl, (SELECT max(month_date) - INTERVAL 3 MONTH AS m FROM pnl)""",
  PANEL[0].replace("FROM ft", "FROM cl"), *PANEL[1:]))
def rf_panel_fit(spark, folder):
    """The scores depend on the forest, so the check is on the split sizes."""
    forest = forest_forecast.fit_panel_forest(build_panel(cleaned(spark, folder)), FOREST)
    return forest.metrics.select("model", "train_rows", "test_rows")


PNL_STEPS = [PANEL[0].replace("FROM ft", "FROM cl"), *PANEL[1:]]


@check("rf_recursive_forecast", on(WITH_CLEAN, """SELECT CAST(m + to_months(CAST(k AS INTEGER)) AS DATE) AS month_date, category, true AS in_range
  FROM (SELECT DISTINCT category FROM pnl), (SELECT max(month_date) AS m FROM pnl), range(1, 4) s(k)""", *PNL_STEPS))
def rf_recursive_forecast(spark, folder):
    """Every coming month of every category, within what the category's counts allow."""
    panel = cut(build_panel(cleaned(spark, folder)))
    out = forest_forecast.recursive_forecast(panel, forest_forecast.fit_panel_forest(panel, FOREST))
    most = panel.agg(F.max("count")).scalar()
    return out.select("month_date", "category", F.col("rf_forecast").between(0, most).alias("in_range"))


@check("rf_run", on(WITH_CLEAN, """SELECT CAST(m + to_months(CAST(k AS INTEGER)) AS DATE) AS month_date, true AS in_range
  FROM (SELECT max(month_date) AS m FROM pnl), range(1, 4) s(k)""", *PNL_STEPS))
def rf_run(spark, folder):
    """Totals of the coming months, not below zero and not above all that was ever counted in one month per category."""
    df = cleaned(spark, folder)
    most = build_panel(df).groupBy("category").agg(F.max("count").alias("m")).agg(F.sum("m")).scalar()
    return train.rf_run(df, FOREST).total.select("month_date", F.col("rf_forecast").between(0, most).alias("in_range"))


@check("cluster_run", CLUSTER_RUN_SQL)
def cluster_run(spark, folder):
    """Clusters and noise of the density clustering, whether its scores are in range, and the best k of K-Means: the hubs within the polygon."""
    run = train.cluster_run(cleaned(spark, folder))
    scored = F.coalesce((F.col("davies_bouldin") >= 0) & F.col("silhouette").between(-1, 1), F.col("clusters") < 2)
    return run.density_scores.select("clusters", "noise", scored.alias("scored"), F.lit(run.sweep.best_k).alias("best_k"))


@check("save_models", on(WITH_CLEAN, "SELECT 'kmeans' AS name, count(*) AS points FROM (SELECT DISTINCT latitude, longitude FROM cl)"))
def save_models(spark, folder):
    """Points that a stored and reloaded model labels as before."""
    path = scratch_path(spark, "models")
    points = prepared_points(cleaned(spark, folder))
    model = kmeans_model(points, best_fits(fit_all(points, [len(HUBS)], 10, 42))[len(HUBS)])
    models.save_models(spark, {"kmeans": model}, path, {"kmeans_n": len(HUBS)})
    again = models.load_model(path, "kmeans").transform(points).select("latitude", "longitude", F.col("prediction").alias("again"))
    before = model.transform(points).select("latitude", "longitude", "prediction")
    same = before.join(again, ["latitude", "longitude"]).filter("prediction = again")
    return same.agg(F.lit("kmeans").alias("name"), F.count(F.lit(1)).alias("points"))


@check("metrics_tables", """SELECT 'classifier_metrics' AS name, 'logistic_regression' AS subject, true AS rounded
  UNION ALL SELECT 'forecast_rf_metrics', 'RandomForest', true UNION ALL SELECT 'kmeans_sweep', CAST(k AS VARCHAR), true FROM range(3, 13) s(k)""")
def metrics_tables(spark, folder):
    """Sweep and forest scores, written, read back and rounded for display."""
    from streetlens.operators.kmeans import kmeans_sweep
    from streetlens.plans.dashboard import metrics_tables as tables

    path = scratch_path(spark, "results")
    df = cut(features(spark, folder))
    forest = train.rf_run(df, replace(FOREST, trees=5))
    results.write_results({
        "kmeans_sweep": kmeans_sweep(df).table, "forecast_rf_metrics": forest.metrics,
        "classifier_metrics": classify.fit_classifiers(df, SMALL, ["logistic_regression"], cross_validate=True).metrics,
    }, path)
    read = {n: results.read_result_csv(spark, f"{path}/{n}", n) for n in (
        "classifier_metrics", "forecast_rf_metrics", "forecast_cv", "kmeans_sweep")}
    shown = tables(read["classifier_metrics"], read["forecast_rf_metrics"], read["forecast_cv"], read["kmeans_sweep"])
    out = None
    for name, table in shown.items():
        numbers = [F.col(c) for c, kind in table.dtypes if kind == "double"]
        plain = [F.coalesce(c == F.round(c, 3), F.lit(True)) for c in numbers]
        part = table.select(
            F.lit(name).alias("name"), F.col("k" if "k" in table.columns else "model").cast("string").alias("subject"),
            (F.least(*plain) if len(plain) > 1 else plain[0]).alias("rounded"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@check("build_then_train", on(WITH_INC, f"""SELECT month, count(*) AS rows, count(*) AS ids, true AS split
  FROM ded WHERE {month_sql("month")} IS NOT NULL GROUP BY 1""", REC, "inc2 AS (SELECT api_id AS id, * FROM flat)",
  "cov AS (SELECT * FROM inc2 WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND " + polygon_sql() + ")", NRM, DED))
def build_then_train(spark, folder):
    """From landed files to labels by id: rows and ids per month of the built table, split and labelled without further ado."""
    landed, tables = scratch_path(spark, "landing"), scratch_path(spark, "tables")
    landing.land_month(_records(spark, folder), landed)
    gold = build.build(spark, landed, tables, multi_line=False, with_eda=False)
    split = sampling.stratified_split(gold).select("id", "is_test")
    labels = quality.nearest_centroid(gold, HUBS, "latitude", "longitude", "kmeans_label").select("id", "kmeans_label")
    return gold.join(split, "id").join(labels, "id").groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
        F.bool_and(F.col("is_test").isin(0, 1) & F.col("kmeans_label").isNotNull()).alias("split"),
    )


@check("incremental_load", on(WITH_INC, """SELECT month, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT api_id) AS BIGINT) AS ids FROM flat GROUP BY 1""", REC))
def incremental_load_check(spark, folder):
    """Files arrive in two turns, the second one publishing the older months again."""
    landed, table, state = (scratch_path(spark, n) for n in ("landing", "incidents", "stream"))
    records = _records(spark, folder)
    landing.land_month(records.filter("file_month <= '1998-06'"), f"{landed}/first")
    incremental_load(spark, landed, table, state)
    landing.land_month(records, f"{landed}/second")
    incremental_load(spark, landed, table, state)
    return store.load_raw(spark, table).groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("api_id").alias("ids"))



"""Forecasters and classifiers: properties, failures and storage."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.base import features
from streetlens import config
from streetlens.operators import sampling, arima, classify, forest_forecast, panel, priors, seasonal
from streetlens.plans import build, dashboard, forecast, train
from streetlens.session import cut
from streetlens.sources import models, results

SMALL = replace(config.CLASSIFIER, forest_trees=8, forest_depth=5, boost_rounds=3, logistic_iter=50, svm_features=32, cv_folds=2)


def months(n):
    return [date(2010 + i // 12, i % 12 + 1, 1) for i in range(n)]


def series(spark, **named):
    return cut(spark.createDataFrame(
        [(k, m, float(v)) for k, values in named.items() for m, v in zip(months(len(values)), values)], "key string, month_date date, y double"))


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(5)
    noise = rng.normal(0, 5, 600)
    ar = np.zeros(600)
    for i in range(1, 600):
        ar[i] = 0.7 * ar[i - 1] + noise[i]
    return series(
        spark, stationary=100 + ar, walk=100 + np.cumsum(noise), twice=np.cumsum(np.cumsum(noise)),
        short=[1.0, 2.0, 3.0], flat=[7.0] * 60,
    )


def brute_adf(y):
    x, z = y[:-1], np.diff(y)
    design = np.column_stack([np.ones(len(x)), x])
    beta, *_ = np.linalg.lstsq(design, z, rcond=None)
    rss = ((z - design @ beta) ** 2).sum()
    return beta[1] / np.sqrt(rss / (len(z) - 2) * np.linalg.inv(design.T @ design)[1, 1])


def test_unit_root(many):
    out = {(r["key"], r["d"]): r for r in arima.adf_panel(many, ["key"], 2).collect()}
    y = [r["y"] for r in many.filter("key = 'walk'").orderBy("month_date").collect()]
    assert out["walk", 0]["adf_stat"] == pytest.approx(brute_adf(np.array(y)), rel=1e-6)
    lagged = {r["key"]: r for r in arima.adf_panel(many, ["key"], 0, lags=3).collect()}
    assert lagged["stationary"]["stationary"] and not lagged["walk"]["stationary"]
    chosen = {r["key"]: r["d"] for r in arima.choose_d(arima.adf_panel(many, ["key"], 2), ["key"]).collect()}
    assert chosen["stationary"] == 0 and chosen["walk"] == 1 and chosen["twice"] == 2


def test_order_search_recovers_and_reports_failures(many):
    out = {r["key"]: r for r in arima.arima_order_search(many, ["key"]).collect()}
    assert out["stationary"]["error"] is None and out["stationary"]["d"] == 0 and len(out["stationary"]["forecast"]) == 3
    ar1 = replace(config.FORECAST, orders=((1, 0, 0),))
    only = {r["key"]: r for r in arima.arima_order_search(many, ["key"], ar1).collect()}
    assert only["stationary"]["coefficients"][1] == pytest.approx(0.7, abs=0.1)
    assert out["short"]["error"] is not None and out["short"]["forecast"] is None


def test_seasonal_fit(spark):
    m = np.arange(72)
    wave = 500 + 2 * m + 80 * np.sin(2 * np.pi * m / 12)
    out = seasonal.seasonal_trend_fit(series(spark, wave=wave, down=100 - 3.0 * np.arange(40)), ["key"])
    rows = out.filter("key = 'wave'").orderBy("month_date").collect()
    assert len(rows) == 75 and sum(r["is_future"] for r in rows) == 3
    fit = np.array([r["yhat"] for r in rows[:72]])
    assert np.abs(fit - wave).max() < 25
    want = 500 + 2 * np.arange(72, 75) + 80 * np.sin(2 * np.pi * np.arange(72, 75) / 12)
    assert np.abs(np.array([r["yhat"] for r in rows[72:]]) - want).max() < 60
    assert out.filter("yhat < 0 OR yhat_lower > yhat OR yhat > yhat_upper").count() == 0
    assert out.filter("key = 'down' AND is_future = 1 AND yhat = 0").count() == 3


def test_walk_forward_keeps_the_other_model_when_one_fails(spark):
    rng = np.random.default_rng(6)
    cv = forecast.walk_forward_cv(series(spark, a=50 + rng.normal(0, 3, 30), flat=[4.0] * 20), ["key"])
    rows = cv.collect()
    by = {(r["key"], r["model"]) for r in rows}
    # a constant series has singular regressions, but the trend still fits
    assert ("a", "ARIMA") in by and ("a", "Seasonal") in by and ("flat", "Seasonal") in by and ("flat", "ARIMA") not in by
    a = [r for r in rows if r["key"] == "a" and r["model"] == "Seasonal"]
    assert sorted(r["fold"] for r in a) == list(range(1, 10))
    assert all(r["rmse"] >= r["mae"] >= 0 for r in rows)


def test_forecast_run_fills_gaps(spark, tmp_path):
    counts = spark.createDataFrame([(m, 100 + (i % 12)) for i, m in enumerate(months(40)) if i != 7], "month_date date, crime_count long")
    run = forecast.forecast_run(counts)
    assert run.full.count() == 43
    future = run.future.orderBy("date").collect()
    assert [str(r["date"]) for r in future] == ["2013-05-01", "2013-06-01", "2013-07-01"]
    assert {r["model"] for r in run.summary.collect()} == {"ARIMA", "Seasonal"}
    results.write_results({"forecast_cv": run.cv.drop("series"), "future_forecast": run.future.drop("series")}, str(tmp_path))
    back = results.read_result_csv(spark, str(tmp_path / "forecast_cv"), "forecast_cv")
    assert back.count() == run.cv.count() and dict(back.dtypes)["cutoff"] == "date"


def test_panel_forest(spark, tmp_path):
    rows = [(c, m) for c, k in (("a", 3), ("b", 9)) for m in months(30) for _ in range(k)]
    df = spark.createDataFrame(rows, "category string, month_date date")
    settings = replace(config.PANEL, trees=5, max_depth=5)
    run = train.rf_run(df, settings, str(tmp_path))
    future = run.future.orderBy("category", "month_date").collect()
    assert [str(r["month_date"]) for r in future[:3]] == ["2012-07-01", "2012-08-01", "2012-09-01"]
    assert [round(r["rf_forecast"], 6) for r in future] == [3.0] * 3 + [9.0] * 3
    assert [r["rf_forecast"] for r in run.total.collect()] == [12.0] * 3
    m = run.metrics.first()
    assert (m["train_rows"], m["test_rows"], m["mae"]) == (42, 6, 0.0)
    assert results.read_result_csv(spark, str(tmp_path / "forecast_rf_future"), "forecast_rf_future").count() == 6
    again = models.load_model(str(tmp_path / "models/forest"), "panel_forest")
    pnl = panel.build_panel(df, settings)
    assert again.transform(pnl).filter("abs(yhat - count) > 1e-9").count() == 0
    short = panel.build_panel(df.filter("month_date < '2010-10-01'"), settings)
    assert forest_forecast.recursive_forecast(short, run.forest).count() == 0
    assert train.rf_run(df.limit(0), settings) is None


@pytest.fixture(scope="module")
def view(spark, folder):
    return cut(features(spark, folder))


def test_three_classifiers(view):
    run = classify.fit_classifiers(view, SMALL)
    rows = {r["model"]: r for r in run.metrics.collect()}
    assert set(rows) == {"logistic_regression", "random_forest", "gradient_boosting"}
    for r in rows.values():
        assert all(0 <= r[k] <= 1 for k in ("accuracy", "f1", "precision", "recall", "roc_auc", "cv_roc_auc_mean", "cv_roc_auc_std"))
    assert run.report.filter("row = 'accuracy'").count() == 3
    sizes = {r["is_test"]: r["rows"] for r in run.balance.collect()}
    assert sizes[1] == pytest.approx(0.2 * view.count(), abs=2)


def test_older_variants_and_svm(view):
    run = classify.fit_classifiers(view, replace(SMALL, class_weight=None), ["svm"], cross_validate=False, variant="basic")
    row = run.metrics.first()
    assert row["model"] == "svm" and 0 <= row["roc_auc"] <= 1
    raw = classify.fit_classifiers(view, SMALL, ["logistic_regression"], cross_validate=False, variant="raw_prior")
    assert raw.metrics.count() == 1


def test_classifiers_on_separable_data(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), int(a * a + b * b < 1)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    df = cut(spark.createDataFrame(rows, "id long, x double, y double, label int"))
    for name in ("random_forest", "gradient_boosting", "svm"):
        fitted = classify.FITTERS[name](df.filter("id < 450"), ["x", "y"], replace(SMALL, boost_rounds=10))
        assert classify.evaluate(cut(fitted.score(df.filter("id >= 450")))).first()["roc_auc"] > 0.9
    small = classify.fit_svm(df, ["x", "y"], SMALL, max_rows=200)
    assert classify.evaluate(cut(small.score(df))).first()["roc_auc"] > 0.85


def test_rates_never_see_held_out_rows(view):
    flagged = view.withColumn("is_test", (F.col("id") % 2).cast("int"))
    train_rows = flagged.filter("is_test = 0")
    flipped = flagged.withColumn("is_violent", F.when(F.col("is_test") == 1, 1 - F.col("is_violent")).otherwise(F.col("is_violent")))
    a = priors.build_features(flagged, train_rows).drop("label")
    b = priors.build_features(flipped, flipped.filter("is_test = 0")).drop("label")
    assert a.exceptAll(b).count() == 0


def test_stored_classifiers_score_as_before(spark, tmp_path, view):
    rows = cut(priors.build_features(view.withColumn("is_test", F.lit(0)), view, keep=("id",)))
    names = priors.feature_names()
    for name in ("logistic_regression", "svm"):
        fitted = classify.FITTERS[name](rows, names, SMALL)
        models.save_models(spark, fitted.stages, str(tmp_path / name), fitted.facts)
        stages = {stage: models.load_model(str(tmp_path / name), stage) for stage in fitted.stages}
        again = classify.restored(name, stages, models.facts_of(spark, str(tmp_path / name)))
        before = fitted.score(rows).select("id", "prediction", F.round("score", 9).alias("score"))
        assert before.exceptAll(again.score(rows).select("id", "prediction", F.round("score", 9).alias("score"))).isEmpty()


def test_unknown_class_weight_is_refused(view):
    with pytest.raises(ValueError):
        classify.fit_logistic(view.withColumn("label", F.col("is_violent")), ["latitude"], replace(SMALL, class_weight="subsample"))


def test_order_search_takes_its_widths_from_the_settings(spark):
    rng = np.random.default_rng(3)
    y = np.zeros(240)
    for t in range(4, 240):
        y[t] = 0.5 * y[t - 1] - 0.4 * y[t - 4] + rng.normal()
    series = spark.createDataFrame([("s", d, float(v)) for d, v in zip(months(240), 50 + y)], "key string, month_date date, y double")
    # a candidate may turn out unstable, but then it only loses itself
    for orders, max_d in ((((4, 0, 0), (1, 0, 3)), 1), (((1, 0, 0), (0, 0, 0)), 0)):
        row = arima.arima_order_search(series, ["key"], replace(config.FORECAST, orders=orders, max_d=max_d)).first()
        assert row["error"] is None and len(row["forecast"]) == 3 and (row["p"], row["q"]) in [(o[0], o[2]) for o in orders]
    wide = arima.arima_order_search(series, ["key"], replace(config.FORECAST, orders=((1, 0, 3),), max_d=1)).first()
    assert (wide["error"] is None) == (wide["forecast"] is not None)
    best = arima.arima_order_search(series, ["key"], replace(config.FORECAST, orders=((4, 0, 0),), max_d=0)).first()
    assert abs(best["coefficients"][1] - 0.5) < 0.15 and abs(best["coefficients"][4] + 0.4) < 0.15


def test_build_then_dashboard(spark, folder, tmp_path):
    from streetlens.incident_view import nested_records
    from streetlens.sources import landing

    landed = str(tmp_path / "landing")
    landing.land_month(nested_records(spark.read.parquet(f"{folder}/orders.parquet")), landed)
    gold = build.build(spark, landed, str(tmp_path / "tables"), multi_line=False)
    assert {"year", "season", "grid_id", "is_violent"} <= set(gold.columns)
    total = gold.count()
    assert spark.read.parquet(str(tmp_path / "tables/aggregates/agg_monthly")).agg(F.sum("crime_count")).first()[0] == total
    assert spark.read.parquet(str(tmp_path / "tables/eda/spatial_density")).agg(F.sum("count")).first()[0] == total
    assert gold.filter("id IS NULL").count() == 0 and gold.select("id").distinct().count() == total
    split = sampling.stratified_split(gold)
    assert split.count() == total and 0 < split.filter("is_test = 1").count() < total
    labels = gold.select("id", "latitude", "longitude", "month", F.lit(1).alias("kmeans_label"))
    shown = dashboard.scatter_rows(gold, labels, "kmeans", limit=50)
    assert shown.count() == 50 and {r["colour"] for r in shown.collect()} == {"1"}
    with pytest.raises(ValueError):
        build.build(spark, None, str(tmp_path / "nothing"))

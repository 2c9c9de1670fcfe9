"""Running cross products, unit-root lags and p-values, and folds that equal fits of truncated series."""

import math
import re
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import arima, folds, seasonal
from streetlens.operators.least_squares import running_products, square


def months(n):
    return [date(2000 + k // 12, 1 + k % 12, 1) for k in range(n)]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(12)
    rows = []
    for key, n in (("a", 61), ("b", 40), ("c", 15), ("d", 4), ("e", 97)):
        noise = rng.normal(0, 9, n)
        y = 300 + 2.0 * np.arange(n) + 40 * np.sin(np.arange(n) / 1.9) + (np.cumsum(noise) if key in "be" else noise)
        rows += [(key, m, float(v)) for m, v in zip(months(n), y)]
    return spark.createDataFrame(rows, "key string, month_date date, y double").cache()


def values(series, key):
    return np.array([r["y"] for r in series.filter(F.col("key") == key).orderBy("month_date").collect()])


def test_running_products_between_positions(spark, series):
    rows = folds.number_rows(series.repartition("key"), ["key"])
    at = F.array(F.lit(2), F.floor(F.col("idx") / 2), F.col("idx") + 1)
    sets = {"one": ([F.lit(1.0), F.col("idx"), F.lag("y", 2).over(arima.Window.partitionBy("key").orderBy("idx"))], at)}
    ended = F.when(F.col("idx") % 7 == 0, F.array(F.col("idx"))).otherwise(F.array().cast("array<int>"))
    got = running_products(rows, ["key"], "idx", sets, ended, F.col("y").alias("last")).collect()
    assert len(got) == sum(-(-n // 7) for n in (61, 40, 15, 4, 97))
    for r in got:
        y, c = values(series, r["key"]), r["ended"][0] + 1
        x = np.column_stack([np.ones(len(y)), np.arange(len(y)), np.r_[0.0, 0.0, y[:-2]][: len(y)]])
        places = np.maximum.accumulate(np.minimum([2, (c - 1) // 2, c], c))
        assert r["last"] == y[c - 1]
        for k, triangle in enumerate(r["one"]):
            part = x[places[k] : places[k + 1]]
            assert np.allclose(square(triangle), part.T @ part, rtol=1e-12, atol=1e-9)


@pytest.mark.parametrize("lags", [0, None])
def test_a_fold_is_the_fit_of_the_truncated_series(series, lags):
    every = {(r["key"], r["fold"]): r for r in arima.arima_order_search(series, ["key"], folds=True, lags=lags).collect()}
    cuts = {(r["key"], r["fold"]): r["cutoff"] for r in folds.fold_cutoffs(series, ["key"]).collect()}
    assert set(every) == set(cuts) | {(k, 0) for k in "abcde"}
    numbered = folds.number_rows(series, ["key"])
    for fold in (1, 2, 9):
        short = numbered.filter(F.col("idx") < 10 + 2 * (fold - 1)).select("key", "month_date", "y")
        alone = {r["key"]: r for r in arima.arima_order_search(short, ["key"], lags=lags).collect()}
        coefficients = {r["key"]: r for r in seasonal.seasonal_coefficients(short, ["key"]).collect()}
        both = {(r["key"], r["fold"]): r for r in seasonal.seasonal_coefficients(series, ["key"], folds=True).collect()}
        for key in "abce":
            if (key, fold) not in cuts:
                continue
            one, two = every[key, fold], alone[key]
            assert (one["p"], one["d"], one["q"], one["used_lags"], one["error"]) == (two["p"], two["d"], two["q"], two["used_lags"], two["error"])
            if one["error"] is None:
                assert one["forecast"] == pytest.approx(two["forecast"], rel=1e-9) and one["aic"] == pytest.approx(two["aic"], rel=1e-9)
            assert both[key, fold]["beta"] == pytest.approx(coefficients[key]["beta"], rel=1e-7, abs=1e-7)


def brute_test(y, most):
    """Least AIC over all lags, each regression by its own least squares on the common sample."""
    change, level = np.diff(y), y[:-1]
    rows = range(most, len(change))
    best = (np.inf, None, None)
    for p in range(most + 1):
        x = np.array([[1.0, level[t], *(change[t - i] for i in range(1, p + 1))] for t in rows])
        z, n = change[most:], len(change) - most
        if n <= p + 2:
            continue
        beta = np.linalg.lstsq(x, z, rcond=None)[0]
        rss = ((z - x @ beta) ** 2).sum()
        stat = beta[1] / math.sqrt(rss / (n - p - 2) * np.linalg.inv(x.T @ x)[1, 1])
        best = min(best, (n * math.log(rss / n) + 2 * (p + 2), p, stat))
    return best[1:]


def test_lags_follow_the_length_and_aic(series):
    for r in arima.arima_order_search(series, ["key"]).filter("key in ('a', 'b', 'e')").collect():
        y = np.diff(values(series, r["key"]), n=r["d"])
        n = len(y) + r["d"]
        most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
        assert most == arima.most_lags(n) and most > 8
        p, stat = brute_test(y, most)
        assert (r["used_lags"], r["adf_stat"]) == (p, pytest.approx(stat, rel=1e-6))
        assert r["p_value"] < 0.05 or r["d"] == 2


def shocks_of(y, d, phi, theta, const, start):
    """Shocks by the recursion, one row after another; those before ``start`` are 0."""
    w, e = np.diff(y, d), np.zeros(len(y) - d)
    for t in range(start, len(w)):
        e[t] = w[t] - const - sum(c * w[t - 1 - i] for i, c in enumerate(phi)) - sum(c * e[t - 1 - i] for i, c in enumerate(theta) if t - 1 - i >= 0)
    return e


def test_planted_coefficients_come_back(spark):
    rng = np.random.default_rng(12)
    n = 3000
    e = rng.normal(0, 3, n)
    ar = np.zeros(n)
    for t in range(2, n):
        ar[t] = 0.5 * ar[t - 1] - 0.3 * ar[t - 2] + e[t]
    ma = 20 + e + 0.8 * np.r_[0.0, e[:-1]]
    first = date(1800, 1, 1)
    rows = [(k, first + timedelta(days=i), float(v)) for k, y in (("ar", 50 + ar), ("ma", ma)) for i, v in enumerate(y)]
    frame = spark.createDataFrame(rows, "key string, month_date date, y double")
    one = {r["key"]: r for r in arima.arima_order_search(frame, ["key"], replace(config.FORECAST, orders=((2, 0, 0),))).collect()}["ar"]
    assert one["coefficients"][1:] == pytest.approx([0.5, -0.3], abs=0.05) and one["d"] == 0
    two = {r["key"]: r for r in arima.arima_order_search(frame, ["key"], replace(config.FORECAST, orders=((0, 0, 1),))).collect()}["ma"]
    assert two["coefficients"] == pytest.approx([20, 0.8], abs=0.3) and two["coefficients"][1] == pytest.approx(0.8, abs=0.05)


def test_aic_and_forecast_come_from_the_shocks(series):
    for orders in (((2, 1, 1),), ((0, 1, 2),), ((1, 0, 1), (3, 1, 1))):
        for r in arima.arima_order_search(series, ["key"], replace(config.FORECAST, orders=orders)).filter("error is null").collect():
            y, p, d, q = values(series, r["key"]), r["p"], r["d"], r["q"]
            most_p = max(o[0] for o in orders)
            beta = np.array(r["coefficients"])
            const, rest = (beta[0], beta[1:]) if d == 0 else (0.0, beta)

            def rss(x):
                return (shocks_of(y, d, x[:p], x[p:], const, most_p) ** 2).sum()

            n = len(y) - d - most_p
            assert r["aic"] == pytest.approx(n * math.log(rss(rest) / n) + 2 * (p + q + 1), rel=1e-9)
            e, w = shocks_of(y, d, rest[:p], rest[p:], const, most_p), np.diff(y, d)
            step = const + sum(c * w[-1 - i] for i, c in enumerate(rest[:p])) + sum(c * e[-1 - i] for i, c in enumerate(rest[p:]))
            level = step if d == 0 else y[-1] + step if d == 1 else 2 * y[-1] - y[-2] + step
            assert r["forecast"][0] == pytest.approx(level, rel=1e-9)
            # no nearby valid coefficients have smaller shocks
            for k in range(p + q):
                for move in (-1e-3, 1e-3):
                    x = rest.copy()
                    x[k] += move
                    if max(arima._largest_root(x[None, :p])[0], arima._largest_root(-x[None, p:])[0]) < 1:
                        assert rss(x) >= rss(rest) * (1 - 1e-5)


def test_p_values_at_published_points(spark):
    stats = [(-30.0, 0.0), (-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (0.0, 0.958), (5.0, 1.0)]
    rows = spark.createDataFrame(stats, "stat double, p double").withColumn("got", arima.unit_root_p_value(F.col("stat"))).collect()
    for r in rows:
        assert r["got"] == pytest.approx(r["p"], abs=2e-3)
        assert r["got"] == pytest.approx(arima._unit_root_p(r["stat"]), abs=1e-6)


def test_no_row_is_copied_into_a_fold(series):
    for frame in (arima.arima_order_search(series, ["key"], folds=True), seasonal.seasonal_coefficients(series, ["key"], folds=True)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        # the only rows that are multiplied are ends of training windows, above the sums
        assert text.index("Generate") < text.index("MapInArrow") and len(re.findall("Generate", text)) == len(re.findall("Generate explode", text)) == 1
        assert text.count("Exchange") == 1


def test_tests_of_folds_are_those_of_the_expanded_rows(series):
    s = config.FORECAST
    wide = folds.fold_expand(series, ["key"], s).filter("is_test = 1").select("key", "fold", "month_date", "y", "cutoff")
    own = folds.fold_tests(series, ["key"], s)
    assert sorted(map(tuple, own.select(*wide.columns).collect())) == sorted(map(tuple, wide.collect()))
    assert {r["step"] for r in own.collect()} == {1, 2, 3}


def test_null_values_and_empty_series(spark, series):
    holes = series.withColumn("y", F.when(F.col("key") == "d", None).otherwise(F.col("y")))
    assert {r["key"] for r in arima.arima_order_search(holes, ["key"]).collect()} == set("abce")
    assert arima.arima_order_search(series.limit(0), ["key"], folds=True).collect() == []
    assert seasonal.seasonal_trend_fit(series.limit(0), ["key"], folds=True).collect() == []


def test_a_planted_bend_is_the_only_one(spark):
    n, rng = 121, np.random.default_rng(3)
    reach = n - 1
    rows = []
    for key, at in (("third", 3), ("sixth", 6)):
        knot = 0.8 * at / 8 * reach
        y = 500 + 0.5 * np.arange(n) + 6.0 * np.maximum(np.arange(n) - knot, 0) + 20 * np.sin(2 * np.pi * np.arange(n) / 12) + rng.normal(0, 1.0, n)
        rows += [(key, m, float(v)) for m, v in zip(months(n), y)]
    rows += [("none", m, float(v)) for m, v in zip(months(n), 300 + 2.0 * np.arange(n) + rng.normal(0, 3.0, n))]
    series = spark.createDataFrame(rows, "key string, month_date date, y double")
    found = {r["key"]: np.array(r["beta"])[2:10] / reach for r in seasonal.seasonal_coefficients(series, ["key"]).collect()}
    assert np.flatnonzero(found["third"]).tolist() == [2] and found["third"][2] == pytest.approx(6.0, abs=0.3)
    assert np.flatnonzero(found["sixth"]).tolist() == [5] and found["sixth"][5] == pytest.approx(6.0, abs=0.3)
    assert not found["none"].any()


def test_the_band_covers_four_fifths(spark):
    rng, n, rows = np.random.default_rng(9), 123, []
    for k in range(250):
        y = 400 + 1.5 * np.arange(n) + 30 * np.sin(2 * np.pi * np.arange(n) / 12) + rng.normal(0, 8.0, n)
        rows += [(k, m, float(v)) for m, v in zip(months(n), y)]
    series = spark.createDataFrame(rows, "key long, month_date date, y double")
    known = series.filter(F.col("month_date") < months(n)[n - 3])
    out = seasonal.seasonal_trend_fit(known, ["key"])
    history = out.filter("is_future = 0").agg(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int"))).first()[0]
    ahead = out.filter("is_future = 1").drop("y").join(series, ["key", "month_date"])
    future = ahead.agg(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int"))).first()[0]
    assert 0.75 <= history <= 0.85 and 0.75 <= future <= 0.85

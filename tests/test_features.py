"""Features, aggregates, panels and their invariants."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.base import cleaned
from streetlens.functions import dates, geo
from streetlens.operators import aggregates as agg
from streetlens.operators import features as feat
from streetlens.operators import folds, panel
from streetlens.plans import dashboard


@pytest.fixture(scope="module")
def clean_rows(spark):
    cats = ["burglary", "violent-crime", "robbery", "drugs"]
    return spark.createDataFrame([
        (i * 4 + j, c, f"2023-{i + 1:02d}", date(2023, i + 1, 1), 53.38 + 0.001 * (i + j), -1.47 - 0.001 * (i + j), f"Street {j}", j)
        for i in range(12) for j, c in enumerate(cats)
    ], "id long, category string, month string, month_date date, latitude double, longitude double, street_name string, street_id long")


def test_temporal(clean_rows):
    out = feat.add_temporal(clean_rows).select("month_num", "quarter", "season").distinct().collect()
    got = {r["month_num"]: (r["quarter"], r["season"]) for r in out}
    assert got[12] == (4, "winter") and got[1] == (1, "winter") and got[3] == (1, "spring") and got[8] == (3, "summer") and got[9] == (3, "autumn")


def test_target(clean_rows):
    assert feat.add_target(clean_rows).agg(F.sum("is_violent")).first()[0] == 24


def test_bins_match_numpy_at_every_edge(spark):
    rng = np.random.default_rng(7)
    lo, hi, n = 53.3012, 53.4809, 50
    edges = np.linspace(lo, hi, n + 1)
    values = np.concatenate([edges, np.nextafter(edges, 0)[1:], np.nextafter(edges, 99)[:-1], rng.uniform(lo, hi, 500)])
    want = np.clip(np.digitize(values, edges) - 1, 0, n - 1)
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, want)], "x double, want int")
    out = df.withColumn("got", geo.grid_bin(F.col("x"), F.lit(lo), F.lit(hi), n))
    assert out.filter("got <> want OR got IS NULL").count() == 0


def test_degenerate_grid_and_fixed_bounds(spark, clean_rows):
    one = spark.createDataFrame([(53.4, -1.5), (53.4, -1.5)], "latitude double, longitude double")
    assert {r["grid_id"] for r in feat.add_spatial_bins(one, 20).collect()} == {"19_19"}
    out = feat.add_spatial_bins(clean_rows, 20)
    assert out.filter("grid_lat NOT BETWEEN 0 AND 19 OR grid_lng NOT BETWEEN 0 AND 19").count() == 0
    b = feat.coord_extent(clean_rows).first()
    fixed = feat.add_spatial_bins(clean_rows, 20, tuple(b))
    assert fixed.select("id", "grid_id").exceptAll(out.select("id", "grid_id")).count() == 0


def test_monthly_and_weekly_totals_agree(clean_rows):
    monthly = agg.monthly_totals(clean_rows).collect()
    assert [r["crime_count"] for r in monthly] == [4] * 12
    assert agg.monthly_by_category(clean_rows).count() == 48
    weekly = agg.weekly_by_category(clean_rows)
    assert weekly.agg(F.sum("crime_count")).first()[0] == pytest.approx(48)
    # January 2023 has five Mondays, February four
    per_week = {r["m"]: r["n"] for r in weekly.groupBy(F.month("week_start").alias("m")).agg(F.count_distinct("week_start").alias("n")).collect()}
    assert per_week[1] == 5 and per_week[2] == 4


def test_month_starting_on_monday(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "m date")
    days = df.select(dates.mondays_of_month(F.col("m")).alias("d")).first()["d"]
    assert [d.day for d in days] == [1, 8, 15, 22, 29]


def test_kpis_and_empty_filter(clean_rows):
    row = agg.kpis(clean_rows).first()
    assert (row["total"], row["months"], row["avg_per_month"], row["top_category"], row["streets"]) == (48, 12, 4.0, "burglary", 4)
    none = agg.kpis(clean_rows.limit(0)).first()
    assert (none["total"], none["months"], none["avg_per_month"], none["top_category"], none["streets"]) == (0, 0, 0.0, None, 0)
    cards = dashboard.kpi_cards(clean_rows).first()
    assert cards["top_category"] == "Burglary" and cards["months"] == "12 months"


def test_filters(clean_rows):
    assert dashboard.dashboard_filter(clean_rows).count() == 48
    assert dashboard.dashboard_filter(clean_rows, "2023-03-01", date(2023, 4, 1)).count() == 8
    assert dashboard.dashboard_filter(clean_rows, categories=["drugs"], streets=["Street 3"]).count() == 12
    assert dashboard.dashboard_filter(clean_rows, categories=[], streets=None).count() == 48


def test_hexbin_against_brute_force(spark):
    rng = np.random.default_rng(3)
    lng, lat = rng.normal(-1.47, 0.05, 800), rng.normal(53.38, 0.04, 800)
    df = spark.createDataFrame(list(zip(map(float, lat), map(float, lng))), "latitude double, longitude double")
    cells = agg.hexbin_density(df).collect()
    assert sum(c["count"] for c in cells) == 800
    # every point belongs to the nearest centre in the lattice metric
    nx, ny = 60, 34
    x0, x1, y0, y1 = lng.min(), lng.max(), lat.min(), lat.max()
    px, py = 1e-9 * (x1 - x0), 1e-9 * (y1 - y0)
    sx, sy = (x1 - x0 + 2 * px) / nx, (y1 - y0 + 2 * py) / ny
    whole = [(i * sx + x0 - px, j * sy + y0 - py) for i in range(nx + 1) for j in range(ny + 1)]
    half = [((i + 0.5) * sx + x0 - px, (j + 0.5) * sy + y0 - py) for i in range(nx) for j in range(ny)]
    centres = np.array(whole + half)
    d = ((lng[:, None] - centres[:, 0]) / sx) ** 2 + 3 * ((lat[:, None] - centres[:, 1]) / sy) ** 2
    nearest = np.bincount(d.argmin(axis=1), minlength=len(centres))
    want = sorted((round(c[0], 6), round(c[1], 6), int(n)) for c, n in zip(centres, nearest) if n)
    assert sorted((round(c["lng_c"], 6), round(c["lat_c"], 6), c["count"]) for c in cells) == want


def test_panel_pads_and_lags(spark):
    rows = [("a", date(2023, m, 1)) for m in range(1, 13)] * 2 + [("b", date(2023, 1, 1)), ("b", date(2023, 12, 1))]
    out = panel.build_panel(spark.createDataFrame(rows, "category string, month_date date")).orderBy("category", "month_date").collect()
    assert len(out) == 12
    b_last = out[-1]
    assert (b_last["count"], b_last["lag_1"], b_last["roll3"], b_last["t"], b_last["cat_enc"]) == (1, 0, 0.0, 12, 1)
    assert (out[0]["lag_6"], out[0]["roll3"], out[0]["month_n"]) == (2, 2.0, 7)


def test_rolling_mean_of_short_history(spark):
    df = spark.createDataFrame([("a", date(2023, m, 1), v) for m, v in [(1, 2), (2, 4), (3, 9)]], "category string, month_date date, count long")
    out = [r["roll3"] for r in panel.add_rolling_mean(df).orderBy("month_date").collect()]
    assert out == [None, 2.0, 3.0]


def test_folds(spark):
    def series(n):
        return spark.createDataFrame([("s", date(2020 + i // 12, i % 12 + 1, 1), float(i)) for i in range(n)], "key string, month_date date, y double")

    assert folds.fold_cutoffs(series(12), ["key"]).count() == 0
    cuts = folds.fold_cutoffs(series(16), ["key"]).orderBy("fold").collect()
    assert [(r["fold"], r["cutoff"]) for r in cuts] == [(1, 10), (2, 12)]
    assert str(cuts[0]["cutoff_month"]) == "2020-10-01"
    sizes = folds.fold_expand(series(16), ["key"], final=True).groupBy("fold", "is_test").count().collect()
    assert {(r["fold"], r["is_test"], r["count"]) for r in sizes} == {(0, 0, 16), (1, 0, 10), (1, 1, 3), (2, 0, 12), (2, 1, 3)}


def test_invariants_on_the_view(spark, folder):
    df = cleaned(spark, folder).persist()
    total = df.count()
    assert agg.monthly_totals(df).agg(F.sum("crime_count")).first()[0] == total
    assert agg.weekly_by_category(df).agg(F.sum("crime_count")).first()[0] == pytest.approx(total)
    assert agg.hexbin_density(df).agg(F.sum("count")).first()[0] == total
    df.unpersist()

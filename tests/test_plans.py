"""Physical plans: pushdown, pruning, no row-wise Python, no pairwise joins; all SQL checks at the smallest scale."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import tools_check
from checks.base import QUERIES, SQL
from __spark_entry__ import entry, oracle_sql, queries
from streetlens.operators import clean as ops
from streetlens.operators.priors import share_counts
from streetlens.plans.dashboard import dashboard_filter


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "incidents")
    df = QUERIES["clean"](spark, folder)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_polygon_box_reaches_the_scan(stored):
    text = plan(ops.validate_coords(stored).select("id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(latitude,53.3)" in pushed and "LessThanOrEqual(longitude,-1.3)" in pushed
    assert "ReadSchema: struct<id:bigint,latitude:double,longitude:double>" in text


def test_filters_reach_the_scan(stored):
    text = plan(dashboard_filter(stored, "1996-01-01", None, ["drugs"]).groupBy("month_date").count())
    assert "GreaterThanOrEqual(month_date,1996-01-01)" in text and "EqualTo(category,drugs)" in text
    assert "ReadSchema: struct<category:string,month_date:date>" in text


def test_duplicates_are_dropped_before_the_shuffle(stored):
    text = plan(ops.deduplicate(stored))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_counts_are_partial(stored):
    assert "partial_count" in plan(share_counts(stored, "street_name"))


# sinks, learned models and checks that run jobs while they are being put together
EAGER = {n for n in QUERIES if n not in SQL} | {
    "kmeans_sweep", "adf_panel_lagged", "arima_order_search", "seasonal_trend_fit", "walk_forward_cv", "forecast_run", "build_then_train",
    "logistic_regression", "random_forest_classifier", "gradient_boosting", "svm", "fit_classifiers", "rf_recursive_forecast", "rf_run",
    "cluster_run", "metrics_tables", "cat_code", "build_panel",
    "scan_incident_json", "quarantine_corrupt", "land_month", "ingest_months", "load_raw", "save_clean", "persist_aggregates",
    "read_result_csv", "write_results", "export_filtered", "save_labels", "save_models", "incremental_load", "rf_panel_fit",
    "dbscan", "dbscan_with_border", "eps_neighbours", "silhouette_exact", "silhouette_within", "silhouette_fast", "davies_bouldin", "inertia",
    "build_features", "build_features_basic", "build_features_raw_prior", "map_rate", "roc_auc", "cv_auc_stats",
}
# one or two per kind here; tools_check.py compares all of them
COMPARED = [
    "flatten_record", "insert_or_ignore", "clean", "weekly_by_category", "hexbin_density", "kpis", "build_panel", "fold_expand",
    "stratified_split", "build_features", "roc_auc", "class_report", "dbscan_with_border", "silhouette_exact", "adf_panel",
    "trend_layers", "ingest_months",
]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_plan_is_free_of_python_and_pairwise_joins(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", COMPARED)
def test_sql_agrees(spark, folder, connection, name):
    message, _, ok = tools_check.compare(spark, connection, name, QUERIES[name], SQL[name], folder)
    assert ok, message


@pytest.fixture(scope="module")
def connection(folder):
    con = duckdb.connect()
    for t in tools_check.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 739
    assert set(oracle_sql()) <= set(queries())
    assert df.agg(F.sum("crime_count")).first()[0] == 1285

"""Schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("location_type", T.StringType()),
        T.StructField("street", T.StructType([
            T.StructField("id", T.LongType()),
            T.StructField("name", T.StringType()),
        ])),
    ])),
    T.StructField("context", T.StringType()),
    T.StructField("outcome_status", T.StructType([
        T.StructField("category", T.StringType()),
        T.StructField("date", T.StringType()),
    ])),
    T.StructField("persistent_id", T.StringType()),
])

BRONZE_COLUMNS = (
    "api_id", "category", "month", "latitude", "longitude", "location_type", "street_id",
    "street_name", "context", "outcome_category", "outcome_date", "persistent_id",
)

# id tells the rows of the table apart; it follows from the source file and the record
TABLE_COLUMNS = ("id", *BRONZE_COLUMNS)

BRONZE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("api_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("location_type", T.StringType()),
    T.StructField("street_id", T.LongType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("outcome_category", T.StringType()),
    T.StructField("outcome_date", T.StringType()),
    T.StructField("persistent_id", T.StringType()),
])

UNIQUE_KEY = ("api_id", "month", "category", "latitude", "longitude")
REQUIRED = ("category", "month", "latitude", "longitude")

RESULT_TABLES = {
    "kmeans_sweep": T.StructType([
        T.StructField("k", T.IntegerType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("davies_bouldin", T.DoubleType()),
        T.StructField("inertia", T.DoubleType()),
        T.StructField("silhouette_kind", T.StringType()),
    ]),
    "forecast_cv": T.StructType([
        T.StructField("fold", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("cutoff", T.DateType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("order", T.StringType()),
    ]),
    "future_forecast": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("arima_forecast", T.DoubleType()),
        T.StructField("seasonal_forecast", T.DoubleType()),
    ]),
    "seasonal_full": T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("yhat_lower", T.DoubleType()),
        T.StructField("yhat_upper", T.DoubleType()),
    ]),
    "forecast_rf_metrics": T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae_pct_of_mean", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
    ]),
    "forecast_rf_future": T.StructType([
        T.StructField("month_date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("rf_forecast", T.DoubleType()),
    ]),
    "forecast_rf_future_total": T.StructType([
        T.StructField("month_date", T.DateType()),
        T.StructField("rf_forecast", T.DoubleType()),
    ]),
    "classifier_metrics": T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("cv_roc_auc_mean", T.DoubleType()),
        T.StructField("cv_roc_auc_std", T.DoubleType()),
    ]),
}

"""Fitted models on disk with a metadata table beside them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_models(spark: SparkSession, models: Mapping[str, Any], path: str, facts: Mapping[str, Any] | None = None) -> None:
    """Save each model under its name, plus (name, value) facts about them as a table."""
    base = path.rstrip("/")
    for name, model in models.items():
        stored = model if isinstance(model, PipelineModel) else PipelineModel([model])
        stored.write().overwrite().save(f"{base}/{name}")
    rows = [(k, str(v)) for k, v in {"models": ",".join(sorted(models)), **(facts or {})}.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{base}/facts")


def load_model(path: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{path.rstrip('/')}/{name}")


def load_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, value string").json(f"{path.rstrip('/')}/facts")


def facts_of(spark: SparkSession, path: str) -> dict[str, str]:
    """The facts beside stored models; as many as were given when they were saved."""
    return {r["name"]: r["value"] for r in load_facts(spark, path).collect()}


def save_series_fits(fits: DataFrame, path: str) -> None:
    """Coefficients of per-series models as a table."""
    fits.write.mode("overwrite").parquet(path)

"""One random forest over the (category, month) panel, and its recursive forecast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions.numbers import clip_non_negative
from streetlens.operators import metrics
from streetlens.operators.panel import distinct_pairs, feature_names, temporal_split
from streetlens.session import cut


@dataclass
class PanelForest:
    model: PipelineModel
    metrics: DataFrame
    settings: config.PanelSettings


def _pipeline(settings: config.PanelSettings) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=feature_names(settings), outputCol="features"),
        RandomForestRegressor(
            featuresCol="features", labelCol="count", predictionCol="yhat", numTrees=settings.trees,
            maxDepth=settings.max_depth, featureSubsetStrategy="all", minInstancesPerNode=1, seed=settings.seed,
            maxBins=settings.max_bins,
        ),
    ])


def fit_panel_forest(panel: DataFrame, settings: config.PanelSettings = config.PANEL) -> PanelForest:
    """Train on all but the last ``horizon`` months, score on those.

    With ``refit`` the model kept for forecasting has then seen every month.
    """
    split = cut(temporal_split(panel, settings.horizon))
    train, test = split.filter("is_test = 0"), split.filter("is_test = 1")
    model = _pipeline(settings).fit(train)
    scored = model.transform(test).select(F.col("count").cast("double").alias("y"), "yhat")
    sizes = split.agg(F.count_if(F.col("is_test") == 0).alias("train_rows"), F.count_if(F.col("is_test") == 1).alias("test_rows")).first()
    gap = F.col("y") - F.col("yhat")
    mean = F.avg("y")
    mae = F.avg(F.abs(gap))
    table = scored.agg(
        F.lit("RandomForest").alias("model"),
        F.round(mae, 2).alias("mae"),
        F.round(F.sqrt(F.avg(gap * gap)), 2).alias("rmse"),
        F.round(F.when(mean > 0, mae / mean * 100.0).otherwise(F.lit(float("nan"))), 1).alias("mae_pct_of_mean"),
    ).select(
        "*", F.lit(sizes["train_rows"]).cast("bigint").alias("train_rows"),
        F.lit(sizes["test_rows"]).cast("bigint").alias("test_rows"),
    )
    if settings.refit:
        model = _pipeline(settings).fit(split)
    return PanelForest(model, cut(table), settings)


def recursive_forecast(panel: DataFrame, forest: PanelForest, horizon: int | None = None) -> DataFrame:
    """(month_date, category, rf_forecast) for the coming months.

    Each step predicts all categories at once and joins the history of the next
    step. Categories with less history than the longest lag are left out. Only
    the last few months of the panel are carried along.
    """
    s = forest.settings
    horizon = s.horizon if horizon is None else horizon
    longest = max(*s.lags, s.roll)
    # the base year of t, as it was when the panel was built
    facts = panel.agg(
        F.max("month_date").alias("last"), F.min(F.col("year") - (F.col("t") - F.col("month_n")) / 12).cast("int").alias("base"),
    ).first()
    if facts["last"] is None:
        return panel.sparkSession.createDataFrame([], "month_date date, category string, rf_forecast double")
    last = F.lit(facts["last"])
    enough = panel.groupBy("category").agg(F.count(F.lit(1)).alias("months")).filter(F.col("months") >= max(s.lags))
    codes = distinct_pairs(panel).join(enough.select("category"), "category", "left_semi")
    history = cut(
        panel.filter(F.col("month_date") > F.add_months(last, -longest))
        .select("category", "month_date", F.col("count").cast("double").alias("count"))
        .join(codes, "category")
    )
    steps = None
    for step in range(1, horizon + 1):
        month = F.add_months(last, step)
        value = lambda k: F.max(F.when(F.col("month_date") == F.add_months(month, -k), F.col("count")))
        recent = F.col("month_date") >= F.add_months(month, -s.roll)
        row = history.groupBy("category", "cat_enc").agg(
            *[value(k).alias(f"lag_{k}") for k in s.lags],
            F.avg(F.when(recent, F.col("count"))).alias(f"roll{s.roll}"),
        ).withColumns({
            "month_date": month, "month_n": F.month(month), "year": F.year(month),
            "t": (F.year(month) - facts["base"]) * 12 + F.month(month),
        })
        predicted = cut(forest.model.transform(row).select(
            "category", "cat_enc", "month_date", clip_non_negative(F.col("yhat")).alias("count")
        ))
        out = predicted.select("month_date", "category", F.col("count").alias("rf_forecast"))
        steps = out if steps is None else steps.unionByName(out)
        history = history.unionByName(predicted.select("category", "month_date", "count", "cat_enc"))
    return steps

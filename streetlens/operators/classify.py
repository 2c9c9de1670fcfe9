"""Classifiers of a 0/1 target with held-out and cross-validated scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import metrics, priors, sampling
from streetlens.session import cut

Scorer = Callable[[DataFrame], DataFrame]


@dataclass
class Fitted:
    """A fitted classifier: ``score`` adds prediction (0/1) and score (probability of 1)."""

    name: str
    score: Scorer
    stages: dict[str, PipelineModel] = field(default_factory=dict)
    facts: dict[str, object] = field(default_factory=dict)  # what scoring needs beside the stages


def _weighted(train: DataFrame, settings: config.ClassifierSettings) -> DataFrame:
    if settings.class_weight == "balanced":
        return sampling.with_class_weight(train, "label")
    if settings.class_weight is not None:
        raise ValueError(f"class_weight must be 'balanced' or None, not {settings.class_weight!r}")
    return train.withColumn("weight", F.lit(1.0))


def _scaled(train: DataFrame, width: int, out: str) -> list:
    """Stages from raw_features to z-scores with the deviation of the population; Spark's own scaler takes a sample's."""
    rows = train.count()
    ratio = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    return [
        StandardScaler(inputCol="raw_features", outputCol="sample_scores", withMean=True, withStd=True),
        ElementwiseProduct(scalingVec=Vectors.dense([ratio] * width), inputCol="sample_scores", outputCol=out),
    ]


def _probability(model: PipelineModel) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        drop = ["features", "raw_features", "sample_scores", "rawPrediction", "probability"]
        return (
            model.transform(df)
            .withColumns({"score": vector_to_array("probability")[1], "prediction": F.col("prediction").cast("int")})
            .drop(*drop)
        )

    return score


def _fitted(name: str, model: PipelineModel, features: Sequence[str]) -> Fitted:
    return Fitted(name, _probability(model), {name: model}, {f"{name}_features": ",".join(features)})


def fit_logistic(train: DataFrame, features: Sequence[str], settings: config.ClassifierSettings = config.CLASSIFIER) -> Fitted:
    """Ridge logistic regression on scaled features; the penalty is that of C over summed losses."""
    data = _weighted(train, settings)
    total = data.agg(F.sum("weight")).first()[0]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        *_scaled(data, len(features), "features"),
        LogisticRegression(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=settings.logistic_iter,
            regParam=1.0 / (settings.logistic_c * total), elasticNetParam=0.0, standardization=False,
        ),
    ]).fit(data)
    return _fitted("logistic_regression", model, features)


def fit_forest(train: DataFrame, features: Sequence[str], settings: config.ClassifierSettings = config.CLASSIFIER) -> Fitted:
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", numTrees=settings.forest_trees,
            maxDepth=settings.forest_depth, minInstancesPerNode=settings.forest_leaf, featureSubsetStrategy="sqrt",
            seed=settings.seed, maxBins=settings.max_bins,
        ),
    ]).fit(_weighted(train, settings))
    return _fitted("random_forest", model, features)


def fit_boosting(train: DataFrame, features: Sequence[str], settings: config.ClassifierSettings = config.CLASSIFIER) -> Fitted:
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=settings.boost_rounds,
            maxDepth=settings.boost_depth, stepSize=settings.boost_rate, minInstancesPerNode=settings.boost_leaf,
            seed=settings.seed, maxBins=settings.max_bins,
        ),
    ]).fit(_weighted(train, settings))
    return _fitted("gradient_boosting", model, features)


def _fourier(df: DataFrame, size: int, inputs: int, seed: int, source: str, out: str) -> DataFrame:
    """Random Fourier features of the Gaussian kernel with gamma = 1 / inputs (Rahimi and Recht 2007).

    One matrix product per Arrow batch; the matrix is a fixed function of the seed.
    """
    rng = np.random.default_rng(seed)
    directions = rng.normal(scale=np.sqrt(2.0 / inputs), size=(inputs, size))
    shifts = rng.uniform(0.0, 2 * np.pi, size)

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            if len(rows) == 0:
                yield pd.Series([], dtype=object)
                continue
            waves = np.cos(np.stack(rows.to_numpy()) @ directions + shifts) * np.sqrt(2.0 / size)
            yield pd.Series(list(waves))

    return df.withColumn(out, array_to_vector(project(vector_to_array(source))))


def fit_svm(
    train: DataFrame, features: Sequence[str], settings: config.ClassifierSettings = config.CLASSIFIER,
    max_rows: int | None = None, id_col: str = "id",
) -> Fitted:
    """Linear SVM on random Fourier features, in place of a kernel machine that grows with the square of the rows.

    The probability is a logistic fit on the margin. No row limit is needed;
    ``max_rows`` offers the stratified one of the older variant.
    """
    data = train if max_rows is None else sampling.stratified_sample(train, max_rows, "label", id_col)
    data = _weighted(data, settings)
    scale = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        *_scaled(data, len(features), "scaled"),
    ]).fit(data)

    shape = {"svm_waves": settings.svm_features, "svm_seed": settings.seed}
    waves = cut(_svm_waves(data, scale, len(features), **shape).select("label", "weight", "waves"))
    total = waves.agg(F.sum("weight")).first()[0]
    margin = PipelineModel([LinearSVC(
        featuresCol="waves", labelCol="label", weightCol="weight", regParam=1.0 / (settings.svm_c * total),
        rawPredictionCol="margins", predictionCol="svm_side", standardization=False, maxIter=100,
    ).fit(waves)])
    platt = Pipeline(stages=[
        VectorAssembler(inputCols=["margin"], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=100),
    ]).fit(_svm_margins(waves, margin))
    stages = {"svm_scale": scale, "svm_margin": margin, "svm_probability": platt}
    return Fitted("svm", _svm_scorer(stages, len(features), **shape), stages, {"svm_features": ",".join(features), **shape})


def _svm_waves(df: DataFrame, scale: PipelineModel, inputs: int, svm_waves: int, svm_seed: int) -> DataFrame:
    """The projection follows from the number of inputs and waves and the seed."""
    return _fourier(scale.transform(df), svm_waves, inputs, svm_seed, "scaled", "waves")


def _svm_margins(df: DataFrame, margin: PipelineModel) -> DataFrame:
    return margin.transform(df).withColumn("margin", vector_to_array("margins")[1])


def _svm_scorer(stages: dict[str, PipelineModel], inputs: int, svm_waves: int, svm_seed: int) -> Scorer:
    probability = _probability(stages["svm_probability"])

    def score(df: DataFrame) -> DataFrame:
        out = probability(_svm_margins(_svm_waves(df, stages["svm_scale"], inputs, svm_waves, svm_seed), stages["svm_margin"]))
        return out.withColumn("prediction", F.col("svm_side").cast("int")).drop("scaled", "waves", "margins", "margin", "svm_side")

    return score


def restored(name: str, stages: dict[str, PipelineModel], facts: dict[str, str]) -> Fitted:
    """A classifier from its stored stages and facts; scores as before it was stored."""
    if name != "svm":
        return Fitted(name, _probability(stages[name]), stages, facts)
    inputs = len(facts["svm_features"].split(","))
    return Fitted(name, _svm_scorer(stages, inputs, int(facts["svm_waves"]), int(facts["svm_seed"])), stages, facts)


FITTERS: dict[str, Callable[..., Fitted]] = {
    "logistic_regression": fit_logistic,
    "random_forest": fit_forest,
    "gradient_boosting": fit_boosting,
    "svm": fit_svm,
}


@dataclass
class ClassifierRun:
    metrics: DataFrame
    report: DataFrame
    fitted: dict[str, Fitted]
    balance: DataFrame
    test: DataFrame


def evaluate(scored: DataFrame) -> DataFrame:
    """One row: accuracy, f1, precision, recall, roc_auc."""
    auc = metrics.roc_auc(scored).scalar()
    return metrics.confusion_metrics(scored).withColumn("roc_auc", auc)


def cross_validated_auc(
    train: DataFrame, fitter: Callable[..., Fitted], settings: config.ClassifierSettings,
    features: Sequence[str], make_features: Callable[[DataFrame, DataFrame], DataFrame], fold_safe: bool = True,
) -> DataFrame:
    """(fold, roc_auc). With ``fold_safe`` the rates are made anew from each fold's own training rows."""
    folded = cut(sampling.stratified_folds(train, settings.target, folds=settings.cv_folds, seed=settings.seed))
    whole = None if fold_safe else cut(make_features(folded, folded))
    out = None
    for fold in range(settings.cv_folds):
        rows = whole if whole is not None else cut(make_features(folded, folded.filter(F.col("fold") != fold)))
        fitted = fitter(rows.filter(F.col("fold") != fold), features, settings)
        held_out = cut(fitted.score(rows.filter(F.col("fold") == fold)).select("label", "score"))
        part = metrics.roc_auc(held_out).select(F.lit(fold).alias("fold"), "roc_auc")
        out = part if out is None else out.unionByName(part)
    return cut(out)


def fit_classifiers(
    df: DataFrame,
    settings: config.ClassifierSettings = config.CLASSIFIER,
    models: Sequence[str] = ("logistic_regression", "random_forest", "gradient_boosting"),
    street_col: str | None = "street_name",
    lsoa_col: str | None = None,
    cross_validate: bool = True,
    fold_safe: bool = True,
    variant: str = "current",
) -> ClassifierRun:
    """Split, rates from training rows only, fit, score on held-out rows, cross-validate.

    ``variant`` picks the feature list: 'current', 'raw_prior' (unsmoothed
    rates) or 'basic' (no rates).
    """
    split = cut(sampling.stratified_split(df, settings.target, test_share=settings.test_share, seed=settings.seed))
    train = split.filter("is_test = 0")

    def make(rows: DataFrame, source: DataFrame, keep: Sequence[str]) -> DataFrame:
        if variant == "basic":
            return priors.build_features_basic(rows, settings.target, keep)
        if variant == "raw_prior":
            return priors.build_features_raw_prior(rows, source, settings.target, lsoa_col, keep)
        return priors.build_features(rows, source, settings, street_col, lsoa_col, keep)

    names = {
        "current": priors.feature_names(street_col is not None, lsoa_col is not None),
        "raw_prior": priors.raw_prior_features(lsoa_col is not None),
        "basic": priors.BASIC_FEATURES,
    }[variant]
    rows = cut(make(split, train, ["id", "is_test"]))
    fit_rows, test_rows = rows.filter("is_test = 0"), rows.filter("is_test = 1")
    table, report, fitted = None, None, {}
    for name in models:
        done = FITTERS[name](fit_rows, names, settings)
        fitted[name] = done
        scored = cut(done.score(test_rows).select("id", "label", "prediction", "score"))
        row = evaluate(scored).select(F.lit(name).alias("model"), "*")
        if cross_validate:
            folds = cross_validated_auc(
                train, FITTERS[name], settings, names, lambda a, b: make(a, b, ["id", "fold"]), fold_safe
            ).withColumn("model", F.lit(name))
            row = row.join(F.broadcast(metrics.cv_auc_stats(folds)), "model")
        part = metrics.class_report(scored).select(F.lit(name).alias("model"), "*")
        table = row if table is None else table.unionByName(row)
        report = part if report is None else report.unionByName(part)
    return ClassifierRun(cut(table), cut(report), fitted, sampling.class_balance(split, label=settings.target), test_rows)

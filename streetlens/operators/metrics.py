"""Scores of forecasts, classifiers and clusterings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetlens.functions.numbers import ratio
from streetlens.session import cut


# ---- forecasts ---------------------------------------------------------------
def forecast_errors(df: DataFrame, keys: Sequence[str] = (), actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """rmse and mae per key."""
    gap = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))


def mae_pct_of_mean(df: DataFrame, keys: Sequence[str] = (), actual: str = "y", predicted: str = "yhat") -> DataFrame:
    """mae as a percentage of the mean actual value; NaN if that mean is not positive."""
    agg = df.groupBy(*keys).agg(
        F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"), F.avg(actual).alias("mean_y")
    )
    return agg.withColumn(
        "mae_pct_of_mean",
        F.when(F.col("mean_y") > 0, F.col("mae") / F.col("mean_y") * 100.0).otherwise(F.lit(float("nan"))),
    ).drop("mean_y")


def cv_summary(cv: DataFrame, digits: int = 2) -> DataFrame:
    """Mean rmse and mae per model."""
    return cv.groupBy("model").agg(
        F.round(F.avg("rmse"), digits).alias("rmse_mean"), F.round(F.avg("mae"), digits).alias("mae_mean")
    )


def forecast_vs_actual(forecast: DataFrame, actual: DataFrame, keys: Sequence[str] = ("series", "fold", "month_date")) -> DataFrame:
    """Forecast steps beside the values they were meant to hit."""
    return forecast.join(actual, list(keys), "inner")


def rf_total(forecast: DataFrame, categories: Sequence[str] | None = None, digits: int | None = 1) -> DataFrame:
    """Forecast summed over categories per month; an empty category list means all."""
    rows = forecast.filter(F.col("category").isin(*categories)) if categories else forecast
    total = F.sum("rf_forecast")
    return rows.groupBy("month_date").agg((F.round(total, digits) if digits is not None else total).alias("rf_forecast"))


def best_by_score(df: DataFrame, value: str, score: str, order: str, largest: bool, keys: Sequence[str] = ()) -> DataFrame:
    """The row with the best score per key; the first in ``order`` wins a tie. Missing scores never win."""
    rank = F.struct((-F.col(score) if largest else F.col(score)), F.col(order))
    usable = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return usable.groupBy(*keys).agg(
        F.min_by(value, rank).alias(value), F.min_by(score, rank).alias(score)
    )


# ---- classifiers -------------------------------------------------------------
def confusion_metrics(df: DataFrame, keys: Sequence[str] = (), label: str = "label", predicted: str = "prediction") -> DataFrame:
    """accuracy, f1, precision, recall of the positive class; 0 where undefined."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    cells = df.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        *keys,
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )


def roc_auc(df: DataFrame, keys: Sequence[str] = (), label: str = "label", score: str = "score", slices: int = 256) -> DataFrame:
    """Area under the ROC curve with ties counted half.

    Rows collapse to one per distinct score. The running count of positives
    is taken inside ``slices`` score ranges of about equal size, cut at
    quantiles of the distinct scores, plus an offset per range, so the window
    never runs over all scores in one task. Any cut points give the same area.
    """
    keys = list(keys)
    # read three times below, so made once
    per_score = cut(df.groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ))
    marks = [i / slices for i in range(1, slices)]
    cut_points = per_score.agg(F.percentile_approx(score, marks, 1000).alias("cuts")).scalar()
    sliced = per_score.withColumn("cuts", cut_points).withColumn(
        "slice", F.size(F.filter("cuts", lambda c: c < F.col(score)))
    ).drop("cuts")
    # at most `slices` rows per key
    by_slice = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "slice").agg(F.sum("pos").alias("slice_pos"))
        .select(*keys, "slice", F.coalesce(F.sum("slice_pos").over(by_slice), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy(*keys, "slice").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = sliced.withColumn("pos_below_here", F.coalesce(F.sum("pos").over(inside), F.lit(0)))
    joined = below.join(offsets, [*keys, "slice"])
    # pairs (positive below, negative) lose, ties count half
    neg = F.col("neg").cast("double")
    lost = neg * (F.col("before") + F.col("pos_below_here")) + neg * F.col("pos") / F.lit(2.0)
    sums = joined.groupBy(*keys).agg(
        F.sum(lost).alias("lost"), F.sum("pos").alias("p"), F.sum("neg").alias("q")
    )
    pairs = F.col("p").cast("double") * F.col("q")
    return sums.select(*keys, F.try_divide(pairs - F.col("lost"), pairs).alias("roc_auc"))


def class_report(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """(row, precision, recall, f1, support): one row per class, then accuracy, macro and weighted averages."""
    cells = df.groupBy(
        F.col(label).cast("int").alias("y"), F.col(predicted).cast("int").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    # one row per class from here on
    hits = cells.select(
        F.explode(F.array(
            F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                     F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                     F.lit(0).cast("bigint").alias("hit")),
        )).alias("r")
    ).groupBy("r.c").agg(
        F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"), F.sum("r.hit").alias("hit")
    )
    rows = hits.select(
        F.col("c").cast("string").alias("row"),
        ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(F.col("hit") * 2, F.col("predicted") + F.col("support")).alias("f1"),
        "support", "hit",
    )
    total = F.sum("support")
    weighted = lambda c: ratio(F.sum(F.col(c) * F.col("support")), total)
    accuracy = ratio(F.sum("hit"), total)
    summary = rows.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("row"), accuracy.alias("precision"), accuracy.alias("recall"),
                     accuracy.alias("f1"), total.alias("support")),
            F.struct(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("row"), weighted("precision").alias("precision"),
                     weighted("recall").alias("recall"), weighted("f1").alias("f1"), total.alias("support")),
        ).alias("s")
    ).select(F.inline("s"))
    return rows.drop("hit").unionByName(summary)


def cv_auc_stats(folds: DataFrame, keys: Sequence[str] = ("model",), value: str = "roc_auc") -> DataFrame:
    """Mean and population deviation over folds."""
    return folds.groupBy(*keys).agg(
        F.avg(value).alias("cv_roc_auc_mean"), F.stddev_pop(value).alias("cv_roc_auc_std")
    )


# ---- clusterings -------------------------------------------------------------
def cluster_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of clusters and of noise points (label -1)."""
    return df.agg(
        F.count_distinct(F.when(F.col(label) != -1, F.col(label))).alias("clusters"),
        F.count_if(F.col(label) == -1).alias("noise"),
    )

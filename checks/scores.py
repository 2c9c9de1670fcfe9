"""Checks of classifier and clustering scores on labels that follow from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import WITH_FEATURES, check, features, on
from streetlens.functions.numbers import hash_rank
from streetlens.operators import metrics

# a made-up classifier: score from the scattered id, lifted for robbery
SCORED = """scored AS (SELECT id, is_violent AS label, grid_lat, quarter,
  round(((((id % 1000003) * 7919 + 42) % 1000003) % 1000) / 1250.0::DOUBLE + CASE WHEN category = 'robbery' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END, 6)
  AS score FROM ft),
judged AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS prediction FROM scored)"""


def r(c, digits=6):
    return F.round(c, digits)


def _judged(spark, folder):
    lift = F.when(F.col("category") == "robbery", F.lit(0.2)).otherwise(F.lit(0.0))
    score = r((hash_rank(F.col("id")) % 1000) / F.lit(1250.0) + lift)
    return features(spark, folder).select(
        "id", F.col("is_violent").alias("label"), "quarter", score.alias("score")
    ).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


CELLS = """(SELECT sum(label * prediction) AS tp, sum((1 - label) * prediction) AS fp, sum(label * (1 - prediction)) AS fn,
  sum((1 - label) * (1 - prediction)) AS tn FROM judged)"""


@check("confusion_metrics", on(WITH_FEATURES, f"""SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
  round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM {CELLS}""", SCORED))
def confusion_metrics(spark, folder):
    out = metrics.confusion_metrics(_judged(spark, folder))
    return out.select(*[r(c).alias(c) for c in out.columns])


AUC = """(sum(CASE WHEN label = 1 THEN rk END) - count(CASE WHEN label = 1 THEN 1 END) * (count(CASE WHEN label = 1 THEN 1 END) + 1) / 2.0)
  / (count(CASE WHEN label = 1 THEN 1 END) * count(CASE WHEN label = 0 THEN 1 END))"""
RANKED = """ranked AS (SELECT label, quarter, rank() OVER (PARTITION BY quarter ORDER BY score) + (count(*) OVER (PARTITION BY quarter, score) - 1) / 2.0 AS rk
  FROM judged),
aucs AS (SELECT quarter, """ + AUC + """ AS roc_auc FROM ranked GROUP BY 1)"""


@check("roc_auc", on(WITH_FEATURES, "SELECT quarter, round(roc_auc, 6) AS roc_auc FROM aucs", SCORED, RANKED))
def roc_auc(spark, folder):
    """One area per quarter of the year."""
    return metrics.roc_auc(_judged(spark, folder), ["quarter"]).withColumn("roc_auc", r("roc_auc"))


@check("cv_auc_stats", on(WITH_FEATURES, """SELECT 'scattered' AS model, round(avg(roc_auc), 6) AS cv_roc_auc_mean, round(stddev_pop(roc_auc), 6) AS cv_roc_auc_std
  FROM aucs""", SCORED, RANKED))
def cv_auc_stats(spark, folder):
    per_fold = metrics.roc_auc(_judged(spark, folder), ["quarter"]).withColumn("model", F.lit("scattered"))
    out = metrics.cv_auc_stats(per_fold)
    return out.withColumns({c: r(c) for c in ("cv_roc_auc_mean", "cv_roc_auc_std")})


@check("class_report", on(WITH_FEATURES, """SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
  SELECT CAST(c AS VARCHAR) AS row, precision, recall, 2 * hit / (predicted + support) AS f1, support FROM per
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(2 * hit / (predicted + support)), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(2 * hit / (predicted + support) * support) / sum(support), sum(support) FROM per)""", SCORED, """per AS (SELECT c, hit, support, predicted, hit / predicted AS precision, hit / support AS recall FROM (
  SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS hit, count(*) FILTER (WHERE label = c) AS support,
    count(*) FILTER (WHERE prediction = c) AS predicted FROM judged, (VALUES (0), (1)) v(c) GROUP BY c))"""))
def class_report(spark, folder):
    out = metrics.class_report(_judged(spark, folder))
    return out.withColumns({c: r(c) for c in ("precision", "recall", "f1")})


@check("best_by_score", on(WITH_FEATURES, """SELECT season, quarter, score FROM (SELECT season, quarter, count(*) AS score,
    row_number() OVER (PARTITION BY season ORDER BY count(*) DESC, quarter) AS rk FROM ft GROUP BY 1, 2) WHERE rk = 1"""))
def best_by_score(spark, folder):
    """Per season the quarter of the year with most incidents; the first wins a tie."""
    counts = features(spark, folder).groupBy("season", "quarter").agg(F.count(F.lit(1)).alias("score"))
    return metrics.best_by_score(counts, "quarter", "score", "quarter", True, ["season"])


LABELLED = """labelled AS (SELECT id, CASE WHEN grid_lat < 10 THEN -1 ELSE grid_lat % 3 END AS label FROM ft)"""


@check("cluster_counts", on(WITH_FEATURES, """SELECT count(DISTINCT CASE WHEN label <> -1 THEN label END) AS clusters, count(*) FILTER (WHERE label = -1) AS noise
  FROM labelled""", LABELLED))
def cluster_counts(spark, folder):
    return metrics.cluster_counts(_labelled(spark, folder))


def _labelled(spark, folder):
    return features(spark, folder).select(
        "id", F.when(F.col("grid_lat") < 10, -1).otherwise(F.col("grid_lat") % 3).alias("label"))


@check("drop_noise", on(WITH_FEATURES, "SELECT id, label FROM labelled WHERE label <> -1", LABELLED))
def drop_noise(spark, folder):
    from streetlens.operators.dbscan import drop_noise as drop

    return drop(_labelled(spark, folder))

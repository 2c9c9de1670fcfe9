"""Class-preserving splits, folds and samples without a full sort.

Rows are placed in a fixed order within each class by (scattered id, id). A cut
after the first n rows of that order is then a pair of numbers per class: it is
found from counts per scattered value, plus a ranking of the few rows that
share the one value where the cut falls. The rows themselves are never sorted
or shuffled; they are only compared with the cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens import config
from streetlens.functions.numbers import hash_rank
from streetlens.session import cut


def _cut_points(df: DataFrame, label: str | None, id_col: str, seed: int, wanted: Column) -> DataFrame:
    """(label, cut, h, id): the last row inside each cut.

    ``wanted`` is an array of cut sizes as a function of ``n``, the class size.
    A cut of size 0 gets no row.
    """
    group = F.lit(0) if label is None else F.col(label)
    keyed = df.select(group.alias("_label"), F.col(id_col).alias("_id")).withColumn("_h", hash_rank(F.col("_id"), seed))
    per_value = keyed.groupBy("_label", "_h").agg(F.count(F.lit(1)).alias("_c"))
    # at most 1,000,003 rows per class, whatever the size of the data
    order = Window.partitionBy("_label").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_label")
    running = per_value.withColumns({"_upto": F.sum("_c").over(order), "n": F.sum("_c").over(whole)})
    hits = (
        running.select("_label", "_h", "_c", "_upto", F.posexplode(wanted).alias("_cut", "_want"))
        .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_c") < F.col("_want")))
        .withColumn("_nth", F.col("_want") - (F.col("_upto") - F.col("_c")))
        .select("_label", "_h", "_cut", "_nth")
    )
    # one row per class and cut, so the rows below stay where they are
    hits = F.broadcast(cut(hits))
    # rows of the scattered values where a cut falls; a few per class
    rank = F.row_number().over(Window.partitionBy("_label", "_h").orderBy("_id"))
    edge = (
        keyed.join(hits.select("_label", "_h").distinct().hint("broadcast"), ["_label", "_h"], "left_semi")
        .withColumn("_r", rank)
        .join(hits, ["_label", "_h"])
        .filter(F.col("_r") == F.col("_nth"))
    )
    return edge.select("_label", "_cut", F.struct("_h", "_id").alias("_at"))


def rank_segment(
    df: DataFrame,
    label: str | None,
    id_col: str,
    wanted: Column,
    cuts: int,
    seed: int = config.CLASSIFIER.seed,
    out: str = "segment",
) -> DataFrame:
    """Number of cuts that lie before each row: 0 for rows inside the first cut. Without a label all rows are one class."""
    points = _cut_points(df, label, id_col, seed, wanted)
    # one row per class, so small enough to broadcast
    edges = points.groupBy("_label").agg(F.map_from_entries(F.collect_list(F.struct("_cut", "_at"))).alias("_cuts"))
    here = F.struct(hash_rank(F.col(id_col), seed).alias("_h"), F.col(id_col).alias("_id"))
    beyond = [
        F.coalesce(here > F.try_element_at(F.col("_cuts"), F.lit(i)), F.lit(True)).cast("int") for i in range(cuts)
    ]
    if label is None:
        placed = df.withColumn("_cuts", edges.select("_cuts").scalar())
    else:
        placed = df.join(F.broadcast(edges), df[label].eqNullSafe(edges["_label"]), "left")
    return (
        placed.withColumn(out, reduce(lambda a, b: a + b, beyond))
        .drop("_label", "_cuts")
    )


def stratified_split(
    df: DataFrame,
    label: str = config.CLASSIFIER.target,
    id_col: str = "id",
    test_share: float = config.CLASSIFIER.test_share,
    seed: int = config.CLASSIFIER.seed,
) -> DataFrame:
    """Add ``is_test``: round(test_share * n) rows of every class."""
    wanted = F.array(F.round(F.col("n") * F.lit(test_share)).cast("bigint"))
    return (
        rank_segment(df, label, id_col, wanted, 1, seed, "_segment")
        .withColumn("is_test", (F.col("_segment") == 0).cast("int"))
        .drop("_segment")
    )


def stratified_folds(
    df: DataFrame,
    label: str = config.CLASSIFIER.target,
    id_col: str = "id",
    folds: int = config.CLASSIFIER.cv_folds,
    seed: int = config.CLASSIFIER.seed,
) -> DataFrame:
    """Add ``fold`` 0 .. folds-1; every class is cut into runs of equal length (+1 for the first ones)."""
    n = F.col("n")
    size = F.floor(n / F.lit(folds)).cast("bigint")
    extra = n % folds
    wanted = F.array(*[size * i + F.least(extra, F.lit(i).cast("bigint")) for i in range(1, folds)])
    return rank_segment(df, label, id_col, wanted, folds - 1, seed, "fold")


def stratified_sample(
    df: DataFrame,
    n: int,
    label: str = config.CLASSIFIER.target,
    id_col: str = "id",
    seed: int = config.CLASSIFIER.seed,
) -> DataFrame:
    """At most ``n`` rows with the class shares of a 0/1 label kept."""
    total = df.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("ones")).alias("t"))
    t = total.scalar()
    # ties to even, as in the usual rounding of shares
    ones = F.rint(F.lit(float(n)) * F.try_divide(t["ones"].cast("double"), t["rows"].cast("double"))).cast("bigint")
    share = F.when(F.col("_label") == 1, ones).otherwise(F.lit(n) - ones)
    wanted = F.array(F.when(t["rows"] <= n, F.col("n")).otherwise(F.least(share, F.col("n"))))
    return rank_segment(df, label, id_col, wanted, 1, seed, "_segment").filter(F.col("_segment") == 0).drop("_segment")


def sample_n(df: DataFrame, n: int = 8000, id_col: str = "id", seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows if there are more, chosen by scattered id."""
    wanted = F.array(F.least(F.lit(n).cast("bigint"), F.col("n")))
    return rank_segment(df, None, id_col, wanted, 1, seed, "_segment").filter(F.col("_segment") == 0).drop("_segment")


def class_balance(df: DataFrame, split: str = "is_test", label: str = config.CLASSIFIER.target) -> DataFrame:
    """Rows and share of positives (in per cent) per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), (F.avg(label) * 100.0).alias("positive_pct")
    )


def class_weights(df: DataFrame, label: str = config.CLASSIFIER.target) -> DataFrame:
    """'Balanced' weight n / (classes * n_c) per class."""
    counts = cut(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("t")).scalar()
    return counts.select(
        label, "n", (total["rows"] / (total["classes"] * F.col("n"))).alias("weight")
    )


def with_class_weight(df: DataFrame, label: str = config.CLASSIFIER.target, out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    # one row per class
    return df.join(F.broadcast(weights), label, "left")

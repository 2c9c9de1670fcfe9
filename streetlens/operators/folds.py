"""Walk-forward folds over many series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens import config


def dealt(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole series over all shuffle partitions, few as their bytes may be: fits cost far more than rows."""
    return series.repartition(int(series.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def number_rows(series: DataFrame, keys: Sequence[str], time: str = "month_date") -> DataFrame:
    """Add idx (0-based position in time) and n (length of the series)."""
    w = Window.partitionBy(*keys).orderBy(time)
    whole = Window.partitionBy(*keys)
    return series.withColumns({"idx": F.row_number().over(w) - 1, "n": F.count(F.lit(1)).over(whole).cast("int")})


def _fold_count(n: Column, s: config.ForecastSettings) -> Column:
    room = n - s.horizon - s.cv_initial
    return F.when(room >= 0, F.floor(room / s.cv_step).cast("int") + 1).otherwise(0)


def fold_cutoffs(series: DataFrame, keys: Sequence[str], settings: config.ForecastSettings = config.FORECAST) -> DataFrame:
    """(keys, fold from 1, cutoff = training length, cutoff_month = last training month)."""
    s = settings
    rows = number_rows(series, keys)
    fold = (F.col("idx") + 1 - s.cv_initial) / s.cv_step + 1
    # a row ends a training window if its position is on the fold ladder
    last = (F.col("idx") + 1 >= s.cv_initial) & ((F.col("idx") + 1 - s.cv_initial) % s.cv_step == 0)
    return rows.filter(last & (fold <= _fold_count(F.col("n"), s))).select(
        *keys, fold.cast("int").alias("fold"), (F.col("idx") + 1).alias("cutoff"), F.col("month_date").alias("cutoff_month")
    )


def fold_ends(settings: config.ForecastSettings = config.FORECAST, folds: bool = True) -> Column:
    """The folds (array of int) whose training window ends with a numbered row; fold 0 is the whole series."""
    s = settings
    own = F.when(F.col("idx") + 1 == F.col("n"), F.array(F.lit(0))).otherwise(F.expr("cast(array() as array<int>)"))
    if not folds:
        return own
    fold = F.floor((F.col("idx") + 1 - s.cv_initial) / s.cv_step).cast("int") + 1
    on = (F.col("idx") + 1 >= s.cv_initial) & ((F.col("idx") + 1 - s.cv_initial) % s.cv_step == 0) & (fold <= _fold_count(F.col("n"), s))
    return F.concat(own, F.when(on, F.array(fold)).otherwise(F.expr("cast(array() as array<int>)")))


def fold_tests(series: DataFrame, keys: Sequence[str], settings: config.ForecastSettings = config.FORECAST) -> DataFrame:
    """The rows that a fold is tested on, once per such fold: at most ``horizon`` of each, with fold, cutoff and step (from 1)."""
    s = settings
    rows = number_rows(series, keys)
    idx = F.col("idx")
    first = F.greatest(F.lit(1), F.ceil((idx + 1 - s.horizon - s.cv_initial) / s.cv_step).cast("int") + 1)
    last = F.least(_fold_count(F.col("n"), s), F.floor((idx - s.cv_initial) / s.cv_step).cast("int") + 1)
    seen = F.when((first <= last) & (idx >= s.cv_initial), F.sequence(first, last)).otherwise(F.expr("cast(array() as array<int>)"))
    return rows.withColumn("fold", F.explode(seen)).withColumn("cutoff", s.cv_initial + s.cv_step * (F.col("fold") - 1)).withColumn(
        "step", idx - F.col("cutoff") + 1
    )


def fold_expand(
    series: DataFrame,
    keys: Sequence[str],
    settings: config.ForecastSettings = config.FORECAST,
    final: bool = False,
) -> DataFrame:
    """Copy each row into the folds that see it, for training or for testing.

    The folds of a row follow from its position, so nothing is joined: rows
    before a cutoff train, the ``horizon`` rows from the cutoff on test. With
    ``final`` there is also fold 0, which trains on the whole series.
    """
    s = settings
    rows = number_rows(series, keys)
    idx, count = F.col("idx"), _fold_count(F.col("n"), s)
    # first fold with idx < cutoff + horizon
    first = F.greatest(F.lit(1), F.ceil((idx + 1 - s.horizon - s.cv_initial) / s.cv_step).cast("int") + 1)
    seen = F.when(first <= count, F.sequence(first, count)).otherwise(F.expr("cast(array() as array<int>)"))
    if final:
        seen = F.concat(F.array(F.lit(0)), seen)
    out = rows.withColumn("fold", F.explode(seen)).withColumn(
        "cutoff", F.when(F.col("fold") == 0, F.col("n")).otherwise(s.cv_initial + s.cv_step * (F.col("fold") - 1))
    )
    return out.withColumn("is_test", (F.col("idx") >= F.col("cutoff")).cast("int"))

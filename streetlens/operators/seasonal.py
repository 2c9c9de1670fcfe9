"""Trend with few bends plus one yearly wave, fitted per series and fold by least squares with an absolute penalty on bends."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlens import config
from streetlens.operators.folds import dealt, fold_ends, number_rows
from streetlens.operators.least_squares import dot, running_products, square

_WAVE_RIDGE = 0.01
_STEPS = 20  # of fit and noise, each from the other


def _waves(settings: config.ForecastSettings) -> list[Column]:
    """Yearly sine and cosine pairs of month_date."""
    if not settings.yearly_seasonality:
        return []
    day = F.datediff("month_date", F.lit("1970-01-01").cast("date"))
    angles = [day * F.lit(2 * pi * order / settings.yearly_period_days) for order in range(1, settings.fourier_order + 1)]
    return [wave(angle) for angle in angles for wave in (F.sin, F.cos)]


def design(settings: config.ForecastSettings) -> list[Column]:
    """Constant, trend, bends in the first four fifths of the training window, yearly sine and cosine pairs.

    Uses the columns idx, cutoff and month_date.
    """
    s = settings
    t = F.col("idx") / F.greatest(F.col("cutoff") - 1, F.lit(1))
    bends = [F.greatest(t - F.lit(0.8 * j / s.changepoints), F.lit(0.0)) for j in range(1, s.changepoints + 1)]
    return [F.lit(1.0), t, *bends, *_waves(s)]


def _products(segments: list[list[float]], cutoff: int, bends: int, waves: int) -> np.ndarray:
    """Cross products of the design and y from those of (1, idx, waves, y) between the bends.

    Between two bends every column of the design is linear in these.
    """
    scale = max(cutoff - 1, 1)
    total = np.zeros((2 + bends + waves + 1,) * 2)
    for k, triangle in enumerate(segments):
        to = np.zeros((len(total), waves + 3))
        to[0, 0] = 1
        to[1, 1] = 1 / scale
        for j in range(1, k + 1):  # bends that lie before this segment
            to[1 + j, :2] = -0.8 * j / bends, 1 / scale
        to[2 + bends :, 2:] = np.eye(waves + 1)
        total += to @ square(triangle) @ to.T
    return total


def sparse_bends(matrix: np.ndarray, bends: int, prior: float) -> tuple[np.ndarray, float, float] | None:
    """(coefficients, residual sum of squares, used columns) from the cross products of the design and y; None if singular.

    Constant, trend and waves are eliminated; coordinate descent settles the
    bends under an absolute penalty. It has two parts, both relative to the
    noise of the fit before: a Laplace prior with scale ``prior`` (relative to
    the size of y), and one that falls with the bend's own size, so that bends
    which do not stand out become exactly 0 and the others are hardly shrunk.
    The first fit is without a penalty, or without bends if there are few rows.
    """
    gram, side, yy, n = matrix[:-1, :-1], matrix[:-1, -1], float(matrix[-1, -1]), float(matrix[0, 0])
    smooth = [0, 1, *range(2 + bends, len(gram))]
    bent = list(range(2, 2 + bends))
    block = gram[np.ix_(smooth, smooth)] + np.diag([1e-8, 1e-6, *[_WAVE_RIDGE] * (len(smooth) - 2)])
    if n < 1 or not np.isfinite(matrix).all() or np.linalg.cond(block) > 1e13:
        return None
    inverse = np.linalg.inv(block)
    across = gram[np.ix_(bent, smooth)] @ inverse
    own, wanted = gram[np.ix_(bent, bent)] - across @ gram[np.ix_(smooth, bent)], side[bent] - across @ side[smooth]
    size = max(float(np.sqrt(yy / n)), 1e-300)
    own_size = own.diagonal().copy()
    own_size[own_size <= 1e-9 * gram.diagonal()[bent]] = 0.0  # bends that the smooth part already has
    loose = own + np.diag(1e-9 * np.maximum(own_size, own_size.max(initial=0.0) * 1e-3 + 1e-300))
    # without a penalty few rows would be met exactly and leave no noise, so there the first fit has no bends
    delta = np.where(own_size > 0, np.linalg.solve(loose, wanted), 0.0) if bends and n > 2 * len(gram) else np.zeros(bends)
    doubt = np.sqrt(np.maximum(np.linalg.inv(loose).diagonal(), 0.0)) if bends else delta
    beta, rss, last = np.zeros(len(gram)), 0.0, None
    for _ in range(_STEPS):
        beta[smooth], beta[bent] = inverse @ (side[smooth] - gram[np.ix_(smooth, bent)] @ delta), delta
        rss = max(float(yy - 2 * beta @ side + beta @ gram @ beta), 0.0)
        if last is not None and abs(rss - last) <= 1e-9 * max(last, 1e-12):
            break
        last = rss
        noise = rss / max(n - len(smooth) - np.count_nonzero(delta), 1.0)
        hold = noise * (1.0 / (prior * size) + np.log(max(n, 2.0)) / (np.abs(delta) + 0.1 * np.sqrt(noise) * doubt + 1e-300))
        for _ in range(1000):
            before = delta.copy()
            for j in np.flatnonzero(own_size):
                pull = wanted[j] - own[j] @ delta + own[j, j] * delta[j]
                delta[j] = np.sign(pull) * max(abs(pull) - hold[j], 0.0) / own[j, j]
            if np.abs(delta - before).max(initial=0.0) <= 1e-10 * (size + np.abs(delta).max(initial=0.0)):
                break
    return beta, rss, float(len(smooth) + np.count_nonzero(delta))


def seasonal_coefficients(
    series: DataFrame, keys: Sequence[str], settings: config.ForecastSettings = config.FORECAST, folds: bool = False
) -> DataFrame:
    """(keys, fold, cutoff, last = last training month, beta, sigma, drift) per series and fold; beta is null if it cannot be solved.

    sigma is the deviation of the residuals; drift the variance, per month and
    month, that bends to come as often and as large as the past ones add.

    No row is copied into a fold: running sums over each series give the cross
    products of every training window. ``series`` has no null y.
    """
    s, keys = settings, list(keys)
    rows = number_rows(dealt(series, keys), keys).withColumn("cutoff", F.col("idx") + 1)
    bends = [F.floor(F.lit(0.8 * j / s.changepoints) * F.greatest(F.col("cutoff") - 1, F.lit(1))) + 1 for j in range(1, s.changepoints + 1)]
    at = F.array(F.lit(0).cast("long"), *[b.cast("long") for b in bends], F.col("cutoff").cast("long"))
    waves = _waves(s)
    base = [F.lit(1.0), F.col("idx"), *waves, F.col("y")]
    sums = running_products(
        rows, keys, "idx", {"sums": (base, at)}, fold_ends(s, folds), F.col("cutoff").cast("int").alias("cutoff"), F.col("month_date").alias("last")
    ).select(*keys, F.explode("ended").alias("fold"), "cutoff", "last", "sums")
    width = len(waves)
    names = [*keys, "fold", "cutoff", "last"]
    schema = T.StructType([
        *[sums.schema[c] for c in names], T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType()),
        T.StructField("drift", T.DoubleType()),
    ])

    def one(cutoff: int, segments: list[list[float]]) -> tuple:
        found = sparse_bends(_products(segments, cutoff, s.changepoints, width), s.changepoints, s.changepoint_prior)
        if found is None:
            return None, None, None
        beta, rss, used = found
        reach = max(cutoff - 1, 1)
        often = s.changepoints / (0.8 * reach)
        large = np.abs(beta[2 : 2 + s.changepoints]).mean() / reach if s.changepoints else 0.0
        return beta.tolist(), float(np.sqrt(rss / max(cutoff - used, 1))), float(often * 2 * large**2)

    def solve(batches):
        for batch in batches:
            fits = [one(*row) for row in zip(batch["cutoff"], batch["sums"])]
            out = batch[names].copy()
            out["beta"] = [f[0] for f in fits]
            for i, c in ((1, "sigma"), (2, "drift")):
                out[c] = pd.Series([f[i] for f in fits], index=batch.index, dtype="float64")
            yield out

    return sums.mapInPandas(solve, schema)


def seasonal_trend_fit(
    series: DataFrame,
    keys: Sequence[str],
    settings: config.ForecastSettings = config.FORECAST,
    folds: bool = False,
) -> DataFrame:
    """(keys, fold, idx, month_date, y, is_future, yhat, yhat_lower, yhat_upper).

    The next ``horizon`` months of every fold, and the history of fold 0, which
    is the whole series; values are never negative. The band covers 80 % if
    residuals are normal; for months to come it also holds the bends to come.
    The fit of a series that cannot be solved is null.
    """
    s, keys = settings, list(keys)
    by = [*keys, "fold"]
    solved = seasonal_coefficients(series, keys, s, folds)
    step = F.explode(F.sequence(F.lit(1), F.lit(s.horizon))).alias("step")
    future = solved.select("*", step).select(
        *by, (F.col("cutoff") - 1 + F.col("step")).alias("idx"), "cutoff", F.add_months("last", F.col("step")).alias("month_date"),
        F.lit(None).cast("double").alias("y"), F.lit(1).alias("is_future"), "beta", "sigma", "drift", "step",
    )
    history = number_rows(series, keys).join(solved.filter("fold = 0"), keys).select(
        *by, "idx", "cutoff", "month_date", F.col("y").cast("double").alias("y"), F.lit(0).alias("is_future"), "beta", "sigma", "drift", F.lit(0).alias("step")
    )
    h = F.col("step")
    margin = F.sqrt(F.col("sigma") * F.col("sigma") + F.col("drift") * (h - 1) * h * (2 * h - 1) / 6.0) * F.lit(s.band_z)
    zero = F.lit(0.0)
    return history.unionByName(future).withColumn("_fit", dot("beta", design(s))).select(
        *by, "idx", "month_date", "y", "is_future",
        *(
            F.when(F.col("_fit").isNotNull(), F.greatest(value, zero)).alias(name)
            for name, value in (("yhat", F.col("_fit")), ("yhat_lower", F.col("_fit") - margin), ("yhat_upper", F.col("_fit") + margin))
        ),
    )

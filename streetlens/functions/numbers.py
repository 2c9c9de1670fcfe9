"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_non_negative(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0))


def ratio(num: Column, den: Column, otherwise: float | None = 0.0) -> Column:
    """num / den, with a stated value for a zero or missing denominator."""
    value = F.try_divide(num, den)
    return value if otherwise is None else F.coalesce(value, F.lit(otherwise))


def log_density(share: Column) -> Column:
    return F.log1p(share * F.lit(1e6))


def log_count(count: Column) -> Column:
    return F.log1p(F.coalesce(count, F.lit(0)))


def hash_rank(id_col: Column, seed: int = 42) -> Column:
    """A fixed scattering of ids over 0 .. 1,000,002, equal in every run and engine.

    The id is reduced first, so the product stays far from the integer limit.
    """
    return F.pmod(F.pmod(id_col, F.lit(1_000_003)) * F.lit(7919) + F.lit(seed), F.lit(1_000_003))


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function, by a published rational approximation; off by less than 1e-7."""
    # fixed values: the usual constants of that approximation
    t = 1.0 / (1.0 + 0.2316419 * F.abs(x))
    tail = 0.3989422804014327 * F.exp(-x * x / 2.0) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    return F.when(x >= 0, 1.0 - tail).otherwise(tail)

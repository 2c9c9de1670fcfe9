"""Month and calendar expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetlens import config


def month_to_date(month: Column) -> Column:
    """First day of a ``YYYY-MM`` month; null where it does not parse."""
    return F.try_to_date(F.concat(month, F.lit("-01")), "yyyy-M-d")


def months_before(end: Column, n: int) -> Column:
    """The ``n`` month starts that end with the month before ``end``, oldest first."""
    start = F.trunc(end, "MM")
    if n < 1:
        return F.expr("cast(array() as array<date>)")
    return F.sequence(F.add_months(start, -n), F.add_months(start, -1), F.expr("interval 1 month"))


def months_range(end: Column, n: int) -> Column:
    """As ``YYYY-MM`` texts."""
    return F.transform(months_before(end, n), lambda d: F.date_format(d, "yyyy-MM"))


def future_months(last: Column, horizon: int) -> Column:
    """The ``horizon`` month starts after the month of ``last``."""
    start = F.trunc(last, "MM")
    return F.sequence(F.add_months(start, 1), F.add_months(start, horizon), F.expr("interval 1 month"))


def mondays_of_month(month_date: Column) -> Column:
    """Every Monday of the month, or the month start if there were none."""
    first = F.next_day(F.date_sub(month_date, 1), "MON")
    return F.sequence(first, F.last_day(month_date), F.expr("interval 7 days"))


def season(month_num: Column, seasons: Mapping[str, Sequence[int]] = config.SEASON_MONTHS) -> Column:
    out = None
    for name, months in seasons.items():
        test = month_num.isin(*months)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def season_onehot(season_col: Column, names: Sequence[str] = tuple(config.SEASON_MONTHS)) -> list[Column]:
    return [
        F.coalesce(season_col == name, F.lit(False)).cast("int").alias(f"season_{name}") for name in names
    ]


def month_angle(month_num: Column) -> Column:
    from math import pi

    return month_num * F.lit(2 * pi / 12)


def cyclic_month(month_num: Column) -> tuple[Column, Column]:
    angle = month_angle(month_num)
    return F.sin(angle), F.cos(angle)

"""Text and category expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetlens import config


def normalise_text(c: Column) -> Column:
    """Lower case, every kind of white space cut from both ends."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def alias_map(c: Column, aliases: Mapping[str, str] = config.CATEGORY_ALIASES) -> Column:
    """Replace known aliases, leave everything else alone."""
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(aliases.items())])
    return F.coalesce(F.try_element_at(lookup, c), c)


def unknown_to_other(
    c: Column,
    known: Sequence[str] = config.CANONICAL_CATEGORIES,
    fallback: str = config.FALLBACK_CATEGORY,
) -> Column:
    """Null included: whatever is not in ``known`` becomes ``fallback``."""
    return F.when(c.isin(*known), c).otherwise(F.lit(fallback))


def canonical_category(
    c: Column,
    aliases: Mapping[str, str] = config.CATEGORY_ALIASES,
    known: Sequence[str] = config.CANONICAL_CATEGORIES,
    fallback: str = config.FALLBACK_CATEGORY,
) -> Column:
    """All three steps as one lookup, so that the text is normalised once per row."""
    target = {name: name for name in known}
    target.update({a: b if b in target else fallback for a, b in aliases.items()})
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(target.items())])
    return F.coalesce(F.try_element_at(lookup, normalise_text(c)), F.lit(fallback))


def violent_flag(c: Column, violent: Iterable[str] = config.VIOLENT_CATEGORIES) -> Column:
    return F.coalesce(c.isin(*violent), F.lit(False)).cast("int")


def pretty_label(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def polygon_text(points: Sequence[tuple[float, float]]) -> str:
    """``lat,lng:lat,lng`` for a request parameter."""
    return ":".join(",".join(str(v) for v in point) for point in points)


def polygon_text_column(points: Column) -> Column:
    """The same for a column holding an array of structs (lat, lng)."""
    return F.array_join(
        F.transform(points, lambda p: F.concat_ws(",", p["lat"].cast("string"), p["lng"].cast("string"))), ":"
    )


def thousands(c: Column, digits: int = 0) -> Column:
    return F.format_number(c, digits)

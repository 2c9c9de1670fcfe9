"""Joins whose strategy is decided from a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.session import cut

# rows of a few dozen bytes each, so some tens of megabytes at most
BROADCAST_ROWS = 500_000


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """Join a large frame with a table that has one row per key.

    The table is broadcast if it is known or measured to have at most
    ``max_rows`` rows, which keeps the large frame where it is. A larger table
    is joined by shuffle, where adaptive execution splits hot keys. A measured
    table is written to the shared folder first, so that it is made only once.
    """
    if known_rows is None:
        table = cut(table)
        known_rows = table.limit(max_rows + 1).count()
    return df.join(F.broadcast(table) if known_rows <= max_rows else table, list(keys), how)

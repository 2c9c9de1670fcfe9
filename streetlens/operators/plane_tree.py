"""A quadtree over points of the plane, one level at a time.

Cells are numbered within the square around all points; the cell of a level is a
prefix of the finest numbers. Pairs of cells are compared by their tight boxes,
which are single points where a cell holds one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 27  # halvings of the square's side
BOX = ("x_lo", "x_hi", "y_lo", "y_hi")


@dataclass(frozen=True)
class PlaneTree:
    """The square (left, low, side) that the cells split."""

    left: float
    low: float
    side: float

    @staticmethod
    def around(points: DataFrame) -> "PlaneTree | None":
        """The square around x and y, a little wider than the points; None without points. Runs one job."""
        row = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
        if row is None or row[0] is None or row[2] is None:
            return None
        side = max(row[1] - row[0], row[3] - row[2], 1e-300) * (1 + 1e-9)
        return PlaneTree(row[0], row[2], side)

    def keyed(self, points: DataFrame) -> DataFrame:
        """Add the finest cell numbers ix, iy."""
        fine = float(1 << LEVELS)
        return points.withColumns({
            "ix": F.floor((F.col("x") - self.left) / self.side * fine).cast("bigint"),
            "iy": F.floor((F.col("y") - self.low) / self.side * fine).cast("bigint"),
        })

    def corner(self, level: int) -> tuple[Column, Column]:
        """The lower left corner of the cell of a keyed row."""
        width = self.side / (1 << level)
        nx, ny = cell(level)
        return nx * width + self.left, ny * width + self.low


def cell(level: int) -> tuple[Column, Column]:
    """The cell numbers of a keyed row at a level."""
    return F.shiftright("ix", LEVELS - level), F.shiftright("iy", LEVELS - level)


def boxes() -> list[Column]:
    return [F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi")]


def box_range(left: str, right: str) -> tuple[Column, Column]:
    """The least and the largest distance between points of the boxes of these prefixes."""
    a = {c: F.col(f"{left}{c}") for c in BOX}
    b = {c: F.col(f"{right}{c}") for c in BOX}

    def along(lo: str, hi: str) -> tuple[Column, Column]:
        return F.greatest(F.lit(0.0), b[lo] - a[hi], a[lo] - b[hi]), F.greatest(b[hi] - a[lo], a[hi] - b[lo])

    (gap_x, span_x), (gap_y, span_y) = along("x_lo", "x_hi"), along("y_lo", "y_hi")
    return F.sqrt(gap_x * gap_x + gap_y * gap_y), F.sqrt(span_x * span_x + span_y * span_y)

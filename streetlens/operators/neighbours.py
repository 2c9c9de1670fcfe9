"""Great-circle neighbourhoods without listing pairs.

Points are kept once per distinct coordinate, with a weight. A grid whose cells
are so small that all points of a cell lie within eps of each other is the root
level of a tree: every level splits a cell into 4 x 4. Questions such as "how
much weight lies within eps of this point" or "do these two cells hold points
within eps of each other" start from pairs of neighbouring cells. A pair whose
tight boxes are wholly within eps counts as a whole, one whose boxes are too
far apart is dropped. Of the pairs in between, cells of few points are compared
point by point and larger ones descend one level. The answers are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, degrees, sin, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlens.config import EARTH_RADIUS_M
from streetlens.functions.geo import chord_to_metres, half_sine_square, haversine_m
from streetlens.session import cut

BOX = ("lat_lo", "lat_hi", "lng_lo", "lng_hi")
CORNERS = ("south", "north", "west", "east")
# a cell of about 100 m is split down to about a tenth of a millimetre
LEVELS = 10
_BITS = 2
# cells of so few distinct points are compared point by point
FEW = 64


@dataclass(frozen=True)
class CellGrid:
    """Cells of equal height whose width in degrees follows the latitude of their row.

    The width and the reach of a row depend on that row alone, so points near a
    pole do not widen the cells or the reach of others, and no pass over the
    points is needed.
    """

    eps: float
    lat_step: float
    lat_reach: int

    @staticmethod
    def of(eps: float) -> "CellGrid":
        if not 0 < eps < EARTH_RADIUS_M / 10:
            raise ValueError("eps must be positive and well below the earth's radius")
        # a little below eps / sqrt(2), so that the diagonal stays below eps
        side = degrees(0.999 * eps / sqrt(2.0) / EARTH_RADIUS_M)
        return CellGrid(eps, side, ceil(degrees(eps / EARTH_RADIUS_M) / side))

    def lng_step(self, cy: Column) -> Column:
        """Width in degrees of the cells of a row: the side is met at the edge next to the equator."""
        south = cy * self.lat_step - 90.0
        nearest = F.greatest(F.lit(0.0), south, -south - self.lat_step)
        return F.lit(self.lat_step) / F.greatest(F.cos(F.radians(nearest)), F.lit(1e-12))

    def lng_span(self, cy: Column) -> Column:
        """The largest difference of longitude of points within eps, one of them in this row."""
        farthest = F.greatest(90.0 - (cy - self.lat_reach) * self.lat_step, (cy + self.lat_reach + 1) * self.lat_step - 90.0)
        least = F.cos(F.radians(F.least(farthest, F.lit(90.0))))
        chord = F.lit(sin(self.eps / (2 * EARTH_RADIUS_M))) / F.greatest(least, F.lit(1e-12))
        return F.when(chord >= 1, F.lit(360.0)).otherwise(F.degrees(2 * F.asin(F.least(chord, F.lit(1.0)))) * (1 + 1e-9))

    def keyed(self, points: DataFrame) -> DataFrame:
        """Add the finest cell numbers iy, ix."""
        fine = float(1 << (_BITS * LEVELS))
        rows = points.withColumn("iy", F.floor((F.col("latitude") + 90.0) / self.lat_step * fine).cast("bigint"))
        return rows.withColumn("ix", F.floor((F.col("longitude") + 180.0) / self.lng_step(level_key(F.col("iy"), 0)) * fine).cast("bigint"))

    def near(self, cy: Column, cx: Column) -> Column:
        """Array of cell structs (y, x) that can hold points within eps of a point in this cell."""
        step, span = self.lng_step(cy), self.lng_span(cy)
        west, east = cx * step - span, (cx + 1) * step + span

        def columns(y: Column) -> Column:
            def between(lo: Column, hi: Column) -> Column:
                return F.sequence(F.floor(lo / self.lng_step(y)), F.floor(hi / self.lng_step(y)))

            none = F.array().cast("array<bigint>")
            start, end = F.lit(0.0), F.lit(360.0)
            # what reaches over the date line comes in again on the other side
            parts = F.concat(
                between(F.greatest(west, start), F.least(east, end)),
                F.when(west < 0, between(west + 360.0, end)).otherwise(none),
                F.when(east > 360.0, between(start, east - 360.0)).otherwise(none),
            )
            return F.when(east - west >= 360.0, between(start, end)).otherwise(F.array_distinct(parts))

        rows = F.sequence(cy - self.lat_reach, cy + self.lat_reach)
        return F.flatten(F.transform(rows, lambda y: F.transform(columns(y), lambda x: F.struct(y.alias("y"), x.alias("x")))))


def level_key(c: Column, level: int) -> Column:
    return F.shiftright(c, _BITS * (LEVELS - level))


def distinct_points(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(latitude, longitude, w, first_id): one row per coordinate. Copies are counted before the shuffle."""
    return df.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("first_id"))


def _boxes() -> list[Column]:
    return [
        F.min("latitude").alias("lat_lo"), F.max("latitude").alias("lat_hi"),
        F.min("longitude").alias("lng_lo"), F.max("longitude").alias("lng_hi"),
    ]


def cells(points: DataFrame, *extra: Column) -> DataFrame:
    """Root cells (cy, cx) with box, weight and further aggregates."""
    return points.groupBy(level_key(F.col("iy"), 0).alias("cy"), level_key(F.col("ix"), 0).alias("cx")).agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), *_boxes(), *extra
    )


def _cos_range(lo: Column, hi: Column) -> tuple[Column, Column]:
    least = F.least(F.cos(F.radians(lo)), F.cos(F.radians(hi)))
    most = F.when((lo <= 0) & (hi >= 0), F.lit(1.0)).otherwise(F.greatest(F.cos(F.radians(lo)), F.cos(F.radians(hi))))
    return least, most


def _distance_range(left: str, right: str) -> tuple[Column, Column]:
    """Bounds of the distance between any point of one box and any of another, equal for single points."""
    a = {c: F.col(f"{left}{c}") for c in BOX}
    b = {c: F.col(f"{right}{c}") for c in BOX}

    def gap_span(lo: str, hi: str) -> tuple[Column, Column]:
        gap = F.greatest(F.lit(0.0), b[lo] - a[hi], a[lo] - b[hi])
        return gap, F.greatest(b[hi] - a[lo], a[hi] - b[lo])

    lat_gap, lat_span = gap_span("lat_lo", "lat_hi")
    lng_gap, lng_span = gap_span("lng_lo", "lng_hi")
    # past 180 degrees the sine of the half angle falls again: across the date
    # line the larger difference is the nearer one
    g, s = half_sine_square(lng_gap), half_sine_square(lng_span)
    near = F.least(g, s)
    far = F.when((lng_gap <= 180.0) & (lng_span >= 180.0), F.lit(1.0)).otherwise(F.greatest(g, s))
    a_least, a_most = _cos_range(a["lat_lo"], a["lat_hi"])
    b_least, b_most = _cos_range(b["lat_lo"], b["lat_hi"])
    return (
        chord_to_metres(half_sine_square(lat_gap) + a_least * b_least * near),
        chord_to_metres(half_sine_square(lat_span) + a_most * b_most * far),
    )


def _children(points: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` below the given (py, px) of the level above; points below the last level."""
    py, px = level_key(F.col("iy"), level - 1).alias("py"), level_key(F.col("ix"), level - 1).alias("px")
    inside = points.select("*", py, px).join(parents, ["py", "px"], "left_semi")
    if level > LEVELS:
        return inside.select(
            "py", "px", F.col("iy").alias("ny"), F.col("ix").alias("nx"), "w", F.lit(1).cast("bigint").alias("n"),
            F.col("latitude").alias("lat_lo"), F.col("latitude").alias("lat_hi"),
            F.col("longitude").alias("lng_lo"), F.col("longitude").alias("lng_hi"),
        )
    ny, nx = level_key(F.col("iy"), level), level_key(F.col("ix"), level)
    return inside.groupBy("py", "px", ny.alias("ny"), nx.alias("nx")).agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), *_boxes()
    )


def _renamed(nodes: DataFrame, prefix: str) -> DataFrame:
    return nodes.select(
        F.col("py").alias(f"{prefix}y"), F.col("px").alias(f"{prefix}x"), F.col("ny").alias(f"{prefix}ny"),
        F.col("nx").alias(f"{prefix}nx"), F.col("w").alias(f"{prefix}w_new"), F.col("n").alias(f"{prefix}n_new"), *[F.col(c).alias(f"{prefix}{c}_new") for c in BOX],
    )


def _descend(pairs: DataFrame, points: DataFrame, level: int, prefix: str) -> DataFrame:
    """Replace one side of each pair by its children."""
    parents = pairs.select(F.col(f"{prefix}y").alias("py"), F.col(f"{prefix}x").alias("px")).distinct()
    nodes = _renamed(_children(points, parents, level), prefix)
    joined = pairs.join(nodes, [f"{prefix}y", f"{prefix}x"])
    swap = {f"{prefix}{c}_new": f"{prefix}{c}" for c in (*BOX, "w", "n")}
    swap |= {f"{prefix}ny": f"{prefix}y", f"{prefix}nx": f"{prefix}x"}
    return joined.drop(*swap.values()).withColumnsRenamed(swap)


def _point_by_point(pairs: DataFrame, points: DataFrame, level: int, eps: float, split_left: DataFrame | None) -> DataFrame:
    """The pairs of a level with their right-hand points (and left-hand ones) within eps, weight in r_w."""

    def members(source: DataFrame, prefix: str) -> DataFrame:
        return source.select(
            level_key(F.col("iy"), min(level, LEVELS)).alias(f"{prefix}y"), level_key(F.col("ix"), min(level, LEVELS)).alias(f"{prefix}x"),
            F.col("latitude").alias(f"{prefix}lat"), F.col("longitude").alias(f"{prefix}lng"), F.col("w").alias(f"{prefix}pw"),
        )

    out = pairs.join(members(points, "r_"), ["r_y", "r_x"])
    if split_left is None:
        out = out.withColumns({"l_lat": F.col("l_lat_lo"), "l_lng": F.col("l_lng_lo")})
    else:
        out = out.join(members(split_left, "l_"), ["l_y", "l_x"])
    near = haversine_m(F.col("l_lat"), F.col("l_lng"), F.col("r_lat"), F.col("r_lng")) <= eps
    return out.filter(near).withColumn("r_w", F.col("r_pw"))


def weight_within(
    pairs: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    eps: float,
    need: int | None = None,
    split_left: DataFrame | None = None,
) -> DataFrame:
    """(keys, total): weight of right-hand points within eps of the left-hand side.

    ``pairs`` holds ``keys``, a left box (l_*), and a right root cell (r_y, r_x,
    r_w, r_n and its box). With ``need`` a key is settled, and left alone, as
    soon as its total reaches it. With ``split_left`` the left side is a cell
    (l_y, l_x, l_w, l_n) of those points, and any pair of points within eps counts.

    Undecided cells of at most ``FEW`` points are compared point by point, larger
    ones descend a level.
    """
    keys = list(keys)
    settled: list[DataFrame] = []
    frontier = pairs
    for level in range(LEVELS + 2):
        least, most = _distance_range("l_", "r_")
        ranged = frontier.withColumns({"_least": least, "_most": most}).filter(F.col("_least") <= eps)
        open_pairs = ranged.filter(F.col("_most") > eps)
        few = F.col("r_n") <= FEW
        if split_left is not None:
            few = few & (F.col("l_n") <= FEW)
        whole = ranged.filter(F.col("_most") <= eps).select(*keys, "r_w")
        single = _point_by_point(open_pairs.filter(few), points, level, eps, split_left).select(*keys, "r_w")
        settled.append(cut(whole.unionByName(single).groupBy(*keys).agg(F.sum("r_w").alias("total"))))
        large = open_pairs.filter(~few).drop("_least", "_most")
        if need is not None:
            reached = reduce(DataFrame.unionByName, settled).groupBy(*keys).agg(F.sum("total").alias("total"))
            large = large.join(reached.filter(F.col("total") >= need), keys, "left_anti")
        large = cut(large)
        if large.isEmpty():
            break
        frontier = _descend(large, points, level + 1, "r_")
        if split_left is not None:
            frontier = _descend(frontier, split_left, level + 1, "l_")
    return reduce(DataFrame.unionByName, settled).groupBy(*keys).agg(F.sum("total").alias("total"))


def _right(cell_table: DataFrame) -> DataFrame:
    return cell_table.select(
        F.col("cy").alias("r_y"), F.col("cx").alias("r_x"), F.col("w").alias("r_w"), F.col("n").alias("r_n"),
        *[F.col(c).alias(f"r_{c}") for c in BOX],
    )


def point_pairs(queries: DataFrame, targets: DataFrame, grid: CellGrid, keys: Sequence[str] = ("first_id",)) -> DataFrame:
    """Each query point beside the root cells near it."""
    here = F.explode(grid.near(level_key(F.col("iy"), 0), level_key(F.col("ix"), 0))).alias("near")
    left = queries.select(
        *keys, F.col("latitude").alias("l_lat_lo"), F.col("latitude").alias("l_lat_hi"),
        F.col("longitude").alias("l_lng_lo"), F.col("longitude").alias("l_lng_hi"), here,
    )
    return left.select("*", F.col("near.y").alias("r_y"), F.col("near.x").alias("r_x")).drop("near").join(
        _right(targets), ["r_y", "r_x"]
    )


def cell_pairs(cell_table: DataFrame, grid: CellGrid, name: str) -> DataFrame:
    """Each pair of neighbouring cells once, named (a, b) by the column ``name``."""
    near = F.explode(grid.near(F.col("cy"), F.col("cx"))).alias("near")
    left = cell_table.select(
        F.col(name).alias("a"), F.col("cy").alias("l_y"), F.col("cx").alias("l_x"), F.col("w").alias("l_w"), F.col("n").alias("l_n"),
        *[F.col(c).alias(f"l_{c}") for c in (*BOX, *CORNERS)], near,
    )
    right = _right(cell_table).join(
        cell_table.select(
            F.col("cy").alias("r_y"), F.col("cx").alias("r_x"), F.col(name).alias("b"), *[F.col(c).alias(f"r_{c}") for c in CORNERS]
        ), ["r_y", "r_x"]
    )
    return (
        left.select("*", F.col("near.y").alias("r_y"), F.col("near.x").alias("r_x")).drop("near")
        .join(right, ["r_y", "r_x"]).filter(F.col("a") < F.col("b"))
    )


def corner_points() -> list[Column]:
    """The southernmost, northernmost, westernmost and easternmost point of a cell."""
    place = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng"))
    return [
        F.min_by(place, "latitude").alias("south"), F.max_by(place, "latitude").alias("north"),
        F.min_by(place, "longitude").alias("west"), F.max_by(place, "longitude").alias("east"),
    ]


def linked_cells(cell_table: DataFrame, points: DataFrame, grid: CellGrid, name: str) -> DataFrame:
    """(a, b): neighbouring cells that hold points within eps of each other.

    ``cell_table`` has the corner points. Most pairs are settled by a pair of
    corner points; the others are searched.
    """
    pairs = cut(cell_pairs(cell_table, grid, name).withColumn("_close", F.least(*[
        haversine_m(F.col(f"l_{c}.lat"), F.col(f"l_{c}.lng"), F.col(f"r_{d}.lat"), F.col(f"r_{d}.lng"))
        for c in CORNERS for d in CORNERS
    ]) <= grid.eps))
    corners = [f"{side}{c}" for side in ("l_", "r_") for c in CORNERS]
    rest = pairs.filter(~F.col("_close")).drop("_close", *corners)
    searched = weight_within(rest, points, ["a", "b"], grid.eps, 1, points)
    return pairs.filter("_close").select("a", "b").unionByName(searched.select("a", "b"))


def eps_neighbours(df: DataFrame, eps: float, id_col: str = "id", at_least: int | None = None) -> DataFrame:
    """(latitude, longitude, w, neighbours): incidents within eps metres of each coordinate, itself included.

    With ``at_least``, counting stops once a point is known to have that many.
    """
    points = cut(distinct_points(df, id_col))
    grid = CellGrid.of(eps)
    keyed = grid.keyed(points)
    totals = weight_within(point_pairs(keyed, cells(keyed), grid), keyed, ["first_id"], eps, at_least)
    return points.join(totals, "first_id").select("latitude", "longitude", "w", F.col("total").alias("neighbours"))

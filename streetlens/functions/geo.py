"""Coordinates: validity, polygon cover, grids, hexagons and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetlens import config

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def coordinate(text: Column) -> Column:
    """A number read from text, null for anything that is not a plain decimal."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def valid_coords(lat: Column, lng: Column) -> Column:
    # NaN sorts above every number, so the upper bounds drop it
    return (
        lat.isNotNull() & lng.isNotNull()
        & (lat >= -90.0) & (lat <= 90.0) & (lng >= -180.0) & (lng <= 180.0)
    )


def covered_by(lat: Column, lng: Column, polygon: Sequence[tuple[float, float]] = config.AREA_POLYGON) -> Column:
    """True for points inside the polygon or on its boundary.

    The bounding box comes first as plain comparisons, so that a scan can skip
    row groups; the exact test is only arithmetic on literals.
    """
    lats = [p[0] for p in polygon]
    lngs = [p[1] for p in polygon]
    box = (
        (lat >= min(lats)) & (lat <= max(lats)) & (lng >= min(lngs)) & (lng <= max(lngs))
    )
    touching: list[Column] = []
    crossings: list[Column] = []
    for (a_lat, a_lng), (b_lat, b_lng) in zip(polygon, [*polygon[1:], polygon[0]]):
        side = (lat - a_lat) * (b_lng - a_lng) - (lng - a_lng) * (b_lat - a_lat)
        touching.append(
            (side == 0.0)
            & lat.between(min(a_lat, b_lat), max(a_lat, b_lat))
            & lng.between(min(a_lng, b_lng), max(a_lng, b_lng))
        )
        if a_lat != b_lat:
            low, high = min(a_lat, b_lat), max(a_lat, b_lat)
            # a ray to the east crosses an edge that spans the latitude and
            # whose carrying line lies to the east of the point
            east = side > 0.0 if b_lat > a_lat else side < 0.0
            crossings.append(((lat >= low) & (lat < high) & east).cast("int"))
    inside = (reduce(lambda x, y: x + y, crossings) % 2) == 1
    return box & (reduce(lambda x, y: x | y, touching) | inside)


def fixed_cell(x: Column, scale: float) -> Column:
    """Coordinate as a whole number of 1/scale steps, ties to even."""
    return F.rint(x * F.lit(float(scale))).cast("bigint")


def fine_cell(lat: Column, lng: Column) -> tuple[Column, Column]:
    return fixed_cell(lat, 1000), fixed_cell(lng, 1000)


def grid_bin(x: Column, lo: Column, hi: Column, cells: int) -> Column:
    """Half-open bin between lo and hi; the upper edge falls into the last bin."""
    step = (hi - lo) / F.lit(float(cells))
    raw = F.floor(F.try_divide(x - lo, step)).cast("int")
    edge = lambda i: lo + i * step
    nudged = F.when(x >= edge(raw + 1), raw + 1).when(x < edge(raw), raw - 1).otherwise(raw)
    clipped = F.least(F.greatest(nudged, F.lit(0)), F.lit(cells - 1))
    return F.when(x.isNotNull(), F.when(hi == lo, F.lit(cells - 1)).otherwise(clipped))


def grid_centre(index: Column, lo: Column, hi: Column, cells: int) -> Column:
    step = (hi - lo) / F.lit(float(cells))
    return lo + index * step + step / F.lit(2.0)


def hex_cell(lng: Column, lat: Column, bounds: Column, cells: int) -> Column:
    """Nearest cell of two interleaved rectangular lattices, as a struct.

    ``bounds`` is a struct with lat_min, lat_max, lng_min and lng_max. Lattice
    0 has its nodes at whole steps, lattice 1 at half steps.
    """
    rows = int(cells / sqrt(3.0))

    def scaled(v: Column, lo: Column, hi: Column, n: int) -> tuple[Column, Column, Column]:
        pad = (hi - lo) * F.lit(1e-9)
        start = lo - pad
        step = ((hi + pad) - start) / F.lit(float(n))
        return (v - start) / step, start, step

    x, x0, sx = scaled(lng, bounds["lng_min"], bounds["lng_max"], cells)
    y, y0, sy = scaled(lat, bounds["lat_min"], bounds["lat_max"], rows)
    xn, yn, xf, yf = F.rint(x), F.rint(y), F.floor(x).cast("double"), F.floor(y).cast("double")
    to_node = (x - xn) * (x - xn) + F.lit(3.0) * ((y - yn) * (y - yn))
    dx, dy = x - xf - F.lit(0.5), y - yf - F.lit(0.5)
    to_half = dx * dx + F.lit(3.0) * (dy * dy)
    node = to_node < to_half
    half = F.lit(0.5)
    return F.struct(
        F.when(node, 0).otherwise(1).alias("lattice"),
        F.when(node, xn).otherwise(xf).cast("int").alias("hx"),
        F.when(node, yn).otherwise(yf).cast("int").alias("hy"),
        (F.when(node, xn).otherwise(xf + half) * sx + x0).alias("lng_c"),
        (F.when(node, yn).otherwise(yf + half) * sy + y0).alias("lat_c"),
    )


def half_sine_square(degrees: Column) -> Column:
    """Square of the sine of half the angle."""
    s = F.sin(F.radians(degrees) / F.lit(2.0))
    return s * s


def chord_to_metres(h: Column) -> Column:
    return F.lit(2.0 * config.EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    product = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return chord_to_metres(half_sine_square(lat2 - lat1) + product * half_sine_square(lng2 - lng1))


def dist_to_centre(lat: Column, lng: Column, centre: tuple[float, float] = config.AREA_CENTRE) -> Column:
    """Planar distance in degrees."""
    dlat, dlng = lat - F.lit(centre[0]), lng - F.lit(centre[1])
    return F.sqrt(dlat * dlat + dlng * dlng)

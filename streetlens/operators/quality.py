"""Cluster quality on distinct weighted points.

Frames have columns x, y, w and label; every distance counts w times. Noise
must be dropped by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetlens.functions import geo
from streetlens.operators.joins import lookup_join
from streetlens.operators.plane_tree import BOX, LEVELS, PlaneTree, box_range, boxes, cell
from streetlens.session import cut, written

# the search of the worst neighbour splits a cell into 8 x 8
BITS = 3
# cells of a cluster with so few distinct points are added up point by point
FEW = 4

Distance = Callable[[Column, Column, Column, Column], Column]


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def haversine(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """x is latitude, y is longitude, in degrees; the result is in radians."""
    from streetlens.config import EARTH_RADIUS_M

    return geo.haversine_m(x1, y1, x2, y2) / F.lit(EARTH_RADIUS_M)


def standardise(df: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    w = F.col(weight) if weight else F.lit(1)
    total = F.sum(w)
    means = df.agg(F.struct(*[(F.sum(F.col(c) * w) / total).alias(c) for c in columns]).alias("m"))
    centred = df.withColumn("_m", means.scalar()).withColumns({c: F.col(c) - F.col(f"_m.{c}") for c in columns}).drop("_m")
    spreads = centred.agg(F.struct(*[
        F.sqrt(F.sum(F.col(c) * F.col(c) * w) / total).alias(c) for c in columns
    ]).alias("s"))
    return centred.withColumn("_s", spreads.scalar()).withColumns({
        c: F.when(F.col(f"_s.{c}") > 0, F.col(c) / F.col(f"_s.{c}")).otherwise(F.lit(0.0)) for c in columns
    }).drop("_s")


def nearest_centroid(df: DataFrame, centres: list[tuple[float, float]], x: str = "x", y: str = "y", out: str = "label") -> DataFrame:
    """Add the number of the closest centre and the squared distance; the first wins a tie.

    The centres are literals in the plan: a handful per clustering.
    """
    gaps = [
        F.struct(
            ((F.col(x) - cx) * (F.col(x) - cx) + (F.col(y) - cy) * (F.col(y) - cy)).alias("d2"), F.lit(i).alias("i")
        )
        for i, (cx, cy) in enumerate(centres)
    ]
    best = F.least(*gaps) if len(gaps) > 1 else gaps[0]
    return df.withColumn("_best", best).withColumns({out: F.col("_best.i"), "d2": F.col("_best.d2")}).drop("_best")


def centroids(points: DataFrame) -> DataFrame:
    """(label, cx, cy, n)."""
    w = F.col("w")
    return points.groupBy("label").agg(
        (F.sum(F.col("x") * w) / F.sum(w)).alias("cx"), (F.sum(F.col("y") * w) / F.sum(w)).alias("cy"), F.sum(w).alias("n")
    )


def inertia(points: DataFrame) -> DataFrame:
    """Sum of squared distances to the own centroid, in one row."""
    points = cut(points.select("x", "y", "w", "label"))
    joined = lookup_join(points, centroids(points), ["label"], "inner")
    gap = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2
    return joined.agg(F.sum(gap * F.col("w")).alias("inertia"))


def _block(x: str, y: str, blocks: int) -> Column:
    return F.pmod(F.hash(x, y), F.lit(blocks))


def _worst_neighbour(clusters: DataFrame) -> DataFrame:
    """(label, r): the largest (s + s_j) / d over the other clusters j at another place; null if there is none.

    A search with bounds in a tree over the centres. A cell knows its largest s,
    so (s + largest) / d lies between the values at the cell's farthest and
    nearest point. The farthest one is reached by some cluster of the cell; cells
    whose nearest one is not above the best so far are dropped. A cluster of a
    very large s keeps only the cells it lies in.
    """
    tree = PlaneTree.around(clusters)
    keyed = written(tree.keyed(clusters), "centres")
    left = keyed.select("label", "s", F.col("ix").alias("l_ix"), F.col("iy").alias("l_iy"), *[F.col(c[0]).alias(f"l_{c}") for c in BOX])
    none = F.lit(0).cast("bigint")
    frontier = left.withColumns({"px": none, "py": none, "r": F.lit(None).cast("double")})
    best = []
    before = 0
    for bits in (*range(BITS, LEVELS + 1, BITS), None):
        up, (nx, ny) = cell(before), cell(LEVELS if bits is None else bits)
        keys = [up[0].alias("px"), up[1].alias("py"), nx.alias("nx"), ny.alias("ny")]
        if bits is None:  # what the finest cells hold, one by one
            keys.append(F.col("label").alias("single"))
        cells = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("most_s"), F.max("label").alias("one"), *boxes())
        met = frontier.join(cells.drop("single").withColumnsRenamed({c: f"r_{c}" for c in BOX}), ["px", "py"])
        least, most = box_range("l_", "r_")
        if bits is None:
            own = F.col("one") == F.col("label")
        else:
            own = (F.shiftright("l_ix", LEVELS - bits) == F.col("nx")) & (F.shiftright("l_iy", LEVELS - bits) == F.col("ny"))
            before = bits
        # the cluster itself, and others at its very place, do not count
        met = met.withColumns({"_own": own, "_least": least, "_most": most}).filter((F.col("_most") > 0) & ~(F.col("_own") & (F.col("n") == 1)))
        both = F.col("s") + F.col("most_s")
        met = met.withColumns({
            "_low": F.when(~F.col("_own"), both / F.col("_most")),
            "_high": F.coalesce(F.try_divide(both, F.col("_least")), F.lit(float("inf"))),
        }).withColumn("r", F.greatest("r", F.max("_low").over(Window.partitionBy("label"))))
        met = written(met.select(*left.columns, F.col("nx").alias("px"), F.col("ny").alias("py"), "r", "_high"), "worst")
        best.append(met.select("label", "r"))
        frontier = met.filter(F.col("r").isNull() | (F.col("_high") > F.col("r"))).drop("_high")
        if frontier.isEmpty():
            break
    return reduce(DataFrame.unionByName, best).groupBy("label").agg(F.max("r").alias("r"))


def davies_bouldin(points: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d(c_i, c_j), in one row.

    Clusters with the same centre do not count for each other; a cluster without
    any other counts 0. The worst partner is searched with bounds, so clusters
    are not compared pair by pair. Runs jobs.
    """
    points = cut(points.select("x", "y", "w", "label"))
    centres = centroids(points)
    clusters = cut(
        lookup_join(points, centres, ["label"], "inner")
        .groupBy("label", F.col("cx").alias("x"), F.col("cy").alias("y"))
        .agg((F.sum(euclidean(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")) * F.col("w")) / F.sum("w")).alias("s"))
    )
    if clusters.isEmpty():
        return clusters.agg(F.avg("s").alias("davies_bouldin"))
    return lookup_join(clusters, _worst_neighbour(clusters), ["label"]).agg(F.avg(F.coalesce("r", F.lit(0.0))).alias("davies_bouldin"))


def _mean_silhouette(sums: DataFrame, points: DataFrame) -> DataFrame:
    """The score, in one row, of (x, y, w, label, other, reach): the distances of a point to all of a cluster, added up."""
    sizes = points.groupBy(F.col("label").alias("other")).agg(F.sum("w").alias("size"))
    own = F.col("other") == F.col("label")
    per_point = lookup_join(sums, sizes, ["other"], "inner").groupBy("x", "y", "w", "label").agg(
        F.max(F.when(own, F.try_divide(F.col("reach"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("reach") / F.col("size"))).alias("b"),
    )
    # a cluster of one has no a and scores 0
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return per_point.agg(
        F.when(F.count("b") > 0, F.sum(score * F.col("w")) / F.sum("w")).alias("silhouette")
    )


def silhouette_exact(points: DataFrame, distance: Distance = euclidean, rows_per_block: int = 512) -> DataFrame:
    """Mean silhouette of true distances, in one row; null with fewer than two clusters.

    The score compares every distinct point with every other, so the work is
    quadratic in distinct points. It is cut into blocks of a bounded size: each
    point meets each block once and adds up its distances there, so no task
    holds more than one block of partners. Use ``silhouette_within`` or
    ``silhouette_fast`` beyond some ten thousands of distinct points.
    """
    points = cut(points.select("x", "y", "w", "label"))
    blocks = max(1, -(-points.count() // rows_per_block))
    packed = points.groupBy(_block("x", "y", blocks).alias("block"), F.col("label").alias("other")).agg(
        F.collect_list(F.struct("x", "y", F.col("w").cast("double").alias("w"))).alias("members")
    )
    reach = F.aggregate(
        "members", F.lit(0.0),
        lambda acc, m: acc + m["w"] * distance(F.col("x"), F.col("y"), m["x"], m["y"]),
    )
    sums = (
        points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(packed, "block")
        .withColumn("reach", reach)
        .groupBy("x", "y", "w", "label", "other").agg(F.sum("reach").alias("reach"))
    )
    return _mean_silhouette(sums, points)


def _masses(keyed: DataFrame, tree: PlaneTree, level: int, parents: list[Column]) -> DataFrame:
    """Cells of each cluster at a level: weight, mean place, second moments about it, box."""
    corner_x, corner_y = tree.corner(level)
    u, v, w = F.col("x") - corner_x, F.col("y") - corner_y, F.col("w").cast("double")
    nx, ny = cell(level)
    at = keyed.groupBy(*parents, nx.alias("r_nx"), ny.alias("r_ny"), F.col("label").alias("other")).agg(
        F.sum(w).alias("mass"), F.count(F.lit(1)).alias("n"), F.min(corner_x).alias("cx"), F.min(corner_y).alias("cy"),
        (F.sum(u * w) / F.sum(w)).alias("u"), (F.sum(v * w) / F.sum(w)).alias("v"),
        F.sum(u * u * w).alias("uu"), F.sum(u * v * w).alias("uv"), F.sum(v * v * w).alias("vv"), *boxes(),
    )
    mass, mu, mv = F.col("mass"), F.col("u"), F.col("v")
    return at.select(
        *[c for c in at.columns if c.startswith("r_")], "other", "mass", F.col("n").alias("r_n"),
        (F.col("cx") + mu).alias("mx"), (F.col("cy") + mv).alias("my"),
        F.greatest(F.col("uu") - mass * mu * mu, F.lit(0.0)).alias("mxx"), (F.col("uv") - mass * mu * mv).alias("mxy"),
        F.greatest(F.col("vv") - mass * mv * mv, F.lit(0.0)).alias("myy"), *[F.col(c).alias(f"r_{c}") for c in BOX],
    )


def _far_and_near(keyed: DataFrame, tree: PlaneTree, tolerance: float) -> Iterator[tuple[str, int, DataFrame]]:
    """Pairs of a cell of points and a cell of a cluster, level by level: ("far" or "near", level, pairs).

    Far pairs may be answered from the cluster's mass and moments: with r the
    largest distance of its mean to a corner and D the least distance of the mean
    to the left cell, the third derivative of a distance is at most
    2 / sqrt(3) / (D - r)^2 along the way, so leaving it out costs at most
    r * (mxx + myy) / (3 sqrt(3) (D - r)^2), and the sum is mass * D or more.
    Near pairs have few points on the right, or lie in the finest cells.
    """
    frontier = None
    for level in range(LEVELS + 1):
        up = cell(max(level - 1, 0))
        nx, ny = cell(level)
        left = keyed.groupBy(up[0].alias("l_px"), up[1].alias("l_py"), nx.alias("l_nx"), ny.alias("l_ny")).agg(*boxes()).withColumnsRenamed(
            {c: f"l_{c}" for c in BOX}
        )
        right = _masses(keyed, tree, level, [up[0].alias("r_px"), up[1].alias("r_py")])
        if frontier is None:
            pairs = left.join(F.broadcast(right), (F.col("l_nx") == F.col("r_nx")) & (F.col("l_ny") == F.col("r_ny")))
        else:
            pairs = frontier.join(left, ["l_px", "l_py"]).join(right, ["r_px", "r_py", "other"])
        gap_x = F.greatest(F.lit(0.0), F.col("l_x_lo") - F.col("mx"), F.col("mx") - F.col("l_x_hi"))
        gap_y = F.greatest(F.lit(0.0), F.col("l_y_lo") - F.col("my"), F.col("my") - F.col("l_y_hi"))
        far_x = F.greatest(F.col("r_x_hi") - F.col("mx"), F.col("mx") - F.col("r_x_lo"))
        far_y = F.greatest(F.col("r_y_hi") - F.col("my"), F.col("my") - F.col("r_y_lo"))
        gap, radius = F.sqrt(gap_x * gap_x + gap_y * gap_y), F.sqrt(far_x * far_x + far_y * far_y)
        error = radius * (F.col("mxx") + F.col("myy")) / (3 * sqrt(3.0))
        allowed = tolerance * F.col("mass") * gap * (gap - radius) * (gap - radius)
        pairs = written(pairs.withColumn("_far", (gap > radius) & (error <= allowed)), "pairs")
        yield "far", level, pairs.filter("_far")
        few = F.lit(True) if level == LEVELS else F.col("r_n") <= FEW
        yield "near", level, pairs.filter(~F.col("_far") & few)
        frontier = pairs.filter(~F.col("_far") & ~few).select(*[
            F.col(c).alias(c.replace("_n", "_p")) for c in ("l_nx", "l_ny", "r_nx", "r_ny")
        ], "other")
        if frontier.isEmpty():
            return


def silhouette_within(points: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Mean silhouette of Euclidean distances up to ``2 * tolerance / (1 - tolerance)``, in one row.

    Sums of distances to a cluster are right up to the share ``tolerance``. Far
    cells of a cluster count by mass and second moments, cells for which that is
    not proven split on both sides, and what is left is added up point by point.
    The work grows with n log n; at tolerance 0 it is that of all pairs. Runs jobs.
    """
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    points = cut(points.select("x", "y", "w", "label"))
    tree = PlaneTree.around(points)
    if tree is None:
        return points.agg(F.avg("x").alias("silhouette"))
    keyed = written(tree.keyed(points), "points")
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    d = F.sqrt(dx * dx + dy * dy)
    ex, ey = dx / d, dy / d
    bent = (F.col("mxx") * ey * ey - 2 * F.col("mxy") * ex * ey + F.col("myy") * ex * ex) / (2 * d)
    parts = []
    for kind, level, pairs in _far_and_near(keyed, tree, tolerance):
        nx, ny = cell(level)
        here = keyed.select("x", "y", "w", "label", nx.alias("l_nx"), ny.alias("l_ny"))
        # coarse cells hold many points but are in few pairs, which Spark broadcasts by the size of their table
        if kind == "far":
            met = here.join(pairs.select("l_nx", "l_ny", "other", "mass", "mx", "my", "mxx", "mxy", "myy"), ["l_nx", "l_ny"])
            reach = F.col("mass") * d + bent
        else:
            there = here.select(
                F.col("x").alias("r_x"), F.col("y").alias("r_y"), F.col("w").alias("r_w"), F.col("label").alias("other"),
                F.col("l_nx").alias("r_nx"), F.col("l_ny").alias("r_ny"),
            )
            members = pairs.select("l_nx", "l_ny", "other", "r_nx", "r_ny").join(there, ["r_nx", "r_ny", "other"])
            met = here.join(members, ["l_nx", "l_ny"])
            reach = F.col("r_w") * euclidean(F.col("x"), F.col("y"), F.col("r_x"), F.col("r_y"))
        parts.append(met.select("x", "y", "w", "label", "other", reach.alias("reach")))
    sums = reduce(DataFrame.unionByName, parts).groupBy("x", "y", "w", "label", "other").agg(F.sum("reach").alias("reach"))
    return _mean_silhouette(sums, points)


def silhouette_fast(points: DataFrame, rows_per_block: int = 1024) -> DataFrame:
    """Mean silhouette on squared distances, linear in the number of points.

    A different number from ``silhouette_exact``. Squared distances to all
    members of a cluster follow from its weight, sums and sum of squares, so a
    point only meets one entry per cluster, in blocks of bounded size.
    """
    w, x, y = F.col("w"), F.col("x"), F.col("y")
    points = cut(points.select("x", "y", "w", "label"))
    clusters = cut(points.groupBy(F.col("label").alias("other")).agg(
        F.sum(w).cast("double").alias("n"), F.sum(x * w).alias("sx"), F.sum(y * w).alias("sy"),
        F.sum((x * x + y * y) * w).alias("ss"),
    ))
    count = clusters.count()
    blocks = max(1, -(-count // rows_per_block))
    packed = clusters.groupBy(F.pmod(F.hash("other"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("other", "n", "sx", "sy", "ss")).alias("clusters")
    )

    def total(c: Column) -> Column:
        return F.greatest(c["n"] * (x * x + y * y) - (x * c["sx"] + y * c["sy"]) * 2.0 + c["ss"], F.lit(0.0))

    met = lookup_join(
        points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), packed, ["block"], "inner",
        known_rows=count,
    ).withColumns({
        "a": F.array_max(F.transform(
            F.filter("clusters", lambda c: c["other"] == F.col("label")), lambda c: F.try_divide(total(c), c["n"] - 1.0))),
        "b": F.array_min(F.transform(
            F.filter("clusters", lambda c: c["other"] != F.col("label")), lambda c: total(c) / c["n"])),
    })
    if blocks > 1:
        met = met.groupBy("x", "y", "w", "label").agg(F.max("a").alias("a"), F.min("b").alias("b"))
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return met.agg(F.when(F.count("b") > 0, F.sum(score * w) / F.sum(w)).alias("silhouette"))

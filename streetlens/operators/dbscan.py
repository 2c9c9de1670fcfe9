"""Density clustering on great-circle distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators.components import connected_components
from streetlens.operators.joins import lookup_join
from streetlens.operators.neighbours import (
    CellGrid, cells, corner_points, distinct_points, level_key, linked_cells, point_pairs, weight_within,
)
from streetlens.operators.numbering import numbered
from streetlens.session import cut


def cluster_points(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """(latitude, longitude, label) for distinct weighted points.

    A point is core if at least ``min_samples`` weight lies within eps, itself
    included. Clusters are numbered by the smallest first_id of their core
    points; a border point takes the lowest number within reach; noise is -1.
    """
    grid = CellGrid.of(eps)
    cy, cx = level_key(F.col("iy"), 0).alias("cy"), level_key(F.col("ix"), 0).alias("cx")
    keyed = cut(grid.keyed(points).select("*", cy, cx))
    all_cells = cut(cells(keyed))

    # all points of a heavy cell are core; only points of light cells are counted,
    # and a light cell holds fewer than min_samples of them
    heavy = all_cells.filter(F.col("w") >= min_samples).select("cy", "cx")
    light_points = keyed.join(heavy, ["cy", "cx"], "left_anti")
    around = weight_within(point_pairs(light_points, all_cells, grid), keyed, ["first_id"], eps, min_samples)
    light_core = light_points.join(around.filter(F.col("total") >= min_samples), "first_id", "left_semi")
    core = cut(keyed.join(heavy, ["cy", "cx"], "left_semi").unionByName(light_core))

    # core points of one cell are within eps of each other, so cells are the nodes
    core_cells = cut(cells(core, F.min("first_id").alias("node"), *corner_points()))
    edges = linked_cells(core_cells, core, grid, "node")
    components = connected_components(core_cells, edges)
    # one row per cluster
    labels = numbered(components, "component", "label")
    cell_labels = cut(
        core_cells.join(components, "node").join(labels, "component").select("cy", "cx", "label", "node")
    )

    rest = keyed.join(core.select("first_id"), "first_id", "left_anti")
    reached = weight_within(
        point_pairs(rest, core_cells, grid).join(
            cell_labels.select(F.col("cy").alias("r_y"), F.col("cx").alias("r_x"), "label"), ["r_y", "r_x"]
        ),
        core, ["first_id", "label"], eps, 1,
    )
    border = reached.groupBy("first_id").agg(F.min("label").alias("label"))
    core_labels = core.join(cell_labels, ["cy", "cx"]).select("latitude", "longitude", "label")
    other_labels = rest.join(border, "first_id", "left").select(
        "latitude", "longitude", F.coalesce("label", F.lit(-1)).alias("label")
    )
    return core_labels.unionByName(other_labels)


def dbscan(
    df: DataFrame,
    eps: float = config.CLUSTER.eps_metres,
    min_samples: int = config.CLUSTER.min_samples,
    id_col: str = "id",
    out: str = "dbscan_label",
) -> DataFrame:
    """Add the cluster number of each row. Row order is the order of ``id_col``."""
    points = cut(distinct_points(df, id_col))
    labels = cluster_points(points, eps, min_samples).withColumnRenamed("label", out)
    return lookup_join(df, labels, ["latitude", "longitude"])


def drop_noise(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) != -1)

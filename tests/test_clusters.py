"""Neighbourhoods, density clustering and K-Means against brute force."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import kmeans, neighbours, quality
from streetlens.operators.components import connected_components
from streetlens.operators.dbscan import dbscan
from streetlens.operators.neighbours import eps_neighbours
from streetlens.plans import train
from streetlens.operators.numbering import numbered

R = config.EARTH_RADIUS_M


def distances(lat, lng):
    a, b = np.radians(lat), np.radians(lng)
    h = np.sin((a[:, None] - a) / 2) ** 2 + np.cos(a[:, None]) * np.cos(a) * np.sin((b[:, None] - b) / 2) ** 2
    return 2 * R * np.arcsin(np.sqrt(np.minimum(h, 1)))


def brute_dbscan(near, min_samples):
    n = len(near)
    core = near.sum(1) >= min_samples
    label, current = np.full(n, -1), 0
    for i in range(n):
        if not core[i] or label[i] != -1:
            continue
        stack, label[i] = [i], current
        while stack:
            p = stack.pop()
            if not core[p]:
                continue
            for q in np.flatnonzero(near[p] & (label == -1)):
                label[q] = current
                stack.append(q)
        current += 1
    return label


def frame(spark, lat, lng):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lng))], "id long, latitude double, longitude double")


def city(seed, n=400):
    """Two dense spots, one of them mostly copies of one point, and scatter between them."""
    rng = np.random.default_rng(seed)
    third = n // 3
    lat = np.concatenate([np.full(third // 2, 53.38), rng.normal(53.38, 0.0006, third - third // 2),
                          rng.normal(53.385, 0.0008, third), rng.uniform(53.37, 53.39, n - 2 * third)])
    lng = np.concatenate([np.full(third // 2, -1.47), rng.normal(-1.47, 0.001, third - third // 2),
                          rng.normal(-1.462, 0.0015, third), rng.uniform(-1.48, -1.455, n - 2 * third)])
    order = rng.permutation(n)
    return lat[order], lng[order]


@pytest.mark.parametrize("eps,few", [(150.0, 64), (150.0, 1)])
def test_neighbour_counts(spark, monkeypatch, eps, few):
    """Also with cells that descend the tree down to single points."""
    monkeypatch.setattr(neighbours, "FEW", few)
    lat, lng = city(1)
    want = {(a, b): int(c) for a, b, c in zip(lat, lng, (distances(lat, lng) <= eps).sum(1))}
    out = eps_neighbours(frame(spark, lat, lng), eps).collect()
    assert {(r["latitude"], r["longitude"]): r["neighbours"] for r in out} == want


def test_neighbours_across_the_date_line(spark):
    rng = np.random.default_rng(2)
    lat = rng.uniform(-0.02, 0.02, 80)
    lng = np.concatenate([rng.uniform(179.98, 180, 40), rng.uniform(-180, -179.98, 40)])
    want = {(a, b): int(c) for a, b, c in zip(lat, lng, (distances(lat, lng) <= 900).sum(1))}
    out = eps_neighbours(frame(spark, lat, lng), 900.0).collect()
    assert {(r["latitude"], r["longitude"]): r["neighbours"] for r in out} == want


@pytest.mark.parametrize("south", [False, True])
def test_neighbours_at_all_latitudes(spark, south):
    """From the pole itself to the equator, over the date line and over the pole."""
    rng = np.random.default_rng(5)
    lat = np.concatenate([[90.0, 90.0], 90 - np.abs(rng.normal(0, 0.012, 120)), rng.uniform(79.98, 80.0, 60), rng.uniform(-0.01, 0.01, 60)])
    lng = np.concatenate([[0.0, 77.0], rng.uniform(-180, 180, 120), 179.95 + rng.uniform(0, 0.1, 60), rng.uniform(0, 0.02, 60)])
    lat, lng = -lat if south else lat, np.where(lng > 180, lng - 360, lng)
    near = distances(lat, lng) <= 700.0
    want = {(a, b): int(c) for a, b, c in zip(lat, lng, near.sum(1))}
    out = eps_neighbours(frame(spark, lat, lng), 700.0).collect()
    assert {(r["latitude"], r["longitude"]): r["neighbours"] for r in out} == want
    labels = [r["dbscan_label"] for r in dbscan(frame(spark, lat, lng), 700.0, 4).orderBy("id").collect()]
    assert labels == brute_dbscan(near, 4).tolist()


def test_a_point_at_the_pole_widens_nothing(spark):
    lat, lng = city(1, 60)
    grid = neighbours.CellGrid.of(150.0)

    def met(frame_):
        keyed = grid.keyed(neighbours.distinct_points(frame_))
        cell = [neighbours.level_key(F.col(c), 0) for c in ("iy", "ix")]
        rows = keyed.select("latitude", "longitude", "iy", "ix", F.size(grid.near(*cell)).alias("many")).collect()
        return {(r["latitude"], r["longitude"]): (r["iy"], r["ix"], r["many"]) for r in rows}

    alone, beside = met(frame(spark, lat, lng)), met(frame(spark, np.append(lat, 89.99), np.append(lng, 3.0)))
    assert all(beside[k] == v for k, v in alone.items()) and max(v[2] for v in alone.values()) <= 35
    assert max(v[2] for v in beside.values()) <= 60


@pytest.mark.parametrize("seed,eps,min_samples,few", [(1, 60.0, 8, 64), (2, 120.0, 25, 3), (3, 35.0, 4, 64)])
def test_dbscan(spark, monkeypatch, seed, eps, min_samples, few):
    monkeypatch.setattr(neighbours, "FEW", few)
    lat, lng = city(seed)
    want = brute_dbscan(distances(lat, lng) <= eps, min_samples)
    out = dbscan(frame(spark, lat, lng), eps, min_samples).orderBy("id").collect()
    assert [r["dbscan_label"] for r in out] == want.tolist()
    assert (want == -1).any() and want.max() >= 1


def test_long_chain_is_one_component(spark):
    nodes = spark.range(200).withColumnRenamed("id", "node")
    edges = spark.range(199).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).filter("a <> 99")
    out = {r["component"]: r["count"] for r in connected_components(nodes, edges).groupBy("component").count().collect()}
    assert out == {0: 100, 100: 100}


def test_shuffled_chain_settles_in_few_rounds(spark, monkeypatch):
    from streetlens.operators import components

    rounds = []
    monkeypatch.setattr(components, "_small_star", lambda e, plain=components._small_star: (rounds.append(1), plain(e))[1])
    ids = np.random.default_rng(1).permutation(10_000).tolist()
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    out = connected_components(spark.range(10_000).withColumnRenamed("id", "node"), edges)
    assert out.filter("component <> 0").count() == 0 and out.count() == 10_000
    assert len(rounds) < 30


def test_numbering_in_ranges(spark):
    keys = spark.createDataFrame([(f"k{n % 500:04d}",) for n in range(1500)], "key string")
    got = sorted((r["key"], r["n"]) for r in numbered(keys, "key", "n").collect())
    assert got == [(f"k{n:04d}", n) for n in range(500)]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    lat = np.concatenate([rng.normal(53.38, 0.01, 200), rng.normal(53.42, 0.01, 200)])
    lng = np.concatenate([rng.normal(-1.47, 0.01, 200), rng.normal(-1.43, 0.01, 200)])
    return frame(spark, lat, lng).withColumns({
        "month": F.lit("2024-01"), "category": F.when(F.col("id") % 2 == 0, "robbery").otherwise("drugs")}).persist()


def test_kmeans_sweep(blobs):
    sweep = kmeans.kmeans_sweep(blobs, replace(config.CLUSTER, k_min=2, k_max=4, restarts=2))
    rows = sweep.table.orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4] and sweep.best_k == 2
    assert all(-1 <= r["silhouette"] <= 1 for r in rows)
    assert rows[0]["inertia"] > rows[1]["inertia"] > rows[2]["inertia"]
    assert kmeans.with_kmeans_labels(blobs, sweep).filter("kmeans_label IS NULL").count() == 0
    assert {r["silhouette_kind"] for r in rows} == {"linear"}
    exact = kmeans.kmeans_sweep(blobs, replace(config.CLUSTER, k_min=2, k_max=3, restarts=1, silhouette="exact"))
    assert exact.best_k == 2 and {r["silhouette_kind"] for r in exact.table.collect()} == {"exact"}
    with pytest.raises(ValueError):
        kmeans.kmeans_sweep(blobs, replace(config.CLUSTER, silhouette="best"))


def test_cluster_run_saves_everything(spark, blobs, tmp_path):
    settings = replace(config.CLUSTER, k_min=2, k_max=3, restarts=1, eps_metres=2000.0, min_samples=10)
    run = train.cluster_run(blobs, settings, str(tmp_path))
    assert run.labels.count() == 400
    row = run.density_scores.first()
    assert row["clusters"] >= 1
    assert spark.read.parquet(str(tmp_path / "cluster_labels")).filter("kmeans_label IS NULL").count() == 0
    from streetlens.sources import models, results

    assert results.read_result_csv(spark, str(tmp_path / "kmeans_sweep"), "kmeans_sweep").count() == 2
    facts = {r["name"]: r["value"] for r in models.load_facts(spark, str(tmp_path / "models/clusters")).collect()}
    assert facts["kmeans_n"] == "2" and facts["min_samples"] == "10"


def lloyd(xy, w, centres):
    for _ in range(300):
        label = ((xy[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        moved = np.array([np.average(xy[label == c], axis=0, weights=w[label == c]) if (label == c).any() else centres[c] for c in range(len(centres))])
        if np.abs(moved - centres).max() < 1e-9:
            break
        centres = moved
    return ((xy[:, None] - centres[None]) ** 2).sum(-1).min(1) @ w


def test_all_fits_side_by_side(spark):
    rng = np.random.default_rng(4)
    hubs = rng.uniform(-5, 5, (6, 2))
    xy = np.concatenate([h + rng.normal(0, 0.2, (60, 2)) for h in hubs])
    w = rng.integers(1, 9, len(xy))
    points = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(xy, w)], "x double, y double, w long").repartition(5)
    fits = kmeans.fit_all(points, range(2, 8), 4, 42)
    assert sorted((f.k, f.start) for f in fits) == [(k, s) for k in range(2, 8) for s in range(4)]
    assert all(f.centres.shape == (f.k, 2) for f in fits)
    for f in fits:  # each has settled: plain rounds from its centres win nothing more
        assert lloyd(xy, w, f.centres) == pytest.approx(f.inertia, rel=1e-3)
    best = kmeans.best_fits(fits)
    assert best[6].inertia == pytest.approx(lloyd(xy, w, hubs), rel=1e-6)
    again = kmeans.best_fits(kmeans.fit_all(points.repartition(2), range(2, 8), 4, 42))
    assert {k: round(f.inertia, 6) for k, f in again.items()} == {k: round(f.inertia, 6) for k, f in best.items()}
    for k, (silhouette, bouldin) in kmeans._linear_scores(points, best).items():
        labelled = quality.nearest_centroid(points, [tuple(c) for c in best[k].centres.tolist()]).select("x", "y", "w", "label")
        assert silhouette == pytest.approx(quality.silhouette_fast(labelled).first()[0], rel=1e-9)
        assert bouldin == pytest.approx(quality.davies_bouldin(labelled).first()[0], rel=1e-9)


def test_fewer_points_than_centres(spark):
    points = spark.createDataFrame([(0.0, 0.0, 5), (1.0, 0.0, 1), (0.0, 0.0, 2)], "x double, y double, w long")
    fits = kmeans.fit_all(points, [4], 2, 1)
    assert [len(f.centres) for f in fits] == [2, 2] and all(f.inertia == 0 for f in fits)
    assert kmeans.fit_all(points.limit(0), [3], 2, 1) == []


def test_a_stored_labelling_labels_places(spark, blobs, tmp_path):
    from streetlens.sources import models

    points = kmeans.prepared_points(blobs)
    fit = kmeans.best_fits(kmeans.fit_all(points, [3], 2, 7))[3]
    models.save_models(spark, {"kmeans": kmeans.kmeans_model(points, fit)}, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"), "kmeans").transform(blobs)
    want = {(r["latitude"], r["longitude"]): r["label"] for r in quality.nearest_centroid(points, [tuple(c) for c in fit.centres.tolist()]).collect()}
    assert all(want[r["latitude"], r["longitude"]] == r["prediction"] for r in again.collect())

"""Splits, samples, rates and scores against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetlens.operators import metrics, priors, quality, sampling
from streetlens.operators.plane_tree import PlaneTree, cell


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    return spark.createDataFrame(
        [(int(i) * 37, int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for i in range(997)], "id long, is_violent int, score double").persist()


def key(i, seed=42):
    return ((i % 1000003) * 7919 + seed) % 1000003, i


def test_split_takes_the_first_fifth_of_each_class(labelled):
    rows = sampling.stratified_split(labelled).collect()
    for c in (0, 1):
        members = sorted((key(r["id"]), r["is_test"]) for r in rows if r["is_violent"] == c)
        n = int(0.2 * len(members) + 0.5)
        assert [t for _, t in members] == [1] * n + [0] * (len(members) - n)


def test_equal_hashes_are_split_by_id(spark):
    # ids a whole cycle apart share one scattered value
    df = spark.createDataFrame([(5 + 1000003 * i, 1) for i in range(10)], "id long, is_violent int")
    test = sampling.stratified_split(df).filter("is_test = 1").orderBy("id").collect()
    assert [r["id"] for r in test] == [5, 5 + 1000003]


def test_folds_partition_each_class(labelled):
    counts = sampling.stratified_folds(labelled).groupBy("is_violent", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in sorted(counts, key=lambda r: r["fold"]) if r["is_violent"] == c]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_samples(labelled):
    assert sampling.sample_n(labelled, 100).count() == 100
    assert sampling.sample_n(labelled, 5000).count() == 997
    out = sampling.stratified_sample(labelled, 200)
    share = labelled.agg(F.avg("is_violent")).first()[0]
    assert out.count() == 200 and out.agg(F.sum("is_violent")).first()[0] == round(200 * share)
    assert sampling.stratified_sample(labelled, 2000).count() == 997


def test_rates_smooth_towards_the_mean_and_fall_back(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), (None, 1)], "k string, is_violent int")
    table = {r["k"]: r["rate"] for r in priors.rate_table(df, ["k"], 2).collect()}
    assert table == pytest.approx({"a": (2 + 2 * 0.75) / 4, "b": (0 + 2 * 0.75) / 3})
    seen = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    out = priors.map_rate(seen, priors.rate_table(df, ["k"], 0), ["k"], {"rate": F.lit(0.5)}).collect()
    assert {r["k"]: r["rate"] for r in out} == {"a": 1.0, "z": 0.5, None: 0.5}


def brute_auc(labels, scores):
    pos, neg = [s for y, s in zip(labels, scores) if y], [s for y, s in zip(labels, scores) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("slices", [2, 7, 256])
def test_auc_with_ties(labelled, slices):
    rows = labelled.collect()
    want = brute_auc([r["is_violent"] for r in rows], [r["score"] for r in rows])
    got = metrics.roc_auc(labelled, label="is_violent", slices=slices).first()["roc_auc"]
    assert got == pytest.approx(want)


def test_auc_of_one_class_is_undefined(labelled):
    assert metrics.roc_auc(labelled.filter("is_violent = 1"), label="is_violent").first()["roc_auc"] is None


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.confusion_metrics(df).first()
    assert tuple(row) == (0.5, 0.0, 0.0, 0.0)


def test_mae_pct_is_nan_without_a_positive_mean(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "y double, yhat double")
    assert np.isnan(metrics.mae_pct_of_mean(df).first()["mae_pct_of_mean"])


def test_best_by_score_first_wins_and_nan_never(spark):
    df = spark.createDataFrame([(3, 0.5), (4, 0.7), (5, 0.7), (6, float("nan")), (7, None)], "k int, s double")
    assert metrics.best_by_score(df, "k", "s", "k", True).first()["k"] == 4


def points(spark, seed=0, n=60):
    rng = np.random.default_rng(seed)
    return [(float(x), float(y), int(w), int(c)) for x, y, w, c in zip(
        rng.normal(size=n), rng.normal(size=n), rng.integers(1, 4, n), rng.integers(0, 4, n))]


@pytest.mark.parametrize("rows_per_block", [8, 512])
def test_silhouettes_and_davies_bouldin(spark, rows_per_block):
    rows = [*points(spark), (9.0, 9.0, 1, 9)]
    df = spark.createDataFrame(rows, "x double, y double, w int, label int")
    flat = np.array([(x, y) for x, y, w, _ in rows for _ in range(w)])
    lab = np.array([c for _, _, w, c in rows for _ in range(w)])

    def silhouette(dist):
        out = []
        for i in range(len(flat)):
            own = (lab == lab[i]).sum()
            if own == 1:
                out.append(0.0)
                continue
            a = dist[i, lab == lab[i]].sum() / (own - 1)
            b = min(dist[i, lab == c].mean() for c in set(lab) - {lab[i]})
            out.append((b - a) / max(a, b))
        return np.mean(out)

    gap = flat[:, None] - flat[None]
    squared = (gap**2).sum(-1)
    assert quality.silhouette_exact(df, rows_per_block=rows_per_block).first()[0] == pytest.approx(silhouette(np.sqrt(squared)))
    for tolerance in (0.0, 0.05):
        bound = 1e-12 + 2 * tolerance / (1 - tolerance)
        assert quality.silhouette_within(df, tolerance).first()[0] == pytest.approx(silhouette(np.sqrt(squared)), abs=bound)
    assert quality.silhouette_fast(df, rows_per_block=rows_per_block // 4).first()[0] == pytest.approx(silhouette(squared), abs=1e-9)
    centres = {c: flat[lab == c].mean(0) for c in set(lab)}
    spread = {c: np.linalg.norm(flat[lab == c] - centres[c], axis=1).mean() for c in centres}
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in centres if j != i) for i in centres]
    assert quality.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))


def places(spark, n, seed=0, spread=0.4):
    """Six clusters in clouds of their own, the last one beyond a wide gap."""
    rng = np.random.default_rng(seed)
    hubs = np.array([(0, 0), (3, 1), (1, 4), (5, 5), (4, 2), (40, -30.0)])
    label = rng.integers(0, len(hubs), n)
    xy = hubs[label] + rng.normal(0, spread, (n, 2))
    return spark.createDataFrame([(float(x), float(y), 1, int(c)) for (x, y), c in zip(xy, label)], "x double, y double, w int, label int").repartition(8)


def test_work_of_the_silhouette_tree_grows_slowly(spark):
    def work(n):
        df = places(spark, n)
        tree = PlaneTree.around(df)
        keyed = tree.keyed(df).persist()
        total = 0
        for kind, level, pairs in quality._far_and_near(keyed, tree, 0.01):
            nx, ny = cell(level)
            sizes = keyed.groupBy(nx.alias("l_nx"), ny.alias("l_ny")).agg(F.count("x").alias("l_n"))
            weight = F.col("l_n") * (F.lit(1) if kind == "far" else F.col("r_n"))
            total += pairs.join(sizes, ["l_nx", "l_ny"]).agg(F.sum(weight)).first()[0] or 0
        keyed.unpersist()
        return total

    small, large = work(4_000), work(32_000)
    assert large < small * 8**1.5 and large < 32_000**2 / 10


def test_silhouette_tree_near_the_exact_one(spark):
    df = places(spark, 1_500, 3, 1.2).persist()
    exact = quality.silhouette_exact(df).first()[0]
    assert quality.silhouette_within(df, 0.01).first()[0] == pytest.approx(exact, abs=0.0203)
    assert quality.silhouette_within(df.filter("label = 0")).first()[0] is None
    assert quality.silhouette_within(df.limit(0)).first()[0] is None
    same = spark.createDataFrame([(1.0, 1.0, 3, 0), (1.0, 1.0, 2, 1)], "x double, y double, w int, label int")
    assert quality.silhouette_within(same).first()[0] == quality.silhouette_exact(same).first()[0] == 0.0


@pytest.mark.parametrize("wide", [False, True])
def test_worst_neighbours_are_searched_with_bounds(spark, monkeypatch, wide):
    """Also with one cluster so wide that it is everyone's worst neighbour, and two with one centre."""
    rng = np.random.default_rng(7)
    c = np.vstack([rng.uniform(0, 100, (800, 2)), rng.normal(50, 1e-3, (40, 2)), [[20.0, 20.0], [20.0, 20.0]]])
    s = rng.uniform(0.1, 1, len(c))
    if wide:
        s[5] = 500.0
    d = np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1))
    with np.errstate(divide="ignore"):
        want = np.where(d > 0, (s[:, None] + s[None]) / d, -1).max(1)
    rows = [(k, float(x), float(y), float(v)) for k, ((x, y), v) in enumerate(zip(c, s))]
    met = []
    monkeypatch.setattr(quality, "written", lambda df, name, plain=quality.written: (met.append(plain(df, name)), met[-1])[1])
    got = {r["label"]: r["r"] for r in quality._worst_neighbour(spark.createDataFrame(rows, "label int, x double, y double, s double")).collect()}
    assert [got[k] for k in range(len(c))] == pytest.approx(want.tolist(), rel=1e-9)
    assert sum(df.count() for df in met if "_high" in df.columns) < len(c) ** 2 / 2


def test_a_single_cluster_scores_zero(spark):
    one = spark.createDataFrame([(0.0, 0.0, 1, 0), (1.0, 0.0, 1, 0)], "x double, y double, w int, label int")
    assert quality.davies_bouldin(one).first()[0] == 0.0
    assert quality.davies_bouldin(one.limit(0)).first()[0] is None

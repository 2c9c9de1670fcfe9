"""K-Means over a range of k on distinct weighted points, all fits side by side.

One pass over the points serves every fit, a fit being a k and a start: its
centres go with the pass, its sums per centre come back. There are as many
centres and sums as the settings say, whatever the number of points. Starts
are found by k-means||: a first point, two rounds that add points by their
weighted distance from the centres so far, and a weighted choice among these.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetlens import config
from streetlens.operators import quality
from streetlens.operators.joins import lookup_join
from streetlens.operators.neighbours import distinct_points
from streetlens.session import cut

ROUNDS = 2  # of adding points for a start
ADDED = 2  # points added in a round, times k
MAX_ROUNDS, TOLERANCE = 300, 1e-4
SUMS = "fit int, centre int, w double, wx double, wy double, ss double, cost double"


@dataclass(frozen=True)
class Fit:
    """One clustering: its centres in z-scores, and the sum of squared distances to them."""

    k: int
    start: int
    centres: np.ndarray
    inertia: float
    rounds: int


@dataclass
class Sweep:
    """Outcome of a sweep: the score table, the best model and its points with labels."""

    table: DataFrame
    best_k: int
    model: Transformer
    labels: DataFrame


def prepared_points(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct coordinates with weight w and z-scores x and y."""
    points = cut(distinct_points(df, id_col)).withColumns({"x": F.col("latitude"), "y": F.col("longitude")})
    return cut(quality.standardise(points, ["x", "y"], "w"))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.column_stack([batch["x"].to_numpy(), batch["y"].to_numpy()]), batch["w"].to_numpy().astype(float)


def _nearest(xy: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gaps = ((xy[:, None] - centres[None]) ** 2).sum(-1)
    label = gaps.argmin(axis=1)
    return label, gaps[np.arange(len(xy)), label]


def _scattered(xy: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each point, which follows from the point and the salt alone."""
    bits = (xy + 0.0).view(np.uint64)
    with np.errstate(over="ignore"):
        h = bits[:, 0] * np.uint64(0x9E3779B97F4A7C15) + bits[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt * 0x165667B19E3779F9 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def centre_sums(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each fit (centres, 5): weight, sums of x, y, of squares, and of squared distances, of the points nearest to each centre.

    Added up in every partition and then by Spark; as many rows reach the driver as there are centres.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {f: np.zeros((len(c), 5)) for f, c in centres.items()}
        for batch in batches:
            xy, w = _arrays(batch)
            values = np.column_stack([w, w * xy[:, 0], w * xy[:, 1], w * (xy**2).sum(axis=1)])
            for f, c in centres.items():
                label, gap = _nearest(xy, c)
                for i, v in enumerate([*values.T, w * gap]):
                    total[f][:, i] += np.bincount(label, v, len(c))
        fit = np.concatenate([np.full(len(t), f) for f, t in total.items()])
        centre = np.concatenate([np.arange(len(t)) for t in total.values()])
        sums = np.concatenate(list(total.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fit.astype(np.int32)), pa.array(centre.astype(np.int32)), *(pa.array(s) for s in sums.T.copy())],
            names=["fit", "centre", "w", "wx", "wy", "ss", "cost"],
        )

    names = ["w", "wx", "wy", "ss", "cost"]
    rows = points.select("x", "y", "w").mapInArrow(run, SUMS).groupBy("fit", "centre").agg(*(F.sum(n).alias(n) for n in names)).collect()
    out = {f: np.zeros((len(c), 5)) for f, c in centres.items()}
    for r in rows:
        out[r["fit"]][r["centre"]] = [r[n] for n in names]
    return out


def _added(points: DataFrame, centres: dict[int, np.ndarray], many: dict[int, int], seed: int, turn: int) -> dict[int, np.ndarray]:
    """For each fit some points, drawn without replacement by weight times squared distance from the centres (by weight if there are none)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xy, w = _arrays(batch)
            for f, c in centres.items():
                share = w * _nearest(xy, c)[1] if len(c) else w
                with np.errstate(divide="ignore"):
                    key = -np.log(_scattered(xy, seed * 1_000_003 + f * 101 + turn)) / share
                best = np.argsort(key, kind="stable")[: many[f]]
                best = best[np.isfinite(key[best])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), f, np.int32)), pa.array(key[best]), pa.array(xy[best, 0]), pa.array(xy[best, 1])],
                    names=["fit", "key", "x", "y"],
                )

    order = Window.partitionBy("fit").orderBy("key", "x", "y")
    found = points.select("x", "y", "w").mapInArrow(run, "fit int, key double, x double, y double")
    most = max(many.values())
    rows = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most).collect()
    out: dict[int, list] = {f: [] for f in centres}
    for r in sorted(rows, key=lambda r: (r["fit"], r["_rank"])):
        if r["_rank"] <= many[r["fit"]]:
            out[r["fit"]].append((r["x"], r["y"]))
    return {f: np.array(v, dtype=float).reshape(-1, 2) for f, v in out.items()}


def _chosen(candidates: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates, each drawn by its distance from those before."""
    candidates, weight = candidates[weight > 0], weight[weight > 0]
    picked = [int(rng.choice(len(candidates), p=weight / weight.sum()))] if len(candidates) else []
    while picked and len(picked) < k:
        share = weight * _nearest(candidates, candidates[picked])[1]
        if not share.sum() > 0:  # fewer distinct points than centres
            break
        picked.append(int(rng.choice(len(candidates), p=share / share.sum())))
    return candidates[picked]


def fit_all(points: DataFrame, sizes: Iterable[int], starts: int, seed: int) -> list[Fit]:
    """Every k of ``sizes`` from ``starts`` starts, settled together; fits that have settled drop out of later passes.

    ``points`` has x, y and w. A k above the number of distinct points gives as
    many centres as there are points. No point gives no fit.
    """
    kinds = [(k, s) for k in sizes for s in range(starts)]
    size = {f: k for f, (k, _) in enumerate(kinds)}
    found = _added(points, {f: np.zeros((0, 2)) for f in size}, dict.fromkeys(size, 1), seed, 0)
    found = {f: c for f, c in found.items() if len(c)}
    if not found:
        return []
    for turn in range(1, ROUNDS + 1):
        more = _added(points, found, {f: ADDED * size[f] for f in found}, seed, turn)
        found = {f: np.concatenate([c, more[f]]) for f, c in found.items()}
    weights = centre_sums(points, found)
    centres = {
        f: _chosen(c, weights[f][:, 0], size[f], np.random.default_rng([seed, kinds[f][0], kinds[f][1]])) for f, c in found.items()
    }
    live, rounds = dict(centres), dict.fromkeys(centres, 0)
    for _ in range(MAX_ROUNDS):
        for f, total in centre_sums(points, live).items():
            weight = total[:, :1]
            moved = np.where(weight > 0, total[:, 1:3] / np.where(weight > 0, weight, 1), live[f])
            rounds[f] += 1
            if (((moved - live[f]) ** 2).sum(axis=1) <= TOLERANCE**2).all():
                del live[f]
            else:
                live[f] = moved
            centres[f] = moved
        if not live:
            break
    final = centre_sums(points, centres)
    return [Fit(*kinds[f], c, float(final[f][:, 4].sum()), rounds[f]) for f, c in centres.items()]


def best_fits(fits: Iterable[Fit]) -> dict[int, Fit]:
    """Of each k the fit of least inertia, the first start on a tie."""
    best: dict[int, Fit] = {}
    for f in fits:
        if f.k not in best or (f.inertia, f.start) < (best[f.k].inertia, best[f.k].start):
            best[f.k] = f
    return best


def _linear_scores(points: DataFrame, best: dict[int, Fit]) -> dict[int, tuple[float | None, float | None]]:
    """For each k the silhouette on squared distances and the Davies-Bouldin score, in two passes for all k.

    What a point needs of a cluster is its weight, sums and sum of squares.
    """
    centres = {k: f.centres for k, f in best.items()}
    stats = centre_sums(points, centres)
    means = {k: s[:, 1:3] / np.where(s[:, :1] > 0, s[:, :1], 1) for k, s in stats.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((len(c), 2)) for k, c in centres.items()}
        for batch in batches:
            xy, w = _arrays(batch)
            for k, c in centres.items():
                label, _ = _nearest(xy, c)
                n, sx, sy, ss = stats[k][:, :4].T
                squares = (xy**2).sum(axis=1)[:, None]
                reach = np.maximum(n * squares - 2 * (xy[:, :1] * sx + xy[:, 1:] * sy) + ss, 0)
                rows = np.arange(len(xy))
                own = n[label]
                a = np.where(own > 1, reach[rows, label] / np.where(own > 1, own - 1, 1), np.nan)
                other = np.where(n > 0, reach / np.where(n > 0, n, 1), np.inf)
                other[rows, label] = np.inf
                b = other.min(axis=1)
                top = np.maximum(a, b)
                with np.errstate(invalid="ignore"):
                    score = np.where(np.isfinite(a) & np.isfinite(b) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)
                away = np.sqrt(((xy - means[k][label]) ** 2).sum(axis=1))
                total[k][:, 0] += np.bincount(label, w * score, len(c))
                total[k][:, 1] += np.bincount(label, w * away, len(c))
        for k, t in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(t), k, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)), pa.array(t[:, 0].copy()), pa.array(t[:, 1].copy())],
                names=["fit", "centre", "score", "away"],
            )

    scored = {k: np.zeros((len(c), 2)) for k, c in centres.items()}
    for r in points.select("x", "y", "w").mapInArrow(run, "fit int, centre int, score double, away double").groupBy("fit", "centre").agg(
        F.sum("score").alias("score"), F.sum("away").alias("away")
    ).collect():
        scored[r["fit"]][r["centre"]] = r["score"], r["away"]
    out = {}
    for k, s in scored.items():
        there = stats[k][:, 0] > 0
        weight, mean = stats[k][there, 0], means[k][there]
        spread = s[there, 1] / weight
        gap = np.sqrt(((mean[:, None] - mean[None]) ** 2).sum(-1))
        with np.errstate(divide="ignore", invalid="ignore"):
            worst = np.where(gap > 0, (spread[:, None] + spread[None]) / gap, 0.0).max(axis=1)
        out[k] = (float(s[there, 0].sum() / weight.sum()) if len(weight) > 1 else None, float(worst.mean()))
    return out


def _number(x: float) -> str:
    return f"cast('{float(x)!r}' as double)"


def labelling(fit: Fit, means: tuple[float, float], spreads: tuple[float, float]) -> Transformer:
    """A Spark ML transformer that adds ``prediction``, the nearest centre of latitude and longitude; it can be saved and loaded."""
    x, y = (
        f"(({c} - {_number(m)}) / {_number(s)})" if s > 0 else _number(0.0) for c, m, s in zip(("latitude", "longitude"), means, spreads)
    )
    gaps = ", ".join(
        f"struct(({x} - {_number(cx)}) * ({x} - {_number(cx)}) + ({y} - {_number(cy)}) * ({y} - {_number(cy)}) as d, {i} as i)"
        for i, (cx, cy) in enumerate(fit.centres)
    )
    return SQLTransformer(statement=f"SELECT *, array_min(array({gaps})).i AS prediction FROM __THIS__")


def _scale(points: DataFrame) -> tuple[tuple[float, float], tuple[float, float]]:
    """Weighted means and population deviations of latitude and longitude."""
    w = F.col("w")
    row = points.agg(*((F.sum(F.col(c) * w) / F.sum(w)).alias(c) for c in ("latitude", "longitude"))).first()
    means = (row["latitude"], row["longitude"])
    row = points.agg(*(
        F.sqrt(F.sum((F.col(c) - m) ** 2 * w) / F.sum(w)).alias(c) for c, m in zip(("latitude", "longitude"), means)
    )).first()
    return means, (row["latitude"], row["longitude"])


def kmeans_model(points: DataFrame, fit: Fit) -> Transformer:
    """The labelling of a fit to ``prepared_points``."""
    return labelling(fit, *_scale(points))


def kmeans_sweep(
    df: DataFrame,
    settings: config.ClusterSettings = config.CLUSTER,
    id_col: str = "id",
) -> Sweep:
    """Fit k_min .. k_max from ``restarts`` starts each, score the best of each k, keep the best silhouette (the smaller k on a tie).

    Copies of a coordinate are one weighted point: the same clustering from far
    fewer rows. ``settings.silhouette`` tells which silhouette scores all k,
    whatever the number of points; the table names it. The exact one grows with
    the square of the distinct points.
    """
    if settings.silhouette not in ("linear", "exact"):
        raise ValueError(f"silhouette must be linear or exact, not {settings.silhouette!r}")
    points = prepared_points(df, id_col).persist()
    best = best_fits(fit_all(points, range(settings.k_min, settings.k_max + 1), settings.restarts, settings.seed))
    if not best:
        raise ValueError("there is no point to cluster")
    scores = _linear_scores(points, best)
    rows = []
    for k, f in sorted(best.items()):
        silhouette, bouldin = scores[k]
        if settings.silhouette == "exact":
            silhouette = quality.silhouette_exact(
                quality.nearest_centroid(points, [tuple(c) for c in f.centres.tolist()]).select("x", "y", "w", "label")
            ).first()["silhouette"]
        rows.append((k, silhouette, bouldin, f.inertia, settings.silhouette))
    table = df.sparkSession.createDataFrame(rows, "k int, silhouette double, davies_bouldin double, inertia double, silhouette_kind string")
    best_k = max(rows, key=lambda row: (row[1] if row[1] is not None else float("-inf"), -row[0]))[0]
    model = kmeans_model(points, best[best_k])
    labels = cut(model.transform(points.select("latitude", "longitude")).withColumnRenamed("prediction", "kmeans_label"))
    points.unpersist()
    return Sweep(table, best_k, model, labels)


def with_kmeans_labels(df: DataFrame, sweep: Sweep) -> DataFrame:
    return lookup_join(df, sweep.labels, ["latitude", "longitude"])

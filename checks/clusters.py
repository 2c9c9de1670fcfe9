"""Checks of neighbourhoods and clusterings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.base import WITH_CLEAN, check, cleaned, on
from streetlens.operators import dbscan as db
from streetlens.operators import kmeans as km
from streetlens.operators import quality
from streetlens.operators.neighbours import eps_neighbours as neighbours
from streetlens.plans import dashboard
from streetlens.session import scratch_path
from streetlens.sources import results


def r(c, digits=6):
    return F.round(c, digits)


def near_sql(eps: float) -> str:
    return f"""pt AS (SELECT latitude, longitude, count(*) AS w, min(id) AS first_id FROM cl GROUP BY 1, 2),
near AS (SELECT p.first_id AS a, q.first_id AS b, q.w AS w FROM pt p, pt q WHERE 2 * 6371000.0::DOUBLE * asin(sqrt(
  pow(sin(radians(q.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude)) * cos(radians(q.latitude))
  * pow(sin(radians(q.longitude - p.longitude) / 2), 2))) <= {eps}::DOUBLE)"""


@check("eps_neighbours", on(WITH_CLEAN, """SELECT latitude, longitude, pt.w, CAST(sum(near.w) AS BIGINT) AS neighbours FROM pt
  JOIN near ON near.a = pt.first_id GROUP BY ALL""", near_sql(60)))
def eps_neighbours(spark, folder):
    return neighbours(cleaned(spark, folder), 60.0)


def dbscan_sql(eps: float, min_samples: int) -> str:
    return on(
        WITH_CLEAN.replace("WITH ", "WITH RECURSIVE ", 1),
        """SELECT id, CAST(coalesce(cn.label, bd.label, -1) AS INTEGER) AS dbscan_label FROM cl JOIN pt USING (latitude, longitude)
  LEFT JOIN cn ON cn.a = pt.first_id LEFT JOIN bd ON bd.a = pt.first_id""",
        near_sql(eps),
        f"core AS (SELECT a FROM near GROUP BY a HAVING sum(w) >= {min_samples})",
        "link AS (SELECT near.a, near.b FROM near JOIN core USING (a) WHERE near.b IN (SELECT a FROM core))",
        "reach AS (SELECT a, a AS b FROM core UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)",
        "root AS (SELECT a, min(b) AS root FROM reach GROUP BY 1)",
        "cn AS (SELECT a, dense_rank() OVER (ORDER BY root) - 1 AS label FROM root)",
        "bd AS (SELECT near.a, min(cn.label) AS label FROM near JOIN cn ON cn.a = near.b WHERE near.a NOT IN (SELECT a FROM core) GROUP BY 1)",
    )


@check("dbscan", dbscan_sql(250, 25))
def dbscan(spark, folder):
    return db.dbscan(cleaned(spark, folder)).select("id", "dbscan_label")


@check("dbscan_with_border", dbscan_sql(60, 290))
def dbscan_with_border(spark, folder):
    """Settings that leave border and noise points."""
    return db.dbscan(cleaned(spark, folder), 60.0, 290).select("id", "dbscan_label")


# ---- scores on fixed labels: the nearest of eight hub corners -------------------
HUBS = [(53.31 + 0.02 * h, -1.62 + 0.035 * ((h * 5) % 8)) for h in range(8)]
_D = [f"((x - ({a!r})::DOUBLE) * (x - ({a!r})::DOUBLE) + (y - ({b!r})::DOUBLE) * (y - ({b!r})::DOUBLE))" for a, b in HUBS]
ASSIGN = f"CASE least({', '.join(_D)}) " + " ".join(f"WHEN {d} THEN {i}" for i, d in enumerate(_D)) + " END"
ASSIGNED = f"""pts AS (SELECT latitude AS x, longitude AS y, count(*) AS w FROM cl GROUP BY 1, 2),
asg AS (SELECT x, y, w, {ASSIGN} AS label, least({', '.join(_D)}) AS d2 FROM pts),
cen AS (SELECT label, sum(x * w) / sum(w) AS cx, sum(y * w) / sum(w) AS cy, sum(w) AS n FROM asg GROUP BY 1)"""


def _assigned(spark, folder):
    from streetlens.operators.neighbours import distinct_points

    points = distinct_points(cleaned(spark, folder)).withColumns({"x": F.col("latitude"), "y": F.col("longitude")})
    return quality.nearest_centroid(points, HUBS)


@check("nearest_centroid", on(WITH_CLEAN, "SELECT x, y, w, label, round(d2, 9) AS d2 FROM asg", ASSIGNED))
def nearest_centroid(spark, folder):
    return _assigned(spark, folder).select("x", "y", "w", "label", r("d2", 9).alias("d2"))


@check("inertia", on(WITH_CLEAN, """SELECT round(sum(w * (pow(x - cx, 2) + pow(y - cy, 2))), 8) AS inertia FROM asg JOIN cen USING (label)""", ASSIGNED))
def inertia(spark, folder):
    return quality.inertia(_assigned(spark, folder)).select(r("inertia", 8).alias("inertia"))


@check("davies_bouldin", on(WITH_CLEAN, """SELECT round(avg(worst), 6) AS davies_bouldin FROM (SELECT p.label, max((p.s + q.s) / sqrt(pow(p.cx - q.cx, 2) + pow(p.cy - q.cy, 2))) AS worst
  FROM spr p, spr q WHERE p.label <> q.label GROUP BY 1)""", ASSIGNED, """spr AS (SELECT label, cx, cy, sum(w * sqrt(pow(x - cx, 2) + pow(y - cy, 2))) / sum(w) AS s
  FROM asg JOIN cen USING (label) GROUP BY 1, 2, 3)"""))
def davies_bouldin(spark, folder):
    return quality.davies_bouldin(_assigned(spark, folder)).select(r("davies_bouldin").alias("davies_bouldin"))


def silhouette_sql(distance: str) -> list[str]:
    return [
        ASSIGNED,
        f"""tot AS (SELECT p.x, p.y, p.w, p.label, q.label AS other, sum(q.w * {distance}) AS reach, sum(q.w) AS size
  FROM asg p, asg q GROUP BY 1, 2, 3, 4, 5)""",
        """ab AS (SELECT x, y, w, label, max(CASE WHEN other = label AND size > 1 THEN reach / (size - 1) END) AS a,
  min(CASE WHEN other <> label THEN reach / size END) AS b FROM tot GROUP BY 1, 2, 3, 4)""",
    ]


SILHOUETTE = "SELECT round(sum(w * CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(w), 6) AS silhouette FROM ab"


@check("silhouette_exact", on(WITH_CLEAN, SILHOUETTE, *silhouette_sql("sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))")))
def silhouette_exact(spark, folder):
    return quality.silhouette_exact(_assigned(spark, folder)).select(r("silhouette").alias("silhouette"))


@check("silhouette_within", on(WITH_CLEAN, SILHOUETTE.replace(" FROM ab", ", true AS within FROM ab"), *silhouette_sql("sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))")))
def silhouette_within(spark, folder):
    """At tolerance 0 the search in cells gives the exact score; at 1 % it stays within its bound of that."""
    points = _assigned(spark, folder)
    near = quality.silhouette_within(points, 0.01).scalar()
    return quality.silhouette_within(points, 0.0).select(
        r("silhouette").alias("silhouette"), (F.abs(F.col("silhouette") - near) <= 0.02 / 0.99).alias("within")
    )


@check("silhouette_fast", on(WITH_CLEAN, SILHOUETTE, *silhouette_sql("(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))")))
def silhouette_fast(spark, folder):
    """Squared distances; the SQL adds them up pair by pair."""
    return quality.silhouette_fast(_assigned(spark, folder)).select(r("silhouette").alias("silhouette"))


@check("standardise", on(WITH_CLEAN, """SELECT id, round((latitude - m1) / s1, 6) + 0.0 AS x, round((longitude - m2) / s2, 6) + 0.0 AS y FROM cl, (SELECT avg(latitude) AS m1,
  stddev_pop(latitude) AS s1, avg(longitude) AS m2, stddev_pop(longitude) AS s2 FROM cl)"""))
def standardise(spark, folder):
    df = cleaned(spark, folder).select("id", F.col("latitude").alias("x"), F.col("longitude").alias("y"))
    return quality.standardise(df, ["x", "y"]).withColumns({"x": r("x") + 0.0, "y": r("y") + 0.0})


@check("kmeans_sweep", on(WITH_CLEAN, f"""SELECT CAST(k AS INTEGER) AS k, 'linear' AS silhouette_kind, points, hub_inertia, true AS falling, true AS not_above_hubs, true AS in_range
  FROM range(3, 13) s(k), (SELECT count(*) AS points, round(sum(pow(x - mx, 2) + pow(y - my, 2)), 4) AS hub_inertia FROM (SELECT x, y, avg(x) OVER (PARTITION BY label) AS mx,
    avg(y) OVER (PARTITION BY label) AS my FROM (SELECT {ASSIGN.replace('x -', 'latitude -').replace('y -', 'longitude -')} AS label, (latitude - avg(latitude) OVER ()) / stddev_pop(latitude) OVER () AS x,
    (longitude - avg(longitude) OVER ()) / stddev_pop(longitude) OVER () AS y FROM cl)))"""))
def kmeans_sweep(spark, folder):
    """Every k of the default range from ten starts; inertia falls with k and is not above that of the hubs where there are as many centres."""
    df = cleaned(spark, folder)
    points = km.prepared_points(df)
    hubs = quality.nearest_centroid(points, HUBS, "latitude", "longitude").select("x", "y", "w", "label")
    used = hubs.select("label").distinct().count()
    table = km.kmeans_sweep(df).table.withColumns({
        "points": points.agg(F.sum("w").cast("long")).scalar(), "hub_inertia": F.round(quality.inertia(hubs).scalar(), 4),
    })
    before = F.lag("inertia").over(Window.orderBy("k"))
    return table.select(
        "k", "silhouette_kind", "points", "hub_inertia", F.coalesce(F.col("inertia") <= before * (1 + 1e-9), F.lit(True)).alias("falling"),
        ((F.col("k") < used) | (F.col("inertia") <= F.col("hub_inertia") + 1e-3)).alias("not_above_hubs"),
        (F.col("silhouette").between(-1, 1) & (F.col("davies_bouldin") >= 0) & (F.col("inertia") >= 0)).alias("in_range"),
    )


@check("kmeans_scores")
def kmeans_scores(spark, folder):
    """Silhouette, Davies-Bouldin and inertia of the best of ten starts for k 3 to 12, and which k is best."""
    sweep = km.kmeans_sweep(cleaned(spark, folder))
    return sweep.table.select(
        "k", r("silhouette", 4).alias("silhouette"), r("davies_bouldin", 4).alias("davies_bouldin"), r("inertia", 3).alias("inertia"),
        (F.col("k") == sweep.best_k).alias("best"),
    )


@check("cluster_overlay", on(WITH_CLEAN, f"""SELECT cl.id, l.label AS dbscan_label FROM cl LEFT JOIN (SELECT latitude, longitude, month, {ASSIGN.replace('x -', 'latitude -').replace('y -', 'longitude -')} AS label FROM cl) l
  ON l.latitude = cl.latitude AND l.longitude = cl.longitude AND l.month = cl.month"""))
def cluster_overlay(spark, folder):
    """The older form, which multiplies rows that share a point and month."""
    df = cleaned(spark, folder)
    labels = quality.nearest_centroid(df, HUBS, "latitude", "longitude", "dbscan_label")
    return dashboard.cluster_overlay(df, labels, by_id=False).select("id", "dbscan_label")


@check("cluster_overlay_by_id", on(WITH_CLEAN, f"SELECT id, {ASSIGN.replace('x -', 'latitude -').replace('y -', 'longitude -')} AS dbscan_label FROM cl"))
def cluster_overlay_by_id(spark, folder):
    df = cleaned(spark, folder)
    labels = quality.nearest_centroid(df, HUBS, "latitude", "longitude", "dbscan_label")
    return dashboard.cluster_overlay(df, labels).select("id", "dbscan_label")


@check("save_labels", on(WITH_CLEAN, f"""SELECT id, month, category, {ASSIGN.replace('x -', 'latitude -').replace('y -', 'longitude -')} AS kmeans_label FROM cl"""))
def save_labels(spark, folder):
    path = scratch_path(spark, "labels")
    labels = quality.nearest_centroid(cleaned(spark, folder), HUBS, "latitude", "longitude", "kmeans_label")
    results.save_labels(labels.withColumn("dbscan_label", F.lit(-1)), path)
    return spark.read.parquet(path).select("id", "month", "category", "kmeans_label")

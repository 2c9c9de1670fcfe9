"""Checks of features, aggregates and dashboard queries."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import functions as F

from checks.base import HASH0, WITH_CLEAN, WITH_FEATURES, WITH_INC, SEASON, check, cleaned, features, on, raw
from streetlens import config
from streetlens.functions import dates, geo, numbers, text
from streetlens.operators import aggregates as agg
from streetlens.operators import features as feat
from streetlens.operators import sampling
from streetlens.plans import dashboard, eda
from streetlens.session import scratch_path
from streetlens.sources import results

MONDAYS = """mondays AS (SELECT category, n, ds, unnest(ds) AS d FROM (
  SELECT category, count(*)::DOUBLE AS n, [x FOR x IN generate_series(month_date::TIMESTAMP, last_day(month_date)::TIMESTAMP,
    INTERVAL 1 DAY) IF dayofweek(x) = 1] AS ds FROM cl GROUP BY category, month_date))"""


def r(c, digits=6):
    return F.round(c, digits)


@check("monthly_by_category", on(WITH_CLEAN, "SELECT category, month_date, count(*) AS crime_count FROM cl GROUP BY 1, 2"))
def monthly_by_category(spark, folder):
    return agg.monthly_by_category(cleaned(spark, folder))


@check("monthly_totals", on(WITH_CLEAN, "SELECT month_date, count(*) AS crime_count FROM cl GROUP BY 1"))
def monthly_totals(spark, folder):
    return agg.monthly_totals(cleaned(spark, folder))


@check("weekly_by_category", on(
    WITH_CLEAN, "SELECT CAST(d AS DATE) AS week_start, category, round(n / len(ds), 6) AS crime_count FROM mondays", MONDAYS))
def weekly_by_category(spark, folder):
    return agg.weekly_by_category(cleaned(spark, folder)).withColumn("crime_count", r("crime_count"))


@check("category_counts", on(WITH_CLEAN, "SELECT category, count(*) AS count FROM cl GROUP BY 1"))
def category_counts(spark, folder):
    return agg.category_counts(cleaned(spark, folder))


PIVOT = ", ".join(f"count(*) FILTER (WHERE month_num = {m}) AS m{m:02d}" for m in range(1, 13))


@check("year_month_pivot", on(WITH_FEATURES, f"SELECT year, {PIVOT} FROM ft GROUP BY 1"))
def year_month_pivot(spark, folder):
    return agg.year_month_pivot(features(spark, folder))


@check("trend_small_multiples", on(WITH_CLEAN, "SELECT category, month_date, count(*) AS count FROM cl GROUP BY 1, 2"))
def trend_small_multiples(spark, folder):
    return agg.count_by(cleaned(spark, folder), "category", "month_date", name="count").orderBy("category", "month_date")


FILTERED = """fil AS (SELECT * FROM ft WHERE month_date >= DATE '1996-03-01' AND month_date <= DATE '1999-12-01'
  AND category IN ('violent-crime', 'burglary', 'drugs', 'robbery'))"""


def _filtered(df):
    return dashboard.dashboard_filter(df, "1996-03-01", "1999-12-01", ["violent-crime", "burglary", "drugs", "robbery"], [])


@check("dashboard_filter", on(WITH_FEATURES, "SELECT id, month_date, category, street_name FROM fil", FILTERED))
def dashboard_filter(spark, folder):
    return _filtered(features(spark, folder)).select("id", "month_date", "category", "street_name")


@check("monthly_trend", on(WITH_FEATURES, "SELECT month_date, count(*) AS count FROM fil GROUP BY 1", FILTERED))
def monthly_trend(spark, folder):
    return agg.count_by(_filtered(features(spark, folder)), "month_date", name="count")


ROWS = int(60 / sqrt(3.0))
HEX = f"""pts AS (SELECT latitude, longitude, count(*) AS n FROM cl GROUP BY 1, 2),
ext AS (SELECT min(latitude) AS b0, max(latitude) AS b1, min(longitude) AS a0, max(longitude) AS a1 FROM pts),
pad AS (SELECT b0 - (b1 - b0) * 1e-9 AS y0, ((b1 + (b1 - b0) * 1e-9) - (b0 - (b1 - b0) * 1e-9)) / {ROWS}.0::DOUBLE AS sy,
  a0 - (a1 - a0) * 1e-9 AS x0, ((a1 + (a1 - a0) * 1e-9) - (a0 - (a1 - a0) * 1e-9)) / 60.0::DOUBLE AS sx FROM ext),
sc AS (SELECT n, (longitude - x0) / sx AS x, (latitude - y0) / sy AS y, x0, y0, sx, sy FROM pts, pad),
nr AS (SELECT *, round_even(x, 0) AS xn, round_even(y, 0) AS yn, floor(x) AS xf, floor(y) AS yf FROM sc),
ds AS (SELECT *, (x - xn) * (x - xn) + 3.0::DOUBLE * ((y - yn) * (y - yn)) <
  (x - xf - 0.5) * (x - xf - 0.5) + 3.0::DOUBLE * ((y - yf - 0.5) * (y - yf - 0.5)) AS node FROM nr),
hx AS (SELECT CASE WHEN node THEN 0 ELSE 1 END AS lattice, CAST(CASE WHEN node THEN xn ELSE xf END AS INTEGER) AS hx,
  CAST(CASE WHEN node THEN yn ELSE yf END AS INTEGER) AS hy,
  round(CASE WHEN node THEN xn * sx + x0 ELSE (xf + 0.5) * sx + x0 END, 6) AS lng_c,
  round(CASE WHEN node THEN yn * sy + y0 ELSE (yf + 0.5) * sy + y0 END, 6) AS lat_c, n FROM ds)"""


@check("hexbin_density", on(WITH_CLEAN, "SELECT lattice, hx, hy, lng_c, lat_c, CAST(sum(n) AS BIGINT) AS count FROM hx GROUP BY ALL", HEX))
def hexbin_density(spark, folder):
    return agg.hexbin_density(cleaned(spark, folder)).withColumns({"lng_c": r("lng_c"), "lat_c": r("lat_c")})


CELLS = """SELECT grid_id, grid_lat, grid_lng, count(*) AS count,
  round(lat_min + grid_lat * ((lat_max - lat_min) / 50.0) + (lat_max - lat_min) / 50.0 / 2.0, 6) AS lat_c,
  round(lng_min + grid_lng * ((lng_max - lng_min) / 50.0) + (lng_max - lng_min) / 50.0 / 2.0, 6) AS lng_c
  FROM {t}, bnd GROUP BY grid_id, grid_lat, grid_lng, lat_min, lat_max, lng_min, lng_max"""


@check("grid_choropleth", on(WITH_FEATURES, CELLS.format(t="fil"), FILTERED))
def grid_choropleth(spark, folder):
    whole = features(spark, folder)
    return dashboard.choropleth_rows(_filtered(whole), whole).withColumns({"lat_c": r("lat_c"), "lng_c": r("lng_c")})


KPI = """SELECT count(*) AS total, count(DISTINCT month_date) AS months,
  round(count(*) / count(DISTINCT month_date), 1) AS avg_per_month,
  (SELECT category FROM (SELECT category, count(*) AS n FROM {t} GROUP BY 1) ORDER BY n DESC, category LIMIT 1) AS top_category,
  count(DISTINCT street_name) AS streets FROM {t}"""


@check("kpis", on(WITH_FEATURES, KPI.format(t="ft")))
def kpis(spark, folder):
    return agg.kpis(features(spark, folder))


@check("coord_extent", on(WITH_CLEAN, "SELECT * FROM bnd0", """bnd0 AS (SELECT min(latitude) AS lat_min, max(latitude) AS lat_max,
  min(longitude) AS lng_min, max(longitude) AS lng_max FROM cl)"""))
def coord_extent(spark, folder):
    return feat.coord_extent(cleaned(spark, folder))


@check("grid_bounds", on(WITH_FEATURES, "SELECT id, lat_min, lat_max, lng_min, lng_max FROM cl, bnd"))
def grid_bounds(spark, folder):
    return feat.with_bounds(cleaned(spark, folder)).select("id", "bounds.*")


@check("date_parts", on(WITH_FEATURES, "SELECT id, year, month_num, quarter, season FROM ft"))
def date_parts(spark, folder):
    return feat.add_temporal(cleaned(spark, folder)).select("id", "year", "month_num", "quarter", "season")


@check("season_map", f"""SELECT o_orderkey AS id, {SEASON.format(m='month(o_orderdate)')} AS season FROM orders""")
def season_map(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return orders.select(F.col("o_orderkey").alias("id"), dates.season(F.month("o_orderdate")).alias("season"))


@check("violent_flag", on(WITH_FEATURES, "SELECT id, is_violent FROM ft"))
def violent_flag(spark, folder):
    return feat.add_target(cleaned(spark, folder)).select("id", "is_violent")


@check("spatial_bin", on(WITH_FEATURES, "SELECT id, grid_lat, grid_lng, grid_id FROM ft"))
def spatial_bin(spark, folder):
    return feat.add_spatial_bins(cleaned(spark, folder)).select("id", "grid_lat", "grid_lng", "grid_id")


@check("season_onehot", on(WITH_FEATURES, """SELECT id, CAST(season = 'winter' AS INTEGER) AS season_winter, CAST(season = 'spring' AS INTEGER)
  AS season_spring, CAST(season = 'summer' AS INTEGER) AS season_summer, CAST(season = 'autumn' AS INTEGER) AS season_autumn FROM ft"""))
def season_onehot(spark, folder):
    df = feat.add_temporal(cleaned(spark, folder))
    return df.select("id", *dates.season_onehot(F.col("season")))


@check("cyclic_month", on(WITH_FEATURES, f"""SELECT id, round(sin(month_num * {2 * pi / 12!r}::DOUBLE), 6) + 0.0 AS month_sin,
  round(cos(month_num * {2 * pi / 12!r}::DOUBLE), 6) + 0.0 AS month_cos FROM ft"""))
def cyclic_month(spark, folder):
    sine, cosine = dates.cyclic_month(F.col("month_num"))
    df = feat.add_temporal(cleaned(spark, folder))
    return df.select("id", (r(sine) + 0.0).alias("month_sin"), (r(cosine) + 0.0).alias("month_cos"))


@check("dist_to_centre", on(WITH_CLEAN, """SELECT id, round(sqrt(pow(latitude - 53.3811::DOUBLE, 2) + pow(longitude + 1.4701::DOUBLE, 2)), 6)
  AS dist_to_centre FROM cl"""))
def dist_to_centre(spark, folder):
    return cleaned(spark, folder).select(
        "id", r(geo.dist_to_centre(F.col("latitude"), F.col("longitude"))).alias("dist_to_centre"))


@check("haversine_m", on(WITH_CLEAN, """SELECT id, round(2 * 6371000.0::DOUBLE * asin(sqrt(
  pow(sin(radians(latitude - 53.3811::DOUBLE) / 2), 2) + cos(radians(53.3811::DOUBLE)) * cos(radians(latitude))
    * pow(sin(radians(longitude + 1.4701::DOUBLE) / 2), 2))), 3) AS metres FROM cl"""))
def haversine_m(spark, folder):
    lat0, lng0 = (F.lit(v) for v in config.AREA_CENTRE)
    return cleaned(spark, folder).select(
        "id", r(geo.haversine_m(lat0, lng0, F.col("latitude"), F.col("longitude")), 3).alias("metres"))


@check("log_density", on(WITH_FEATURES, """SELECT grid_id, round(ln(1 + count(*) / (SELECT count(*) FROM ft)::DOUBLE * 1e6), 6) AS log_grid_freq,
  round(ln(1 + count(*)::DOUBLE), 6) AS log_count FROM ft GROUP BY 1"""))
def log_density(spark, folder):
    cells = features(spark, folder).groupBy("grid_id").agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n")).scalar()
    return cells.select("grid_id", r(numbers.log_density(F.col("n") / total)).alias("log_grid_freq"),
                        r(numbers.log_count(F.col("n"))).alias("log_count"))


@check("pretty_label", on(WITH_CLEAN, """SELECT category, array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(replace(category, '-', ' '), ' ')], ' ')
  AS label, count(*) AS n FROM cl GROUP BY 1"""))
def pretty_label(spark, folder):
    counts = agg.count_by(cleaned(spark, folder), "category", name="n")
    return counts.withColumn("label", text.pretty_label(F.col("category")))


@check("format_number", on(WITH_CLEAN, """SELECT strftime(month_date, '%b %Y') AS month_text, format('{:,}', count(*) * 1000 + 7) AS count_text,
  format('{:.1f}', count(*) / 3.0::DOUBLE) AS third_text FROM cl GROUP BY month_date"""))
def format_number(spark, folder):
    counts = agg.count_by(cleaned(spark, folder), "month_date", name="n")
    return counts.select(
        F.date_format("month_date", "MMM yyyy").alias("month_text"), text.thousands(F.col("n") * 1000 + 7).alias("count_text"),
        F.format_number(F.col("n") / F.lit(3.0), 1).alias("third_text"))


@check("polygon_text", on(WITH_CLEAN, """SELECT category, CAST(min(latitude) AS VARCHAR) || ',' || CAST(min(longitude) AS VARCHAR) || ':' ||
  CAST(max(latitude) AS VARCHAR) || ',' || CAST(max(longitude) AS VARCHAR) AS box FROM (
  SELECT category, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude FROM cl) GROUP BY 1"""))
def polygon_text(spark, folder):
    """South-west and north-east corner of every category."""
    df = cleaned(spark, folder).select("category", r("latitude", 4).alias("latitude"), r("longitude", 4).alias("longitude"))
    corners = F.array(F.struct(F.min("latitude").alias("lat"), F.min("longitude").alias("lng")),
                      F.struct(F.max("latitude").alias("lat"), F.max("longitude").alias("lng")))
    return df.groupBy("category").agg(corners.alias("p")).select("category", text.polygon_text_column(F.col("p")).alias("box"))


@check("months_range", on(WITH_CLEAN, """SELECT category, strftime(m, '%Y-%m') AS month FROM (SELECT category, unnest(generate_series(
  max(month_date)::TIMESTAMP - INTERVAL 36 MONTH, max(month_date)::TIMESTAMP - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS m
  FROM cl GROUP BY category)"""))
def months_range(spark, folder):
    last = cleaned(spark, folder).groupBy("category").agg(F.max("month_date").alias("last"))
    return last.select("category", F.explode(dates.months_range(F.col("last"), 36)).alias("month"))


@check("future_months", on(WITH_CLEAN, """SELECT category, CAST(m AS DATE) AS month_date FROM (SELECT category, unnest(generate_series(
  max(month_date)::TIMESTAMP + INTERVAL 1 MONTH, max(month_date)::TIMESTAMP + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS m
  FROM cl GROUP BY category)"""))
def future_months(spark, folder):
    last = cleaned(spark, folder).groupBy("category").agg(F.max("month_date").alias("last"))
    return last.select("category", F.explode(dates.future_months(F.col("last"), 3)).alias("month_date"))


@check("clip_non_negative", "SELECT c_custkey, greatest(c_acctbal, 0.0::DOUBLE) AS balance FROM customer")
def clip_non_negative(spark, folder):
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    return customer.select("c_custkey", numbers.clip_non_negative(F.col("c_acctbal")).alias("balance"))


@check("project_columns", on(WITH_CLEAN, "SELECT latitude, longitude, month, category FROM cl"))
def project_columns(spark, folder):
    return dashboard.heatmap_rows(cleaned(spark, folder))


@check("category_history", on(WITH_CLEAN, "SELECT month_date, count(*) AS count FROM cl WHERE category = 'violent-crime' GROUP BY 1"))
def category_history(spark, folder):
    return dashboard.category_history(cleaned(spark, folder), "violent-crime")


@check("sort_by_month", on(WITH_CLEAN, "SELECT id, month_date FROM cl"))
def sort_by_month(spark, folder):
    return cleaned(spark, folder).select("id", "month_date").orderBy("month_date")


@check("street_list", on(WITH_INC, "SELECT DISTINCT street_name FROM inc WHERE street_name IS NOT NULL ORDER BY 1"))
def street_list(spark, folder):
    """The first 100 of 200 streets, so that the list limit matters."""
    return agg.street_list(raw(spark, folder))


@check("category_list", on(WITH_CLEAN, "SELECT DISTINCT category FROM cl"))
def category_list(spark, folder):
    return agg.category_list(cleaned(spark, folder))


@check("month_list", on(WITH_CLEAN, """SELECT month, (SELECT min(month_date) FROM cl) AS first_month, (SELECT max(month_date) FROM cl) AS last_month
  FROM (SELECT DISTINCT month FROM cl)"""))
def month_list(spark, folder):
    df = cleaned(spark, folder)
    span = agg.month_span(df).select(F.struct("first_month", "last_month").alias("s")).scalar()
    return agg.month_list(df).select("month", span["first_month"].alias("first_month"), span["last_month"].alias("last_month"))


@check("sample_n", on(WITH_CLEAN, f"SELECT id, category FROM cl ORDER BY {HASH0}, id LIMIT 8000"))
def sample_n(spark, folder):
    """The report shows exactly 8,000 points."""
    return sampling.sample_n(cleaned(spark, folder), 8000).select("id", "category")


@check("export_filtered", on(WITH_FEATURES, "SELECT id, month_date, category, street_name, latitude FROM fil", FILTERED))
def export_filtered(spark, folder):
    path = scratch_path(spark, "export")
    results.export_filtered(_filtered(features(spark, folder)).select("id", "month_date", "category", "street_name", "latitude"), path)
    return spark.read.option("header", True).schema(
        "id bigint, month_date date, category string, street_name string, latitude double").csv(path)


@check("eda_tables", on(WITH_FEATURES, """SELECT 'monthly_trend' AS name, CAST(month_date AS VARCHAR) AS key, count(*)::BIGINT AS value FROM ft GROUP BY 2
  UNION ALL SELECT 'category_breakdown', category, count(*) FROM ft GROUP BY 2
  UNION ALL SELECT 'seasonal_heatmap', CAST(year AS VARCHAR), count(*) FROM ft GROUP BY 2
  UNION ALL SELECT 'spatial_density', CAST(lattice AS VARCHAR) || '/' || CAST(hx AS VARCHAR) || '/' || CAST(hy AS VARCHAR), CAST(sum(n) AS BIGINT) FROM hx GROUP BY 2
  UNION ALL SELECT 'category_trends', category || '/' || CAST(month_date AS VARCHAR), count(*) FROM ft GROUP BY 2""", HEX))
def eda_tables(spark, folder):
    t = eda.eda_tables(features(spark, folder))
    months = [F.col(f"m{m:02d}") for m in range(1, 13)]
    total = months[0]
    for m in months[1:]:
        total = total + m
    keys = {
        "monthly_trend": (F.col("month_date").cast("string"), F.col("count")),
        "category_breakdown": (F.col("category"), F.col("count")),
        "seasonal_heatmap": (F.col("year").cast("string"), total),
        "spatial_density": (F.concat_ws("/", "lattice", "hx", "hy"), F.col("count")),
        "category_trends": (F.concat_ws("/", "category", "month_date"), F.col("count")),
    }
    out = None
    for name, (key, value) in keys.items():
        part = t[name].select(F.lit(name).alias("name"), key.alias("key"), value.cast("bigint").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@check("map_layers", on(WITH_FEATURES, f"""SELECT 'heat' AS layer, category AS colour, count(*)::BIGINT AS rows FROM fil GROUP BY 2
  UNION ALL SELECT 'scatter', category, count(*) FROM (SELECT * FROM fil ORDER BY {HASH0}, id LIMIT 8000) GROUP BY 2
  UNION ALL SELECT 'cells', grid_id, count(*) FROM fil GROUP BY 2""", FILTERED))
def map_layers(spark, folder):
    whole = features(spark, folder)
    fil = _filtered(whole)
    heat = dashboard.heatmap_rows(fil).groupBy(F.col("category").alias("colour")).agg(F.count(F.lit(1)).alias("rows"))
    scatter = dashboard.scatter_rows(fil).groupBy("colour").agg(F.count(F.lit(1)).alias("rows"))
    cells = dashboard.choropleth_rows(fil, whole).select(F.col("grid_id").alias("colour"), F.col("count").alias("rows"))
    return (
        heat.withColumn("layer", F.lit("heat")).unionByName(scatter.withColumn("layer", F.lit("scatter")))
        .unionByName(cells.withColumn("layer", F.lit("cells")))
    )

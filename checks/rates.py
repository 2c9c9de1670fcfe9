"""Checks of splits, samples, rates and feature frames."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from checks.base import HASH, WITH_FEATURES, check, features, on
from streetlens.operators import priors, sampling
from streetlens.session import cut

SPLIT = f"""split AS (SELECT ft.*, CAST(row_number() OVER (PARTITION BY is_violent ORDER BY {HASH}, id)
  <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY is_violent)) AS INTEGER) AS is_test FROM ft),
trn AS (SELECT * FROM split WHERE is_test = 0)"""
GLOBAL = "(SELECT avg(is_violent) FROM trn)"


def r(c, digits=6):
    return F.round(c, digits)


def _rate_sql(keys: str, k: int, name: str, where: str = "") -> str:
    return f"""{name} AS (SELECT {keys}, count(*) AS n, (sum(is_violent) + {k} * {GLOBAL}) / (count(*) + {k}) AS rate
  FROM trn {where} GROUP BY {keys})"""


GRID_RATE, RAW_RATE = _rate_sql("grid_id", 20, "gr"), _rate_sql("grid_id", 0, "rr")
STREET_RATE = _rate_sql("street_name", 10, "sr")
LSOA_RATE = _rate_sql("outcome_category", 20, "lr")
FINE = "CAST(round_even(latitude * 1000, 0) AS BIGINT) AS fine_lat, CAST(round_even(longitude * 1000, 0) AS BIGINT) AS fine_lng"
FINE_RATE = f"""fr AS (SELECT fine_lat, fine_lng, (sum(is_violent) + 5 * {GLOBAL}) / (count(*) + 5) AS rate
  FROM (SELECT {FINE}, is_violent FROM trn) GROUP BY 1, 2)"""


def _split(spark, folder):
    return sampling.stratified_split(features(spark, folder))


def _train(spark, folder):
    return _split(spark, folder).filter("is_test = 0")


@check("stratified_split", on(WITH_FEATURES, "SELECT id, is_violent, is_test FROM split", SPLIT))
def stratified_split(spark, folder):
    return _split(spark, folder).select("id", "is_violent", "is_test")


@check("stratified_folds", on(WITH_FEATURES, f"""SELECT id, is_violent, CAST(ntile(3) OVER (PARTITION BY is_violent ORDER BY {HASH}, id) - 1 AS INTEGER) AS fold
  FROM ft"""))
def stratified_folds(spark, folder):
    return sampling.stratified_folds(features(spark, folder)).select("id", "is_violent", "fold")


@check("stratified_sample", on(WITH_FEATURES, f"""SELECT id, is_violent FROM (SELECT id, is_violent,
    row_number() OVER (PARTITION BY is_violent ORDER BY {HASH}, id) AS rk, (SELECT count(*) FROM ft) AS n, (SELECT sum(is_violent) FROM ft) AS p FROM ft)
  WHERE n <= 5000 OR rk <= CASE WHEN is_violent = 1 THEN round_even(5000.0::DOUBLE * (p::DOUBLE / n::DOUBLE), 0) ELSE 5000 - round_even(5000.0::DOUBLE * (p::DOUBLE / n::DOUBLE), 0) END"""))
def stratified_sample(spark, folder):
    """The operator's own row limit, here 5,000."""
    return sampling.stratified_sample(features(spark, folder), 5000).select("id", "is_violent")


@check("class_balance", on(WITH_FEATURES, "SELECT is_test, count(*) AS rows, round(avg(is_violent) * 100, 6) AS positive_pct FROM split GROUP BY 1", SPLIT))
def class_balance(spark, folder):
    return sampling.class_balance(_split(spark, folder)).withColumn("positive_pct", r("positive_pct"))


@check("class_weights", on(WITH_FEATURES, """SELECT is_violent, count(*) AS n, round((SELECT count(*) FROM ft) / ((SELECT count(DISTINCT is_violent) FROM ft) * count(*)), 6)
  AS weight FROM ft GROUP BY 1"""))
def class_weights(spark, folder):
    return sampling.class_weights(features(spark, folder)).withColumn("weight", r("weight"))


@check("grid_freq", on(WITH_FEATURES, "SELECT grid_id, round(count(*) / (SELECT count(*) FROM trn), 8) AS freq FROM trn GROUP BY 1", SPLIT))
def grid_freq(spark, folder):
    return priors.frequency_table(_train(spark, folder), "grid_id").withColumn("freq", r("freq", 8))


@check("smoothed_rate", on(WITH_FEATURES, "SELECT grid_id, round(rate, 8) AS rate FROM gr", SPLIT, GRID_RATE))
def smoothed_rate(spark, folder):
    return priors.rate_table(_train(spark, folder), ["grid_id"], 20).withColumn("rate", r("rate", 8))


@check("raw_rate", on(WITH_FEATURES, "SELECT grid_id, round(rate, 8) AS rate FROM rr", SPLIT, RAW_RATE))
def raw_rate(spark, folder):
    return priors.rate_table(_train(spark, folder), ["grid_id"], 0).withColumn("rate", r("rate", 8))


@check("fine_grid_rate", on(WITH_FEATURES, "SELECT fine_lat, fine_lng, round(rate, 8) AS rate FROM fr", SPLIT, FINE_RATE))
def fine_grid_rate(spark, folder):
    train = priors.with_fine_cells(_train(spark, folder))
    return priors.rate_table(train, ["fine_lat", "fine_lng"], 5).withColumn("rate", r("rate", 8))


@check("street_rate", on(WITH_FEATURES, "SELECT street_name, round(rate, 8) AS rate FROM sr", SPLIT, STREET_RATE))
def street_rate(spark, folder):
    return priors.rate_table(_train(spark, folder), ["street_name"], 10).withColumn("rate", r("rate", 8))


@check("street_count", on(WITH_FEATURES, "SELECT street_name, n AS rows FROM sr", SPLIT, STREET_RATE))
def street_count(spark, folder):
    return priors.key_counts(_train(spark, folder), ["street_name"]).select("street_name", "rows")


@check("lsoa_rate", on(WITH_FEATURES, "SELECT outcome_category, round(rate, 8) AS rate FROM lr", SPLIT, LSOA_RATE))
def lsoa_rate(spark, folder):
    """The area column is a parameter; the view's outcome column serves as one."""
    return priors.rate_table(_train(spark, folder), ["outcome_category"], 20).withColumn("rate", r("rate", 8))


@check("map_rate", on(WITH_FEATURES, f"""SELECT id, round(coalesce(gr.rate, {GLOBAL}), 8) AS grid_rate, round(coalesce(sr.rate, {GLOBAL}), 8) AS street_rate
  FROM split LEFT JOIN gr USING (grid_id) LEFT JOIN sr USING (street_name)""", SPLIT, GRID_RATE, STREET_RATE))
def map_rate(spark, folder):
    df = cut(_split(spark, folder))
    train = df.filter("is_test = 0")
    rate = priors.overall_rate(train)
    out = priors.map_rate(df, priors.rate_table(train, ["grid_id"], 20, out="grid_rate"), ["grid_id"], {"grid_rate": rate})
    out = priors.map_rate(out, priors.rate_table(train, ["street_name"], 10, out="street_rate"), ["street_name"], {"street_rate": rate})
    return out.select("id", r("grid_rate", 8).alias("grid_rate"), r("street_rate", 8).alias("street_rate"))


SEASON_COLS = ", ".join(f"CAST(season = '{s}' AS INTEGER) AS season_{s}" for s in ("winter", "spring", "summer", "autumn"))
ANGLE = f"month_num * {2 * pi / 12!r}::DOUBLE"
FEATURES_SQL = f"""SELECT id, latitude, longitude, month_num, round(sin({ANGLE}), 6) + 0.0 AS month_sin, round(cos({ANGLE}), 6) + 0.0 AS month_cos, quarter,
  round(sqrt(pow(latitude - 53.3811::DOUBLE, 2) + pow(longitude + 1.4701::DOUBLE, 2)), 6) AS dist_to_centre,
  round(coalesce(gr.n, 0) / (SELECT count(*) FROM trn)::DOUBLE, 8) AS grid_freq,
  round(ln(1 + coalesce(gr.n, 0) / (SELECT count(*) FROM trn)::DOUBLE * 1e6), 6) AS log_grid_freq,
  round(coalesce(gr.rate, {GLOBAL}), 8) AS violent_rate_grid, round(coalesce(fr.rate, {GLOBAL}), 8) AS violent_rate_grid_fine,
  round(coalesce(sr.rate, {GLOBAL}), 8) AS violent_rate_street, round(ln(1 + coalesce(sr.n, 0)), 6) AS log_street_crimes,
  {SEASON_COLS}, is_violent AS label
  FROM (SELECT *, {FINE} FROM split) LEFT JOIN gr USING (grid_id) LEFT JOIN fr USING (fine_lat, fine_lng) LEFT JOIN sr USING (street_name)"""
ROUNDING = {
    "month_sin": 6, "month_cos": 6, "dist_to_centre": 6, "grid_freq": 8, "log_grid_freq": 6, "violent_rate_grid": 8,
    "violent_rate_grid_fine": 8, "violent_rate_street": 8, "log_street_crimes": 6,
}


def _rounded(df):
    return df.withColumns({c: (r(c, d) + F.lit(0.0)) for c, d in ROUNDING.items() if c in df.columns})


@check("build_features", on(WITH_FEATURES, FEATURES_SQL, SPLIT, GRID_RATE, FINE_RATE, STREET_RATE))
def build_features(spark, folder):
    split = cut(_split(spark, folder))
    return _rounded(priors.build_features(split, split.filter("is_test = 0")))


@check("build_features_basic", on(WITH_FEATURES, f"""SELECT id, latitude, longitude, month_num, year, quarter,
  round(count(*) OVER (PARTITION BY grid_id) / (SELECT count(*) FROM ft), 8) AS grid_freq, {SEASON_COLS}, is_violent AS label FROM ft"""))
def build_features_basic(spark, folder):
    return _rounded(priors.build_features_basic(features(spark, folder)))


@check("build_features_raw_prior", on(WITH_FEATURES, f"""SELECT id, latitude, longitude, month_num, quarter,
  round(coalesce(rr.n, 0) / (SELECT count(*) FROM trn)::DOUBLE, 8) AS grid_freq, round(coalesce(rr.rate, {GLOBAL}), 8) AS violent_rate_grid,
  {SEASON_COLS}, is_violent AS label FROM split LEFT JOIN rr USING (grid_id)""", SPLIT, RAW_RATE))
def build_features_raw_prior(spark, folder):
    split = cut(_split(spark, folder))
    return _rounded(priors.build_features_raw_prior(split, split.filter("is_test = 0")))

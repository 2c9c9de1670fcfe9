"""Registry and shared SQL of the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streetlens import config
from streetlens.incident_view import RAW_CATEGORIES, read_incidents
from streetlens.operators.clean import clean
from streetlens.operators.features import engineer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# ---- inputs in Spark ---------------------------------------------------------
def raw(spark: SparkSession, folder: str) -> DataFrame:
    return read_incidents(spark, folder)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean(raw(spark, folder))


def features(spark: SparkSession, folder: str, keep_bounds: bool = False) -> DataFrame:
    return engineer(cleaned(spark, folder), keep_bounds=keep_bounds)


# ---- the same inputs in SQL --------------------------------------------------
def _list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def month_sql(text: str) -> str:
    return f"CAST(try_strptime({text} || '-01', '%Y-%m-%d') AS DATE)"


INC = f"""inc AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 89 <> 0 THEN o_orderkey END AS api_id,
    ([{_list(RAW_CATEGORIES)}])[CAST(o_orderkey % 18 + 1 AS INTEGER)] AS category,
    CASE WHEN o_orderkey % 997 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m') END AS month,
    CASE WHEN o_orderkey % 101 <> 0 THEN 53.31::DOUBLE + (o_custkey % 200 % 8) * 0.02::DOUBLE
      + ((o_custkey % 200 // 8) % 5) * 0.0005::DOUBLE END AS latitude,
    -1.62::DOUBLE + (((o_custkey % 200 % 8) * 5) % 8) * 0.035::DOUBLE
      + ((o_custkey % 200 // 8) // 5) * 0.0005::DOUBLE AS longitude,
    'Force' AS location_type,
    o_custkey % 200 AS street_id,
    'On or near Street ' || CAST(o_custkey % 200 AS VARCHAR) AS street_name,
    CAST(NULL AS VARCHAR) AS context,
    o_orderstatus AS outcome_category,
    strftime(o_orderdate, '%Y-%m') AS outcome_date,
    'p' || CAST(o_orderkey AS VARCHAR) AS persistent_id
  FROM orders)"""


def polygon_sql(lat: str = "latitude", lng: str = "longitude") -> str:
    points = config.AREA_POLYGON
    on_edge, crossing = [], []
    for (y1, x1), (y2, x2) in zip(points, [*points[1:], points[0]]):
        y1s, x1s, y2s, x2s = (f"({v})::DOUBLE" for v in (y1, x1, y2, x2))
        on_edge.append(
            f"(({x2s} - {x1s}) * ({lat} - {y1s}) = ({y2s} - {y1s}) * ({lng} - {x1s})"
            f" AND {lat} BETWEEN least({y1s}, {y2s}) AND greatest({y1s}, {y2s})"
            f" AND {lng} BETWEEN least({x1s}, {x2s}) AND greatest({x1s}, {x2s}))"
        )
        if y1 != y2:
            crossing.append(
                f"(CASE WHEN ({y1s} > {lat}) <> ({y2s} > {lat})"
                f" AND {lng} < ({x2s} - {x1s}) * ({lat} - {y1s}) / ({y2s} - {y1s}) + {x1s} THEN 1 ELSE 0 END)"
            )
    return f"({' OR '.join(on_edge)} OR ({' + '.join(crossing)}) % 2 = 1)"


NORMAL = "lower(regexp_replace(category, '^\\s+|\\s+$', '', 'g'))"
ALIAS = "CASE {c} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in config.CATEGORY_ALIASES.items()) + " ELSE {c} END"
ALIASED = ALIAS.replace("{c}", NORMAL)
CANON = f"CASE WHEN {ALIASED} IN ({_list(config.CANONICAL_CATEGORIES)}) THEN {ALIASED} ELSE 'other-crime' END"

COV = f"""cov AS (
  SELECT * FROM inc WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND {polygon_sql()})"""
NRM = f"nrm AS (SELECT * REPLACE ({CANON} AS category) FROM cov)"
DED = """ded AS (
  SELECT * FROM nrm QUALIFY row_number() OVER (
    PARTITION BY category, month, street_id, round_even(latitude * 1e5, 0), round_even(longitude * 1e5, 0) ORDER BY id) = 1)"""
CL = f"cl AS (SELECT *, {month_sql('month')} AS month_date FROM ded WHERE {month_sql('month')} IS NOT NULL)"


def bin_sql(x: str, lo: str, hi: str, n: int) -> str:
    step = f"(({hi} - {lo}) / {n}.0::DOUBLE)"
    raw_bin = f"CAST(floor(({x} - {lo}) / {step}) AS INTEGER)"
    return (
        f"CASE WHEN {hi} = {lo} THEN {n - 1} ELSE least(greatest("
        f"CASE WHEN {x} >= {lo} + ({raw_bin} + 1) * {step} THEN {raw_bin} + 1"
        f" WHEN {x} < {lo} + {raw_bin} * {step} THEN {raw_bin} - 1 ELSE {raw_bin} END, 0), {n - 1}) END"
    )


BND = """bnd AS (SELECT min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lng_min,
  max(longitude) AS lng_max FROM cl)"""
SEASON = (
    "CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} IN (3, 4, 5) THEN 'spring' "
    "WHEN {m} IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"
)
FT = f"""ft0 AS (
  SELECT cl.*, CAST(year(month_date) AS INTEGER) AS year, CAST(month(month_date) AS INTEGER) AS month_num,
    CAST(quarter(month_date) AS INTEGER) AS quarter, {SEASON.format(m="month(month_date)")} AS season,
    CASE WHEN category IN ({_list(config.VIOLENT_CATEGORIES)}) THEN 1 ELSE 0 END AS is_violent,
    CAST({bin_sql("latitude", "lat_min", "lat_max", 50)} AS INTEGER) AS grid_lat,
    CAST({bin_sql("longitude", "lng_min", "lng_max", 50)} AS INTEGER) AS grid_lng
  FROM cl, bnd),
ft AS (SELECT *, CAST(grid_lat AS VARCHAR) || '_' || CAST(grid_lng AS VARCHAR) AS grid_id FROM ft0)"""

WITH_INC = "WITH " + INC
WITH_COV = WITH_INC + ",\n" + COV
WITH_CLEAN = WITH_COV + ",\n" + NRM + ",\n" + DED + ",\n" + CL
WITH_FEATURES = WITH_CLEAN + ",\n" + BND + ",\n" + FT


def on(prefix: str, body: str, *ctes: str) -> str:
    """A query on top of the shared steps, with further named steps in between."""
    return ",\n".join([prefix, *ctes]) + "\n" + body


HASH = "(((id % 1000003) * 7919 + 42) % 1000003)"
HASH0 = "(((id % 1000003) * 7919) % 1000003)"

# shared steps on the panel
PANEL = [
    "cnt AS (SELECT category, month_date, CAST(count(*) AS BIGINT) AS count FROM ft GROUP BY 1, 2)",
    """grid AS (SELECT category, CAST(m AS DATE) AS month_date FROM (SELECT DISTINCT category FROM cnt),
  (SELECT unnest(generate_series((SELECT min(month_date) FROM cnt)::TIMESTAMP, (SELECT max(month_date) FROM cnt)::TIMESTAMP,
    INTERVAL 1 MONTH)) AS m))""",
    "pad AS (SELECT category, month_date, CAST(coalesce(count, 0) AS BIGINT) AS count FROM grid LEFT JOIN cnt USING (category, month_date))",
    """lagged AS (SELECT *, lag(count, 1) OVER w AS lag_1, lag(count, 2) OVER w AS lag_2, lag(count, 3) OVER w AS lag_3,
  lag(count, 6) OVER w AS lag_6,
  avg(count) OVER (PARTITION BY category ORDER BY month_date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll3
  FROM pad WINDOW w AS (PARTITION BY category ORDER BY month_date))""",
    """timed AS (SELECT *, CAST(month(month_date) AS INTEGER) AS month_n, CAST(year(month_date) AS INTEGER) AS year,
  CAST((year(month_date) - (SELECT min(year(month_date)) FROM pad)) * 12 + month(month_date) AS INTEGER) AS t FROM lagged)""",
    """pnl AS (SELECT *, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS cat_enc FROM timed
  WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND lag_6 IS NOT NULL)""",
]

"""Cleaning steps on hand-made rows, and golden counts of the derived view."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.base import cleaned, raw
from streetlens.functions import geo, text
from streetlens.operators import clean as ops
from streetlens.operators.features import engineer

COLUMNS = "id long, category string, month string, latitude double, longitude double, street_id long"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([
        (11, "shoplifting", "2023-06", 53.40, -1.46, 71), (12, "SHOPLIFTING", "2023-06", 53.40, -1.46, 71),
        (13, "robbery", "2023-07", 53.41, -1.44, 72), (14, "other-theft", "2023-09", 53.39, -1.48, 73),
        (15, "drugs", "2023-09", None, -1.45, 74), (16, "no-such-kind", "2023-10", 53.60, -1.20, 75),
    ], COLUMNS)


def test_coordinates(rows):
    out = ops.validate_coords(rows)
    assert [r["id"] for r in out.orderBy("id").collect()] == [11, 12, 13, 14]
    assert ops.validate_coords(rows, None).count() == 5


@pytest.mark.parametrize("point,inside", [
    ((53.485, -1.5), True), ((53.485, -1.635), True), ((53.30, -1.60), True), ((53.40, -1.47), True), ((53.45, -1.3201), True),
    ((53.50, -1.30), False), ((53.2999, -1.60), False), ((53.415, -1.2999), False), ((53.47, -1.675), False),
])
def test_polygon_covers_its_boundary(spark, point, inside):
    row = spark.range(1).select(geo.covered_by(F.lit(point[0]), F.lit(point[1])).alias("c")).first()
    assert row["c"] is inside


def test_nan_and_out_of_range_coordinates_go(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), 0.0), (2, 91.0, 0.0), (3, 0.0, -180.5), (4, 90.0, 180.0), (5, None, 0.0)], "id long, latitude double, longitude double")
    assert [r["id"] for r in ops.validate_coords(df, None).collect()] == [4]


def test_categories(spark):
    given = ["\tBurglary \n", "ANTI-SOCIAL", "theft-from-the-person", "nonsense", None, "drugs"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(given)], "id int, category string")
    out = [r["category"] for r in ops.normalise_categories(df).orderBy("id").collect()]
    assert out == ["burglary", "anti-social-behaviour", "theft-from-person", "other-crime", "other-crime", "drugs"]
    assert [r["category"] for r in ops.unknown_categories(df).collect()] == ["nonsense"]
    stepwise = df.withColumn("category", text.unknown_to_other(text.alias_map(text.normalise_text(F.col("category")))))
    assert [r["category"] for r in stepwise.orderBy("id").collect()] == out


def test_duplicates_keep_the_first_and_round_to_even(spark):
    df = spark.createDataFrame([
        (3, "a", "m", 53.380004, -1.0, 1), (1, "a", "m", 53.38, -1.0, 1), (2, "a", "m", 53.38, -1.0, None),
        (4, "a", "m", 53.38, -1.0, None), (5, "a", "m", 53.38001, -1.0, 1), (6, "a", "n", 53.38, -1.0, 1),
    ], COLUMNS)
    assert sorted(r["id"] for r in ops.deduplicate(df).collect()) == [1, 2, 5, 6]
    assert sorted(r["id"] for r in ops.deduplicate(df, tolerance=1e-3).collect()) == [1, 2, 6]
    half = spark.range(1).select(geo.fixed_cell(F.lit(0.5), 1).alias("a"), geo.fixed_cell(F.lit(1.5), 1).alias("b")).first()
    assert (half["a"], half["b"]) == (0, 2)


def test_month(spark):
    df = spark.createDataFrame([("2024-02",), ("2024-13",), ("bad",), (None,)], "month string")
    out = ops.parse_month(df).collect()
    assert [str(r["month_date"]) for r in out] == ["2024-02-01"]


def test_clean_is_idempotent(rows):
    once = ops.clean(rows)
    assert sorted(r["id"] for r in once.collect()) == [11, 13, 14]
    assert ops.clean(once.drop("month_date")).count() == 3


def test_golden_counts(spark, folder):
    counts = {r["step"]: (r["rows_before"], r["rows_after"]) for r in ops.cleaning_counts(raw(spark, folder)).collect()}
    assert counts == {"coordinates": (1500, 1485), "polygon": (1485, 1293), "duplicates": (1293, 1285), "month": (1285, 1285)}
    df = engineer(cleaned(spark, folder)).persist()
    row = df.agg(F.count_distinct("category").alias("c"), F.count_distinct("month").alias("m"), F.sum("is_violent").alias("v"),
                 F.count_distinct("street_name").alias("s"), F.min("latitude").alias("lo"), F.max("latitude").alias("hi")).first()
    assert (row["c"], row["m"], row["v"], row["s"]) == (14, 80, 292, 131)
    assert (round(row["lo"], 3), round(row["hi"], 3)) == (53.33, 53.452)
    assert df.groupBy("category", "month_date").count().count() == 739
    df.unpersist()

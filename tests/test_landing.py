"""Month lists, nested records, landed files, load-or-ignore, incremental load."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetlens.functions import dates, text
from streetlens.schema import BRONZE, BRONZE_COLUMNS, RECORD
from streetlens.sources import landing, store
from streetlens.streaming.incremental import incremental_load

RECORD_OK = {
    "id": 47110, "category": "burglary", "month": "2024-01",
    "location": {"latitude": "53.41", "longitude": "-1.45", "location_type": "Force", "street": {"id": 606, "name": "Quay Row"}},
    "outcome_status": {"category": "Under review", "date": "2024-02"}, "persistent_id": "f00d",
}


def write_month(folder, month, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"crimes_{month}.json").write_text(records if isinstance(records, str) else json.dumps(records))


def records(spark, *rows):
    lines = spark.sparkContext.parallelize([json.dumps(r) for r in rows], 1)
    return spark.read.schema(RECORD).json(lines).withColumn("file_month", F.lit("2024-01"))


def test_months_range_ends_before_the_current_month(spark):
    row = spark.range(1).select(dates.months_range(F.lit(date(2019, 2, 28)), 4).alias("m")).first()
    assert row["m"] == ["2018-10", "2018-11", "2018-12", "2019-01"]


def test_polygon_text():
    assert text.polygon_text([(51.5, -0.12), (51.25, 0.0), (50.75, -0.5)]) == "51.5,-0.12:51.25,0.0:50.75,-0.5"


def test_flatten_complete_record(spark):
    row = landing.flatten_record(records(spark, RECORD_OK)).first()
    assert tuple(row) == (
        47110, "burglary", "2024-01", 53.41, -1.45, "Force", 606, "Quay Row", None, "Under review", "2024-02", "f00d")


@pytest.mark.parametrize("location", [
    {}, None, {"latitude": "53.41"}, {"latitude": "x", "longitude": "1"}, {"latitude": "53.38d", "longitude": "1"},
    {"latitude": "nan", "longitude": "1"}, {"latitude": None, "longitude": "1"},
])
def test_flatten_drops_rows_without_coordinates(spark, location):
    assert landing.flatten_record(records(spark, {"id": 1, "category": "burglary", "location": location})).count() == 0


def test_flatten_defaults(spark):
    rec = {"id": 5, "location": {"latitude": " 53.4 ", "longitude": "-1.4e0"}, "context": "", "persistent_id": "", "month": ""}
    row = landing.flatten_record(records(spark, rec)).first()
    assert (row["category"], row["month"], row["context"], row["persistent_id"]) == ("unknown", "2024-01", None, None)
    assert (row["latitude"], row["longitude"], row["street_id"]) == (53.4, -1.4, None)
    assert landing.flatten_record(records(spark, rec), null_category="drop").count() == 0


def test_month_files_empty_and_corrupt(spark, tmp_path):
    write_month(tmp_path / "in", "2024-01", [RECORD_OK, {**RECORD_OK, "id": 47111}])
    write_month(tmp_path / "in", "2024-02", [])
    write_month(tmp_path / "in", "2024-03", "{not json")
    scan = landing.scan_incident_json(spark, str(tmp_path / "in"))
    good = landing.good_records(scan)
    assert {(r["file_month"], r["id"]) for r in good.collect()} == {("2024-01", 47110), ("2024-01", 47111)}
    assert good.count() == 2
    assert [r["file_month"] for r in landing.quarantined(scan).collect()] == ["2024-03"]
    assert landing.scan_incident_json(spark, str(tmp_path / "in"), only_months=["2024-02"]).count() == 0


def test_landed_month_is_reused_or_replaced(spark, tmp_path):
    path = str(tmp_path / "landed")
    landing.land_month(records(spark, RECORD_OK), path)
    landing.land_month(records(spark, {**RECORD_OK, "id": 9}, RECORD_OK), path)
    scan = lambda: landing.good_records(landing.scan_incident_json(spark, path, multi_line=False))
    assert [r["id"] for r in scan().collect()] == [47110]
    landing.land_month(records(spark, {**RECORD_OK, "id": 9}), path, reuse=False)
    assert [r["id"] for r in scan().collect()] == [9]


def test_a_half_written_month_is_completed(spark, tmp_path):
    path = str(tmp_path / "landed")
    both = records(spark, RECORD_OK, {**RECORD_OK, "id": 9})
    landing.land_month(both, path)
    assert landing.landed_months(spark, path) == ["2024-01"]
    # as a failure would leave it: some files, no mark
    folder = tmp_path / "landed" / "file_month=2024-01"
    (tmp_path / "landed" / "_landed" / "2024-01").unlink()
    for file in folder.glob("part-*"):
        file.write_text(json.dumps({**RECORD_OK, "id": 9}) + "\n")
    assert landing.landed_months(spark, path) == []
    landing.land_month(both, path)
    found = landing.good_records(landing.scan_incident_json(spark, path, multi_line=False)).collect()
    assert sorted(r["id"] for r in found) == [9, 47110] and landing.landed_months(spark, path) == ["2024-01"]


def test_only_folders_of_the_months_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "landed")
    more = records(spark, RECORD_OK).unionByName(records(spark, {**RECORD_OK, "id": 5, "month": "2024-02"}).withColumn("file_month", F.lit("2024-02")))
    landing.land_month(more, path)
    write_month(tmp_path / "landed", "2024-02", [{**RECORD_OK, "id": 6, "month": "2024-02"}])
    scan = landing.scan_incident_json(spark, path, multi_line=False, only_months=["2024-02"])
    assert not any("2024-01" in f for f in scan.inputFiles())
    assert store.ingest_months(spark, path, str(tmp_path / "t"), months=["2024-02", "2031-01"], multi_line=False) == 2


def times(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet") if "month=" in str(f)}


def test_a_build_rewrites_changed_months_only(spark, tmp_path):
    from streetlens.plans.build import build

    place = lambda i, month, lat: {**RECORD_OK, "id": i, "month": month, "location": {**RECORD_OK["location"], "latitude": str(lat)}}
    write_month(tmp_path / "in", "2024-01", [place(1, "2024-01", 53.36), place(2, "2024-01", 53.42)])
    write_month(tmp_path / "in", "2024-02", [place(3, "2024-02", 53.40)])
    run = lambda: build(spark, str(tmp_path / "in"), str(tmp_path / "out"), with_eda=False)
    assert run().count() == 3
    parts = [tmp_path / "out" / name for name in ("clean", "features", "aggregates")]
    before = [times(p) for p in parts]
    run()
    assert [times(p) for p in parts] == before  # nothing new, nothing written
    write_month(tmp_path / "in", "2024-03", [place(4, "2024-03", 53.41)])
    write_month(tmp_path / "in" , "2024-02", [place(3, "2024-02", 53.40), place(5, "2024-02", 53.39)])
    assert run().count() == 5
    for old, new in zip(before, (times(p) for p in parts)):
        kept = {f: t for f, t in old.items() if "month=2024-01" in f}
        assert kept and all(new[f] == t for f, t in kept.items())
        assert not any(f in new for f in old if "month=2024-02" in f) and any("month=2024-03" in f for f in new)
    monthly = {str(r["month_date"])[:7]: r["crime_count"] for r in spark.read.parquet(f"{tmp_path}/out/aggregates/agg_monthly").collect()}
    assert monthly == {"2024-01": 2, "2024-02": 2, "2024-03": 1}
    # the extent of the grid moves: features of all months follow, clean months stay
    write_month(tmp_path / "in", "2024-04", [place(6, "2024-04", 53.44)])
    clean, features = times(parts[0]), times(parts[1])
    gold = run()
    assert all(times(parts[0])[f] == t for f, t in clean.items()) and not set(features) & set(times(parts[1]))
    whole = build(spark, str(tmp_path / "in"), str(tmp_path / "fresh"), with_eda=False)
    columns = [c for c in whole.columns if c != "id"]
    assert sorted(map(str, gold.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))


def bronze(spark, file, *rows):
    base = dict.fromkeys(BRONZE_COLUMNS)
    fill = {"category": "burglary", "month": "2024-01", "latitude": 53.4, "longitude": -1.4}
    schema = T.StructType([f for f in BRONZE if f.name != "id"])
    df = spark.createDataFrame([tuple({**base, **fill, **r}[c] for c in BRONZE_COLUMNS) for r in rows], schema)
    return df.withColumn("source_file", F.lit(file))


def test_insert_or_ignore(spark, tmp_path):
    path = str(tmp_path / "incidents")
    assert store.load_raw(spark, path).count() == 0
    first = bronze(spark, "one", {"api_id": 1, "street_name": "a"}, {"api_id": 1, "street_name": "b"}, {"api_id": None}, {"api_id": None},
                   {"api_id": 2, "category": None}, {"api_id": 3, "latitude": None})
    assert store.insert_or_ignore(first, path, order_by=("street_name",)) == 3
    assert [r["street_name"] for r in store.load_raw(spark, path).filter("api_id = 1").collect()] == ["a"]
    # the same files once more, rows in another order: nothing is added, null keys neither
    assert store.insert_or_ignore(first.repartition(3), path, order_by=("street_name",)) == 0
    # known key ignored, null id of another file never conflicts, another month is another key
    again = bronze(spark, "two", {"api_id": 1}, {"api_id": None}, {"api_id": 1, "month": "2024-02"}, {"api_id": 4, "month": "soon"})
    assert store.insert_or_ignore(again, path) == 3
    table = store.load_raw(spark, path)
    assert table.count() == table.select("id").distinct().count() == 6 and table.filter("id IS NULL").count() == 0
    assert store.insert_or_ignore(again, path) == 0


def test_repeated_stream_batch_adds_nothing(spark, tmp_path):
    nameless = {**RECORD_OK, "id": None}
    write_month(tmp_path / "in", "2024-01", [RECORD_OK, nameless, nameless])
    write_month(tmp_path / "in", "2024-02", "oops")
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    for state in ("a", "b"):  # a lost state makes the stream deliver the batch again
        incremental_load(spark, str(tmp_path / "in"), table, str(tmp_path / state), bad, multi_line=True)
        assert store.load_raw(spark, table).count() == 3 and spark.read.parquet(bad).count() == 1


def test_ingest_skips_bad_month_and_is_idempotent(spark, tmp_path):
    write_month(tmp_path / "in", "2024-01", [RECORD_OK, {**RECORD_OK, "id": 47111}, {"id": 1, "location": {}}])
    write_month(tmp_path / "in", "2024-02", "oops")
    write_month(tmp_path / "in", "2024-03", [])
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    assert store.ingest_months(spark, str(tmp_path / "in"), table, bad) == 2
    assert store.ingest_months(spark, str(tmp_path / "in"), table) == 0
    assert spark.read.parquet(bad).count() == 1
    assert store.ingest_months(spark, str(tmp_path / "in"), str(tmp_path / "t2"), months=["2024-03"]) == 0


def test_incremental_load_equals_batch(spark, tmp_path):
    landed, table = tmp_path / "in", str(tmp_path / "stream")
    write_month(landed, "2024-02", [RECORD_OK | {"month": "2024-02"}, RECORD_OK | {"id": 7, "month": "2024-02"}])
    load = lambda: incremental_load(spark, str(landed), table, str(tmp_path / "state"), multi_line=True)
    load()
    # a late file for an older month, and a republished one
    write_month(landed, "2024-01", [RECORD_OK])
    write_month(landed / "again", "2024-02", [RECORD_OK | {"month": "2024-02"}, RECORD_OK | {"id": 8, "month": "2024-02"}])
    load()
    load()
    rows = {(r["month"], r["api_id"]) for r in store.load_raw(spark, table).collect()}
    assert rows == {("2024-02", 47110), ("2024-02", 7), ("2024-01", 47110), ("2024-02", 8)}
    assert store.load_raw(spark, table).count() == 4

import pyarrow as pa
import pytest

from files import damaged_file, damaged_page, raw_file
from farelake.operators.quality import QualityError
from farelake.plans import ingest as ing
from farelake.schemas import BRONZE_SCHEMA
from farelake.sources import trips, zones as zone_source
from farelake.sinks.tables import ensure_layer

GRID = {"years": [2024], "months": [1, 2, 3]}


@pytest.fixture
def layer(spark):
    """A fresh database per test."""
    name = f"bronze_{layer.counter}"
    layer.counter += 1
    ensure_layer(spark, name)
    return name


layer.counter = 0


def load(spark, folder, layer, policy="replace", **grid):
    return ing.ingest(spark, str(folder), **{**GRID, **grid}, table=f"{layer}.trips",
                      coverage_table=f"{layer}.coverage", policy=policy)


def covered(spark, layer):
    return {(r["year_month"], r["service_type"]): (r["status"], r["row_count"])
            for r in spark.table(f"{layer}.coverage").collect()}


def test_ingest_with_drift_damage_and_missing_months(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3)
    raw_file(tmp_path, "yellow", "2024-02", 4, pa.int64(), {"cbd_congestion_fee": 0.75, "Surprise": 1})
    damaged_file(tmp_path, "yellow", "2024-03")
    raw_file(tmp_path, "green", "2024-01", 5, without=("congestion_surcharge",))
    raw_file(tmp_path, "green", "2023-12", 5)  # outside the calendar
    status = {(r["service_type"], r["source_month"]): (r["status"], r["row_count"])
              for r in load(spark, tmp_path, layer).collect()}
    assert status == {("yellow", "2024-01"): ("loaded", 3), ("yellow", "2024-02"): ("loaded", 4),
                      ("yellow", "2024-03"): ("failed", 0), ("green", "2024-01"): ("loaded", 5),
                      ("green", "2024-02"): ("missing", 0), ("green", "2024-03"): ("missing", 0)}
    assert covered(spark, layer) == {
        ("2024-01", "yellow"): ("loaded", 3), ("2024-02", "yellow"): ("loaded", 4),
        ("2024-03", "yellow"): ("failed", 0), ("2024-01", "green"): ("loaded", 5),
        ("2024-02", "green"): ("missing", 0), ("2024-03", "green"): ("missing", 0)}
    bronze = spark.table(f"{layer}.trips")
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    assert bronze.where("mta_tax IS NULL").count() == 3  # NaN
    assert bronze.where("cbd_congestion_fee = 0.75").count() == 4
    assert bronze.where("service_type = 'green' AND congestion_surcharge IS NULL AND trip_type = 2").count() == 5
    assert bronze.select("ingest_ts").distinct().count() == 1


def test_reload_is_idempotent_and_replaces_only_its_month(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3)
    raw_file(tmp_path, "yellow", "2024-02", 4)
    first = load(spark, tmp_path, layer)
    assert ing.ingest_summary(first).first().asDict() == {
        "total_inserted": 7, "files_processed": 2, "failed": 0, "skipped": 0, "missing": 4}
    load(spark, tmp_path, layer)
    assert spark.table(f"{layer}.trips").count() == 7
    raw_file(tmp_path, "yellow", "2024-02", 9)
    load(spark, tmp_path, layer, months=[2])
    assert {k: v[1] for k, v in ((r[:2], r[2:]) for r in map(tuple, ing.loaded_months(
        spark.table(f"{layer}.trips")).selectExpr("source_month", "service_type", "1", "row_count").collect()))} == {
        ("2024-01", "yellow"): 3, ("2024-02", "yellow"): 9}


def test_empty_file_empties_its_month(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3)
    raw_file(tmp_path, "yellow", "2024-02", 3)
    load(spark, tmp_path, layer)
    raw_file(tmp_path, "yellow", "2024-02", 0)
    load(spark, tmp_path, layer)
    assert covered(spark, layer)["2024-02", "yellow"] == ("failed", 0)
    assert covered(spark, layer)["2024-01", "yellow"] == ("loaded", 3)


def test_damaged_data_page_does_not_stop_the_others(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3)
    damaged_page(tmp_path, "yellow", "2024-02")
    raw_file(tmp_path, "green", "2024-02", 4)
    status = {r["filename"]: (r["status"], bool(r["error"])) for r in load(spark, tmp_path, layer).collect()
              if r["status"] != "missing"}
    assert status == {"yellow_tripdata_2024-01.parquet": ("loaded", False),
                      "yellow_tripdata_2024-02.parquet": ("failed", True),
                      "green_tripdata_2024-02.parquet": ("loaded", False)}
    assert spark.table(f"{layer}.trips").count() == 7


def test_failed_file_leaves_its_whole_month(spark, tmp_path, layer):
    (tmp_path / "deep").mkdir()
    raw_file(tmp_path, "yellow", "2024-01", 3)
    raw_file(tmp_path / "deep", "yellow", "2024-01", 4)
    damaged_page(tmp_path, "yellow", "2024-02")  # makes the joint job fail
    rows = load(spark, tmp_path, layer)
    status = sorted((r["source_month"], r["status"], r["row_count"]) for r in rows.collect() if r["service_type"] == "yellow")
    assert status == [("2024-01", "loaded", 3), ("2024-01", "loaded", 4), ("2024-02", "failed", 0), ("2024-03", "missing", 0)]
    assert ing.ingest_summary(rows).first()["total_inserted"] == 7 == spark.table(f"{layer}.trips").count()
    damaged_file(tmp_path / "deep", "yellow", "2024-01")
    raw_file(tmp_path, "yellow", "2024-01", 50)
    rows = [r for r in load(spark, tmp_path, layer).collect() if r["source_month"] == "2024-01" and r["service_type"] == "yellow"]
    assert [r["status"] for r in rows] == ["failed", "failed"]
    assert spark.table(f"{layer}.trips").count() == 7  # as before
    assert all("\n" in r["error"] or len(r["error"]) > 60 for r in rows)  # the whole reason


def test_columns_without_a_place_are_reported(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3, extra={"Surprise": 1, "Other": 2})
    raw_file(tmp_path, "green", "2024-01", 3)
    rows = {r["service_type"]: r["columns_left_out"] for r in load(spark, tmp_path, layer, months=[1]).collect()}
    assert rows == {"yellow": "Other, Surprise", "green": None}


def test_skip_policy(spark, tmp_path, layer):
    raw_file(tmp_path, "yellow", "2024-01", 3)
    load(spark, tmp_path, layer, policy="skip")
    raw_file(tmp_path, "yellow", "2024-01", 30)
    raw_file(tmp_path, "yellow", "2024-02", 4)
    status = {r["source_month"]: r["status"] for r in load(spark, tmp_path, layer, policy="skip").collect()
              if r["service_type"] == "yellow"}
    assert status == {"2024-01": "skipped", "2024-02": "loaded", "2024-03": "missing"}
    assert spark.table(f"{layer}.trips").count() == 7


def test_no_files_fails(spark, tmp_path, layer):
    (tmp_path / "readme.txt").write_text("nothing here")
    with pytest.raises(QualityError, match="is empty"):
        load(spark, tmp_path, layer)


def test_discovery_and_folders_of_part_files(spark, tmp_path):
    raw_file(tmp_path, "green", "2024-02")
    spark.read.parquet(raw_file(tmp_path, "yellow", "2024-01", 8)).repartition(2).write.parquet(
        str(tmp_path / "yellow_tripdata_2024-03.parquet"))
    found = trips.discover_files(spark, str(tmp_path), **GRID).orderBy("source_month").collect()
    assert [(r["filename"], r["service_type"], r["source_month"], r["year"], r["month"]) for r in found] == [
        ("yellow_tripdata_2024-01.parquet", "yellow", "2024-01", 2024, 1),
        ("green_tripdata_2024-02.parquet", "green", "2024-02", 2024, 2),
        ("yellow_tripdata_2024-03.parquet", "yellow", "2024-03", 2024, 3)]
    both = trips.scan_trips(spark, str(tmp_path), "yellow", ["2024-01", "2024-03"])
    assert {tuple(r) for r in both.groupBy("source_month").count().collect()} == {("2024-01", 8), ("2024-03", 8)}
    with pytest.raises(FileNotFoundError):
        trips.scan_trips(spark, str(tmp_path), "yellow", ["2024-12"])


def test_trip_csv(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("VendorID,passenger_count,tpep_pickup_datetime\n1,2.0,2024-01-01 00:00:00\n2,,2024-01-01 01:00:00\n")
    assert trips.scan_trips_csv(spark, str(path)).dtypes == [
        ("VendorID", "int"), ("passenger_count", "double"), ("tpep_pickup_datetime", "timestamp")]
    path.write_text("VendorID,passenger_count\n1,two\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        trips.scan_trips_csv(spark, str(path), "VendorID long, passenger_count double").collect()
    path.write_text("VendorID,passenger_count,tpep_pickup_datetime\n1,2.0,x\n")
    fixed = trips.scan_trips_csv(spark, str(path), "VendorID long, passenger_count double, t string")
    assert fixed.first()["VendorID"] == 1


def test_zone_sources(spark, zone_csv, tmp_path, layer):
    table = f"{layer}.taxi_zone_lookup"
    assert zone_source.load_zones_if_missing(spark, zone_csv, table) == 4
    rows = {r["LocationID"]: (r["Borough"], r["Zone"], r["service_zone"]) for r in spark.table(table).collect()}
    assert rows == {1: ("EWR", "Airport One", "EWR"), 2: ("Queens", "Bay, Two", "Boro Zone"),
                    264: ("Unknown", None, None), 265: (None, "Outside", None)}
    more = tmp_path / "more.csv"
    more.write_text('"LocationID","Borough","Zone","service_zone"\n7,"Bronx","Seven","Boro Zone"\n')
    assert zone_source.load_zones_if_missing(spark, str(more), table) == 4  # kept
    assert zone_source.load_zones(spark, str(more), table).count() == 1  # replaced
    seed = {r["LocationID"]: r["Zone"] for r in zone_source.load_seed(spark, zone_csv).collect()}
    assert seed[264] == "N/A"
    more.write_text('"LocationID","Borough","Zone","service_zone"\n7,"a","b","c"\n7,"a","b","c"\n')
    with pytest.raises(QualityError):
        zone_source.load_seed(spark, str(more))

from decimal import Decimal

import pytest

from conftest import final_plan, ts
from farelake.operators.clean import apply_defaults, clean_trips
from farelake.plans.fact import fct_trips
from farelake.plans.silver import silver_base, silver_green, silver_unified, silver_yellow
from farelake.schemas import FACT_COLUMNS, SILVER_COLUMNS, ZONE_NAME_COLUMNS


def test_clean_filter(bronze):
    bad = [
        {"pickup_datetime": None}, {"dropoff_datetime": None}, {"pu_location_id": None}, {"do_location_id": None},
        {"trip_distance": -1.0}, {"total_amount": -0.01}, {"trip_distance": None}, {"total_amount": None},
        {"dropoff_datetime": ts("2024-03-05 09:59:59")},
    ]
    assert clean_trips(bronze(bad)).count() == 0
    edge = {"dropoff_datetime": ts("2024-03-05 10:00:00"), "trip_distance": 0.0, "total_amount": 0.0}
    assert clean_trips(bronze([edge, {}])).count() == 2


def test_defaults(bronze):
    empty = {c: None for c in ("passenger_count", "ratecode_id", "store_and_fwd_flag", "payment_type", "trip_type",
                               "fare_amount", "airport_fee")}
    row = apply_defaults(bronze([empty])).first()
    assert [row[c] for c in empty] == [1, 1, "N", 5, 1, 0, 0]


def test_yellow_types_and_zones(bronze, zones):
    df = silver_yellow(bronze([
        {"passenger_count": 1.5, "fare_amount": 0.125, "dropoff_datetime": ts("2024-03-05 10:01:30.500")},
        {"passenger_count": 2.5, "fare_amount": None, "do_location_id": 999},
        {"service_type": "green"},
    ]), zones)
    first, second = df.orderBy("passenger_count", "fare_amount", ascending=[True, False]).collect()
    assert first["passenger_count"] == second["passenger_count"] == 2
    assert first["fare_amount"] == Decimal("0.13") and second["fare_amount"] == Decimal("0.00")
    assert first["trip_duration_minutes"] == pytest.approx(90.5 / 60)
    assert (first["pu_borough"], first["do_borough"], first["do_service_zone"]) == ("EWR", "Queens", "Boro Zone")
    assert second["do_borough"] is None and second["do_zone_name"] is None
    assert first["pickup_day_of_week"] == 2 and first["pickup_hour"] == 10


def test_unified_columns_and_duplicates(bronze, zones):
    trips = bronze([{}, {}, {"service_type": "green", "trip_type": 2.0, "airport_fee": 9.0},
                    {"service_type": "green", "trip_type": None}])
    yellow, green = silver_yellow(trips, zones), silver_green(trips, zones)
    assert "trip_type" not in yellow.columns and "airport_fee" not in green.columns
    unified = silver_unified(yellow, green)
    assert tuple(unified.columns) == SILVER_COLUMNS and len(SILVER_COLUMNS) == 33
    rows = unified.collect()
    assert len(rows) == 4
    assert sorted(str(r["trip_type"]) for r in rows) == ["1", "2", "None", "None"]
    assert {r["airport_fee"] for r in rows if r["service_type"] == "green"} == {Decimal("0.00")}
    # The join-free form gives the same rows.
    base = silver_base(trips)
    rest = [c for c in SILVER_COLUMNS if c not in ZONE_NAME_COLUMNS]
    assert tuple(base.columns) == tuple(rest)
    assert sorted(map(str, base.collect())) == sorted(map(str, unified.select(rest).collect()))


def test_zone_lookup_is_broadcast_only_when_small(spark, bronze, zones, tmp_path):
    bronze([{}]).write.parquet(str(tmp_path / "t"))
    zones.write.parquet(str(tmp_path / "z"))
    trips, lookup = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "z"))
    assert final_plan(silver_yellow(trips, lookup)).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in final_plan(silver_yellow(trips, lookup))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_reach_the_scan(spark, bronze, tmp_path):
    bronze([{}]).write.partitionBy("service_type", "source_month").parquet(str(tmp_path / "t"))
    base = silver_base(spark.read.parquet(str(tmp_path / "t")))
    text = final_plan(fct_trips(base, "2024-01-01", "2025-01-01").select("pickup_date_key", "total_amount"))
    for pushed in ("GreaterThanOrEqual(trip_distance,0.0)", "GreaterThanOrEqual(total_amount,0.0)",
                   "GreaterThanOrEqual(pickup_datetime,2024-01-01T00:00)", "LessThan(pickup_datetime,2025-01-01T00:00)"):
        assert pushed in text
    assert "service_type" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "store_and_fwd_flag" not in text.split("ReadSchema")[1]


def test_fact_domain_and_types(bronze):
    times = ["2021-12-31 23:59", "2022-01-01 00:00", "2025-12-31 23:59", "2026-01-01 00:00"]
    trips = bronze([{"pickup_datetime": ts(t), "dropoff_datetime": ts("2026-01-02 00:00")} for t in times])
    fact = fct_trips(silver_base(trips))
    assert fact.columns == [c for c in FACT_COLUMNS if c != "trip_key"]
    assert [str(r["pickup_date_key"]) for r in fact.orderBy("pickup_datetime").collect()] == ["2022-01-01", "2025-12-31"]
    odd = fct_trips(silver_base(bronze([{
        "vendor_id": 6, "payment_type": 0.0, "ratecode_id": 99.0, "dropoff_datetime": ts("2024-03-05 10:01:30.500")}])))
    row = odd.first()
    assert (row["vendor_id"], row["payment_type_id"], row["ratecode_id"]) == (6, 0, 99)
    assert row["trip_duration_minutes"] == Decimal("1.51")
    assert dict(odd.dtypes)["trip_distance"] == "decimal(10,2)"
    assert fct_trips(silver_base(bronze([{"vendor_id": None}]))).first()["vendor_id"] == 0

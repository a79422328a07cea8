import pytest

from conftest import final_plan, ts
from farelake.plans import analytics as a, dims, passengers
from farelake.plans.fact import fct_trips
from farelake.plans.silver import silver_base


@pytest.fixture(scope="module")
def fact(bronze):
    def at(month, day=5, hour=10):
        return {"pickup_datetime": ts(f"2024-{month:02d}-{day:02d} {hour:02d}:00:00"),
                "dropoff_datetime": ts(f"2024-{month:02d}-{day:02d} {hour:02d}:30:00")}
    rows = [
        {**at(1), "pu_location_id": 3, "do_location_id": 2}, {**at(1), "pu_location_id": 3, "do_location_id": 2},
        {**at(1, hour=20), "pu_location_id": 2, "do_location_id": 3, "payment_type": 2.0, "tip_amount": 0.0},
        {**at(2), "pu_location_id": 264}, {**at(2), "pu_location_id": 265}, {**at(2), "pu_location_id": 999},
        {**at(2, 6), "pu_location_id": 2, "fare_amount": 0.0, "tip_amount": 3.0, "payment_type": 2.0},
        {**at(2, 6), "pu_location_id": 2, "payment_type": 0.0, "trip_distance": 0.0},
        {"pickup_datetime": ts("2023-12-31 23:59:59"), "dropoff_datetime": ts("2024-01-01 00:10:00")},
    ]
    return fct_trips(silver_base(bronze(rows)))


@pytest.fixture(scope="module")
def zone_dim(zones):
    return dims.dim_zone(zones)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_windows_and_defaults(fact):
    assert [r[1] for r in rows(a.trips_per_month(fact))] == [3, 5]
    assert len(rows(a.trips_per_month_service(fact))) == 3  # all dates
    assert len(rows(a.trips_per_month_service(fact, a.START, a.END))) == 2
    bounds = a.fact_bounds(fact).first()
    assert (bounds["rows"], str(bounds["min_date"]), str(bounds["max_date"])) == (9, "2023-12-31", "2024-02-06")


def test_rankings_keep_unnamed_boroughs_and_drop_unknown_zones(fact, zone_dim):
    top = rows(a.top_zones(fact, zone_dim, k=10))
    assert top[0][2] == 3 and sum(r[2] for r in top) == 7  # zone 999 is not in the dimension
    assert (None, "Unknown", 1) in top and ("Outside", None, 1) in top
    assert rows(a.top_zones(fact, zone_dim, k=1)) == top[:1]
    by_month = rows(a.top_boroughs_per_month(fact, zone_dim))
    assert [r[1] for r in by_month] == ["Manhattan", "Queens", "Queens", "Unknown", None]
    known = rows(a.top_boroughs_per_month(fact, zone_dim, exclude="Unknown"))
    assert [r[1] for r in known] == ["Manhattan", "Queens", "Queens"]
    assert rows(a.top_boroughs_per_month(fact, zone_dim, k=1))[0][1] == "Manhattan"


def test_tip_rules(spark, fact, zone_dim):
    assert dict(rows(a.tip_pct_per_month(fact))).values()
    feb = rows(a.tip_pct_by_borough(fact, zone_dim))
    assert [round(r[2], 6) for r in feb if r[1] == "Queens"] == [0.0, 0.2]  # the free ride is left out
    cash, card = sorted(rows(a.cash_vs_card(fact, dims.dim_payment_type(spark))), reverse=True)
    assert (cash[0], cash[1], float(cash[2]), cash[3]) == ("cash", 2, 28.0, 0.0)  # counted, but without a ratio
    assert card[1] == 5  # payment 0 has no dimension row
    assert rows(a.top_zones_by_tip(fact, zone_dim, min_trips=2))[0][0] == "Town Three"
    assert rows(a.top_zones_by_tip(fact, zone_dim)) == []


def test_speed_and_percentiles(fact, zone_dim):
    speeds = {(r[0], r[1]): r[2] for r in rows(a.speed_by_borough_band(fact, zone_dim))}
    assert speeds["Manhattan", "morning"] == pytest.approx(6.0)
    assert ("Queens", "evening") in speeds and len(speeds) == 5
    assert all(r[1] == r[2] == 30.0 for r in rows(a.duration_percentiles(fact, zone_dim)))
    assert len(rows(a.top_zones_by_p90(fact, zone_dim, k=2))) == 2
    assert rows(a.top_routes(fact, zone_dim))[0] == ("Manhattan", "Queens", 2)
    assert rows(a.peak_hours(fact, k=1))
    assert sum(r[1] for r in rows(a.trips_by_dow(fact))) == 8


def test_names_are_joined_after_grouping(spark, fact, zone_dim, tmp_path):
    fact.write.parquet(str(tmp_path / "f"))
    zone_dim.write.parquet(str(tmp_path / "z"))
    stored, zones = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "z"))
    text = final_plan(a.top_zones(stored, zones))
    # Below the join there is a complete aggregate over the fact.
    assert "HashAggregate" in text.split("BroadcastHashJoin")[1]
    assert "TakeOrderedAndProject" in text
    assert "total_amount" not in text


PASSENGERS = '''PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked
1,0,3,"Braund, Mr. ""Owen""",male,22,1,0,A/5,7.25,,S
2,1,1,"Cumings, Mrs.",female,,1,0,PC,71.2833,C85,C
3,1,3,"Heikkinen, Miss",female,26,0,0,ST,,,S
4,0,2,"Allen, Mr.",male,35,0,0,37,8.05,,S
'''


def test_passenger_list(spark, tmp_path):
    source, target = tmp_path / "in.csv", tmp_path / "out"
    source.write_text(PASSENGERS)
    passengers.clean_passengers(spark, str(source), str(target))
    got = sorted(rows(spark.read.csv(str(target), header=True, inferSchema=True)))
    assert got == sorted([(22.0, 7.25, 0, 3, 1, 0), (26.0, 71.2833, 0, 1, 1, 1), (26.0, 8.05, 0, 3, 0, 1),
                          (35.0, 8.05, 0, 2, 0, 0)])


def test_multi_passenger_trips(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:01:30", 2.0), ("2024-01-01 00:00:00", "2024-01-01 00:01:30", 1.0),
         ("2024-01-01 00:00:00", "2024-01-01 00:01:30", None)],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double")
    spark.sql("CREATE DATABASE IF NOT EXISTS small")
    table = passengers.load_multi_passenger_trips(df, "small.yellow_trips")
    assert [(r["trip_duration_minutes"], r["passenger_count"]) for r in table.collect()] == [(1.5, 2.0)]

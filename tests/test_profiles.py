import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from farelake.operators import quality
from farelake.plans import profiles, silver, suite
from farelake.sinks import tables as sinks


def counts(df, *names):
    return {tuple(row[name] for name in names): row["n"] for row in df.collect()}


@pytest.fixture(scope="module")
def small(spark):
    rows = [("m1", 1, "a"), ("m1", 1, None), ("m1", None, "a"), ("m2", 2, "b"), ("m2", 2, "b")]
    return spark.createDataFrame(rows, "month string, k int, t string")


def test_profile_counts_rows_nulls_rules_and_values(small):
    made = profiles.profile(small, ["k"], ["k", "t", "k"], {"big": F.col("k") > 1}, "month")
    assert counts(made, "part", "measure", "value") == {
        ("m1", "rows", None): 3, ("m2", "rows", None): 2, ("m1", "null:k", None): 1, ("m2", "null:k", None): 0,
        ("m1", "rule:big", None): 0, ("m2", "rule:big", None): 2,
        ("m1", "value:k", "1"): 2, ("m1", "value:k", None): 1, ("m2", "value:k", "2"): 2,
        ("m1", "value:t", "a"): 2, ("m1", "value:t", None): 1, ("m2", "value:t", "b"): 2}


def test_profiles_of_partitions_add_up_to_the_profile_of_the_table(small):
    arguments = (["k", "t"], ["t", "k"], {"big": F.col("k") > 1})
    whole = counts(profiles.profile(small, *arguments), "measure", "value")
    assert counts(profiles.merged([profiles.profile(small, *arguments, "month")]), "measure", "value") == whole
    halves = [profiles.profile(small.where(F.col("month") == month), *arguments) for month in ("m1", "m2")]
    assert counts(profiles.merged(halves), "measure", "value") == whole


def test_empty_tables_and_tables_without_value_columns(small):
    nothing = small.where("false")
    assert profiles.profile(nothing, ["k"]).isEmpty() and profiles.profile(nothing, ["k"], ["t"], by="month").isEmpty()
    found = suite.suite_results({"nothing": nothing}, [suite.TableTests("nothing", ("k",), ("k",), {"t": ("a",)})]).collect()
    assert sorted((row["test"], row["failures"]) for row in found) == [
        ("accepted_values_nothing_t", 0), ("not_null_nothing_k", 0), ("unique_nothing_k", 0)]
    assert counts(profiles.profile(small, by="month"), "part", "measure") == {("m1", "rows"): 3, ("m2", "rows"): 2}


@pytest.fixture(scope="module")
def stored(spark, bronze, zones):
    """Three months of bronze in a partitioned table, with the two service views and the base over it."""
    sinks.ensure_layer(spark, "p_bronze")
    trips = bronze([{"source_month": f"2024-0{m}", "service_type": s, "trip_type": 1.0 if s == "green" else None}
                    for m in (1, 2, 3) for s in ("yellow", "green") for _ in range(m)])
    sinks.replace_partitions(trips, "p_bronze.trips", ("service_type", "source_month"))

    def make():
        now = spark.table("p_bronze.trips")
        return {"silver_yellow_trips": silver.silver_yellow(now, zones), "silver_green_trips": silver.silver_green(now, zones),
                "silver_trips_unified": silver.silver_base(now), "taxi_zone_lookup": zones}
    return make


SILVER = [tests for tests in suite.SUITE if tests.table.startswith("silver_")]


def test_three_scans_of_bronze_for_all_silver_tests(stored):
    results = suite.suite_results(stored(), SILVER)
    assert len(re.findall(r"FileScan parquet [\w.]*p_bronze\.trips", plan(results))) == 3
    assert {row["status"] for row in results.collect()} == {"pass"}


def test_refresh_reads_the_changed_month_only(spark, bronze, zones, stored):
    store, months = "p_bronze.profiles", ["2024-01", "2024-02", "2024-03"]
    suite.refresh_profiles(stored(), store, months, SILVER)
    results = lambda: counts(suite.suite_results(
        stored(), SILVER, suite.stored_profiles(stored(), store, SILVER)).withColumnRenamed("failures", "n"), "test")
    assert set(results().values()) == {0}
    # One month gets trips to an unknown zone, another loses all of its yellow trips.
    sinks.replace_partitions(bronze([{"source_month": "2024-02", "do_location_id": 77}] * 4), "p_bronze.trips",
                             ("service_type", "source_month"))
    spark.sql("ALTER TABLE p_bronze.trips DROP PARTITION (service_type = 'yellow', source_month = '2024-01')")
    tests = SILVER[0]
    scan = plan(suite.table_profile(tests, stored()[tests.table].where(F.col(suite.MONTH).isin("2024-02")), suite.MONTH))
    assert re.search(r"PartitionFilters: \[[^\]]*source_month[^\]]* = 2024-02", scan)
    before = counts(profiles.stored_profile(spark, tests.table, store), "part", "measure", "value")
    suite.refresh_profiles(stored(), store, ["2024-01", "2024-02"], SILVER)
    after = counts(profiles.stored_profile(spark, tests.table, store), "part", "measure", "value")
    assert {k: n for k, n in after.items() if k[0] == "2024-01"} == {("2024-01", "rows", None): 0}
    assert {k: n for k, n in after.items() if k[0] == "2024-03"} == {k: n for k, n in before.items() if k[0] == "2024-03"}
    fresh = counts(suite.suite_results(stored(), SILVER).withColumnRenamed("failures", "n"), "test")
    assert results() == fresh
    assert fresh["relationships_silver_yellow_trips_do_location_id",] == 4


def test_keys_of_another_type_and_null_parents(spark):
    child = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "k double")
    parent = spark.createDataFrame([(1,), (None,)], "id long")
    tests = suite.TableTests("child", ("k",), (), {}, {"k": ("parent", "id")})
    found = counts(suite.suite_results({"child": child, "parent": parent}, [tests]).withColumnRenamed("failures", "n"), "test")
    assert found == {("not_null_child_k",): 1, ("relationships_child_k",): 2}
    assert quality.relationships(child, "k", parent, "id").count() == 2

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from farelake.operators.quality import QualityError
from farelake.plans import analytics, build, ingest, layout, marts, suite
from farelake.plans.silver import silver_base
from farelake.sinks.releases import new_release, published
from farelake.sinks.tables import ensure_layer, replace_table
from farelake.sources import star

FOLDER = "/root/testdata/sf0.001"
CONFIG = build.BuildConfig("b_build.trips", "b_build.taxi_zone_lookup", "g_build", "1995-01-01", "2002-01-01")


@pytest.fixture(scope="module")
def built(spark):
    ensure_layer(spark, "b_build")
    ingest.replace_month(star.bronze_trips(spark, FOLDER, "1997-01-01", "1998-01-01").hint("rebalance", "service_type", "source_month"),
                         CONFIG.trips_table)
    replace_table(star.zone_lookup(spark, FOLDER), CONFIG.zones_table)
    return build.build_all(spark, CONFIG)


def test_all_44_tests_pass(built):
    results = built["test_results"].collect()
    assert len(results) == 44 and {r["status"] for r in results} == {"pass"}


def test_fact_invariants(spark, built):
    fact = built["fct_trips"]
    n = fact.count()
    assert n == built["silver_trips_unified"].count() > 0
    row = fact.agg(F.min("trip_key"), F.max("trip_key"), F.count_distinct("trip_key")).first()
    assert tuple(row) == (1, n, n)
    per_day = fact.groupBy("year_month").count().count()
    assert per_day == fact.select(F.date_format("pickup_date_key", "yyyy-MM")).distinct().count()
    daily = built["gold_daily_revenue"].agg(F.sum("total_revenue"), F.sum("total_trips")).first()
    monthly = built["gold_monthly_summary"].agg(F.sum("total_revenue"), F.sum("total_trips")).first()
    hourly = built["gold_hourly_patterns"].agg(F.sum("total_revenue"), F.sum("total_trips")).first()
    assert tuple(daily) == tuple(monthly) == tuple(hourly)
    assert daily[1] == n


def same(left, right):
    drop = [c for c in left.columns if c == "processed_at"]
    left, right = left.drop(*drop), right.select([c for c in left.columns if c not in drop])
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_marts_from_the_cube_equal_direct_marts(spark, built):
    base = silver_base(spark.table(CONFIG.trips_table))
    same(built["gold_daily_revenue"], marts.daily_revenue(base))
    same(built["gold_hourly_patterns"], marts.hourly_patterns(base))
    same(built["gold_monthly_summary"], marts.monthly_summary(base))
    assert "processed_at" in built["gold_zone_analytics"].columns


def test_sums_do_not_depend_on_the_partitioning(spark, built):
    """Equal to the last digit when the rows meet in another order."""
    base = silver_base(spark.table(CONFIG.trips_table))
    shuffled = [base.repartition(7, "fare_amount"), base.repartition(3, "dropoff_datetime").sortWithinPartitions("total_amount")]
    for mart in (marts.daily_revenue, marts.hourly_patterns, marts.monthly_summary):
        for other in shuffled:
            same(mart(base), mart(other))
    fact = built["fct_trips"]
    for question in (analytics.avg_duration_per_month, analytics.avg_distance_per_month):
        window = {"start": "1997-01-01", "end": "1998-01-01"}
        same(question(fact, **window), question(fact.repartition(5, "fare_amount"), **window))


def test_range_partitions_are_pruned(built):
    text = final_plan(layout.pruned_count(built["fct_trips"], "1997-03-01", "1997-03-31"))
    assert "year_month" in text.split("PartitionFilters: [")[1].split("]")[0]
    window = layout.in_window(built["fct_trips"], "1997-03-01", "1997-04-01")
    assert window.select("year_month").distinct().count() == 1
    scan = final_plan(window.select("trip_key"))
    assert "(year_month#" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_hash_buckets_are_pruned(spark, built):
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        text = final_plan(layout.zone_lookup(built["dim_zone"], 13))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in text
    assert layout.zone_lookup(built["dim_zone"], 13).count() == 1


def test_rows_outside_the_partitions_are_rejected(spark, built):
    fact = spark.table("g_build.fct_trips").drop("year_month")
    with pytest.raises(Exception, match="no partition of the fact"):
        layout.write_fact(fact, "g_build.narrow", "1997-03-01", "1998-01-01")
    with pytest.raises(Exception, match="no partition of the fact for date NULL"):
        layout.write_fact(fact.withColumn("pickup_date_key", F.lit(None).cast("date")), "g_build.narrow")
    bad = spark.createDataFrame([("yellow", "a"), ("blue", "b")], "service_type string, service_name string")
    with pytest.raises(Exception, match="no partition of g_build.services"):
        layout.write_list(bad, "g_build.services", "service_type", ["yellow", "green"])
    assert not spark.catalog.tableExists("g_build.narrow")


def test_list_partitions(built):
    assert built["dim_payment_type"].groupBy("payment_type").count().count() == 3
    assert built["dim_payment_type"].count() == 6 and built["dim_service_type"].count() == 2


def test_build_stops_on_an_empty_fact_and_on_repeated_zones(spark, built):
    outside = build.BuildConfig(CONFIG.trips_table, CONFIG.zones_table, "g_empty", "2030-01-01", "2031-01-01")
    with pytest.raises(QualityError, match="no rows"):
        build.build_all(spark, outside)
    assert not spark.catalog.tableExists("g_empty.gold_daily_revenue")
    zones = spark.table(CONFIG.zones_table)
    replace_table(zones.union(zones), "b_build.twice")
    with pytest.raises(QualityError, match="repeats"):
        build.build_all(spark, build.BuildConfig(CONFIG.trips_table, "b_build.twice", "g_empty"))


def test_suite_catches_one_bad_row_per_rule(spark, built):
    tables = dict(built)
    fact = tables["fct_trips"]
    first = fact.limit(1)
    tables["fct_trips"] = (
        fact.unionByName(first)  # repeated key
        .unionByName(first.withColumns({"trip_key": F.lit(None).cast("long"), "pu_zone_key": F.lit(999),
                                        "service_type": F.lit("blue"),
                                        "pickup_date_key": F.to_date(F.lit("2031-01-01"))}))
        .unionByName(first.withColumns({"trip_key": F.lit(-1).cast("long"), "pu_zone_key": F.lit(999),
                                        "do_zone_key": F.lit(None).cast("int")}))
    )
    unified = tables["silver_trips_unified"]
    tables["silver_trips_unified"] = unified.unionByName(unified.limit(1).withColumn(
        "total_amount", F.lit(-1).cast("decimal(10,2)")))
    tables["gold_daily_revenue"] = tables["gold_daily_revenue"].withColumn(
        "total_revenue", F.when(F.col("service_type") == "green", F.col("total_revenue")).otherwise(-1))
    tables["gold_hourly_patterns"] = tables["gold_hourly_patterns"].withColumn("pickup_hour", F.lit(24))
    tables["dim_payment_type"] = tables["dim_payment_type"].withColumn(
        "payment_type", F.when(F.col("payment_type") == "card", "coin").otherwise(F.col("payment_type")))
    failures = {r["test"]: r["failures"] for r in suite.suite_results(tables).collect() if r["failures"]}
    yellow_days = built["gold_daily_revenue"].where("service_type = 'yellow'").count()
    assert failures == {
        "unique_fct_trips_trip_key": 1, "not_null_fct_trips_trip_key": 1, "not_null_fct_trips_do_zone_key": 1,
        "relationships_fct_trips_pu_zone_key": 2, "relationships_fct_trips_pickup_date_key": 1,
        "accepted_values_fct_trips_service_type": 1, suite.TEMPORAL: 1, suite.COUNTS: 1, suite.REVENUE: yellow_days,
        suite.HOURS: 1, "accepted_values_dim_payment_type_payment_type": 1,
    }
    with pytest.raises(QualityError, match="unique_fct_trips_trip_key"):
        suite.run_suite(tables)


def test_zone_flows(spark, bronze, zones):
    def trip(pu, do, n):
        return [{"pu_location_id": pu, "do_location_id": do}] * n
    rows = bronze(trip(1, 2, 3) + trip(2, 1, 3) + trip(3, 4, 2) + trip(3, 999, 1) + trip(265, 5, 1))
    flows = {r["location_id"]: r for r in marts.zone_analytics(silver_base(rows), zones).collect()}
    assert set(flows) == {1, 2, 3, 4, 5}  # 999 has no zone, 265 no borough
    assert {k: (r["zone_flow_type"], r["net_flow"], r["total_trips"]) for k, r in flows.items()} == {
        1: ("Balanced", 0, 6), 2: ("Balanced", 0, 6), 3: ("Net Origin", 3, 3), 4: ("Net Destination", -2, 2),
        5: ("Net Destination", -1, 1)}
    assert float(flows[3]["avg_fare"]) == 14.0 and float(flows[4]["avg_fare"]) == 0.0


def test_marts_of_nothing_are_empty(bronze, zones):
    base = silver_base(bronze([{"total_amount": None}]))
    for mart in (marts.daily_revenue(base), marts.hourly_patterns(base), marts.monthly_summary(base),
                 marts.zone_analytics(base, zones)):
        assert mart.count() == 0


def test_three_kinds_of_tip_percentage(bronze):
    base = silver_base(bronze([{"fare_amount": 10.0, "tip_amount": 1.0}, {"fare_amount": 30.0, "tip_amount": 9.0},
                               {"fare_amount": 0.0, "tip_amount": 3.0}]))
    daily, monthly = marts.daily_revenue(base).first(), marts.monthly_summary(base).first()
    assert float(daily["avg_tip_percentage"]) == 20.0  # mean of 10 % and 30 %
    assert float(monthly["avg_tip_rate"]) == 32.5  # 13 of 40
    assert (monthly["active_days"], daily["trips_with_tips"]) == (1, 3)


def rows_of(spark, layer):
    """Rows of every table of the release, and of every name."""
    found = {name: df.count() for name, df in published(spark, layer).items()}
    return found, {name: spark.table(f"{layer}.{name}").count() for name in found}


def releases_of(spark, layer):
    return {row["namespace"] for row in spark.sql(f"SHOW DATABASES LIKE '{layer}__r*'").collect()}


def test_a_failing_test_publishes_nothing(spark, built):
    before, releases = rows_of(spark, "g_build"), releases_of(spark, "g_build")
    trips = spark.table(CONFIG.trips_table)
    ensure_layer(spark, "b_bad")
    ingest.replace_month(trips.limit(900).unionByName(trips.limit(1).withColumn("pu_location_id", F.lit(999))), "b_bad.trips")
    with pytest.raises(QualityError, match="relationships_fct_trips_pu_zone_key"):
        build.build_all(spark, build.BuildConfig("b_bad.trips", CONFIG.zones_table, "g_build", CONFIG.start, CONFIG.end))
    assert rows_of(spark, "g_build") == before and before[0] == before[1] and len(before[0]) == 11
    assert releases_of(spark, "g_build") == releases


def test_an_interrupted_build_is_removed_and_names_are_set_again(spark, monkeypatch):
    def publish(rows):
        with new_release(spark, "g_rel") as release:
            for name in ("a", "b"):
                replace_table(spark.range(rows), f"{release}.{name}")

    ensure_layer(spark, "g_rel")
    replace_table(spark.range(9), "g_rel.a")  # a plain table from before
    publish(1)
    assert rows_of(spark, "g_rel") == ({"a": 1, "b": 1},) * 2
    reader = published(spark, "g_rel")
    real = type(spark).sql

    def stopping(self, text, *args, **kwargs):
        if stop in text:
            raise KeyboardInterrupt
        return real(self, text, *args, **kwargs)

    # Before the switch nothing has changed; after it readers of the release see all of it, whatever the names show.
    for stop, rows in (("SET DBPROPERTIES", 1), ("OR REPLACE VIEW g_rel.b AS SELECT * FROM", 2)):
        monkeypatch.setattr(type(spark), "sql", real)
        if rows == 2:
            count = 0

            def stopping(self, text, *args, **kwargs):  # noqa: F811 - the second view of the new release
                nonlocal count
                count += stop in text
                if count == 2:
                    raise KeyboardInterrupt
                return real(self, text, *args, **kwargs)
        monkeypatch.setattr(type(spark), "sql", stopping)
        with pytest.raises(KeyboardInterrupt):
            publish(2)
        monkeypatch.undo()
        assert {name: df.count() for name, df in published(spark, "g_rel").items()} == {"a": rows, "b": rows}
        assert {df.count() for df in reader.values()} == {1}  # a running reader keeps its release
    publish(3)
    assert rows_of(spark, "g_rel") == ({"a": 3, "b": 3},) * 2
    assert len(releases_of(spark, "g_rel")) == 2  # the current one and the one before


def test_rebuild_gives_the_same_tables(spark, built):
    before = {n: spark.table(f"g_build.{n}").count() for n in ("fct_trips", "dim_zone", "gold_zone_analytics")}
    build.build_all(spark, CONFIG)
    assert before == {n: spark.table(f"g_build.{n}").count() for n in before}

"""The ordered build: bronze tables in, silver views, gold tables, tests; stops at the first failure.

The gold tables of a build are one release: they are published together, after all tests have passed.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions import money_of_double
from ..operators.quality import QualityError, require_rows, unique
from ..schemas import SERVICES
from ..session import Staging
from ..sinks.releases import new_release
from ..sinks.tables import register_view, replace_table
from . import dims, marts
from .fact import fct_trips, keyed_fact
from .layout import assert_not_empty, write_fact, write_list, write_zone
from .silver import silver_base, silver_green, silver_unified, silver_yellow
from .suite import PAYMENT_KINDS, run_suite

PARALLEL_TABLES = 4


@dataclass(frozen=True)
class BuildConfig:
    trips_table: str = "bronze.trips"
    zones_table: str = "bronze.taxi_zone_lookup"
    gold: str = "gold"
    start: str = dims.DATE_START
    end: str = dims.DATE_END


def build_silver(spark: SparkSession, config: BuildConfig = BuildConfig()) -> dict[str, DataFrame]:
    """Register the three silver views."""
    bronze, zones = spark.table(config.trips_table), spark.table(config.zones_table)
    yellow, green = silver_yellow(bronze, zones), silver_green(bronze, zones)
    views = {
        "silver_yellow_trips": yellow,
        "silver_green_trips": green,
        "silver_trips_unified": silver_unified(yellow, green),
    }
    return {name: register_view(df, name) for name, df in views.items()}


def _together(spark: SparkSession, steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Build independent tables side by side, so that the small stages of one do not leave the cluster idle."""
    run = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=PARALLEL_TABLES) as pool:
        running = {name: pool.submit(run(step)) for name, step in steps.items()}
        return {name: task.result() for name, task in running.items()}


def build_dims(spark: SparkSession, config: BuildConfig = BuildConfig()) -> dict[str, DataFrame]:
    gold, zones = config.gold, spark.table(config.zones_table)
    return _together(spark, {
        "dim_date": lambda: replace_table(dims.dim_date(spark, config.start, config.end), f"{gold}.dim_date"),
        "dim_zone": lambda: write_zone(dims.dim_zone(zones), f"{gold}.dim_zone"),
        "dim_service_type": lambda: write_list(
            dims.dim_service_type(spark), f"{gold}.dim_service_type", "service_type", SERVICES),
        "dim_payment_type": lambda: write_list(
            dims.dim_payment_type(spark), f"{gold}.dim_payment_type", "payment_type", PAYMENT_KINDS),
        "dim_vendor": lambda: replace_table(dims.dim_vendor(spark), f"{gold}.dim_vendor"),
        "dim_rate_code": lambda: replace_table(dims.dim_rate_code(spark), f"{gold}.dim_rate_code"),
    })


def build_fact(spark: SparkSession, config: BuildConfig = BuildConfig()) -> dict[str, DataFrame]:
    base = silver_base(spark.table(config.trips_table))
    with Staging(spark) as staging:
        # A stored table is read by a plain scan, so a re-run task sees its rows in the same order; a view may shuffle.
        stored = spark.catalog.getTable(config.trips_table).tableType in ("MANAGED", "EXTERNAL")
        keyed = keyed_fact(fct_trips(base, config.start, config.end), staging, replayable=stored)
        fact = write_fact(keyed, f"{config.gold}.fct_trips", config.start, config.end)
    return {"fct_trips": assert_not_empty(fact)}


def build_marts(spark: SparkSession, config: BuildConfig = BuildConfig()) -> dict[str, DataFrame]:
    """All four marts from three reads of bronze: the cube, the zone flows and the medians."""
    base, zones = silver_base(spark.table(config.trips_table)), spark.table(config.zones_table)
    with Staging(spark) as staging:
        summed = silver_base(spark.table(config.trips_table), money_of_double)
        cube = staging.write(marts.trip_cube(summed), "cube")
        built = {
            "gold_monthly_summary": marts.monthly_from_cube(cube, base),
            "gold_zone_analytics": marts.zone_analytics(base, zones),
            "gold_daily_revenue": marts.daily_from_cube(cube),
            "gold_hourly_patterns": marts.hourly_from_cube(cube),
        }
        return _together(spark, {
            name: partial(replace_table, marts.with_processed_at(df), f"{config.gold}.{name}")
            for name, df in built.items()
        })


def build_all(spark: SparkSession, config: BuildConfig = BuildConfig()) -> dict[str, DataFrame]:
    """silver -> dimensions -> fact -> marts -> tests -> publish.

    The first failing step or test raises and ends the build; the gold layer then stays as it was.
    """
    zones = require_rows(spark.table(config.zones_table), config.zones_table)
    if not unique(zones, "LocationID").limit(1).isEmpty():
        raise QualityError(f"{config.zones_table} repeats a LocationID")
    tables = build_silver(spark, config)
    tables["taxi_zone_lookup"] = zones
    with new_release(spark, config.gold) as release:
        unpublished = replace(config, gold=release)
        for step in (build_dims, build_fact, build_marts):
            tables |= step(spark, unpublished)
        # Tested by its form of one scan, which the fact and the marts are built from; its row count is held against the views.
        tables["test_results"] = run_suite(tables | {"silver_trips_unified": silver_base(spark.table(config.trips_table))})
    return tables

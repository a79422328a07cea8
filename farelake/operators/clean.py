"""Cleaning rules of the silver layer: filter, defaults, types, calendar parts, zone names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import half_even_int, minutes_between, money, pickup_parts
from ..schemas import MONEY_COLUMNS

# What a missing attribute is taken to be. Money columns default to zero.
DEFAULTS = {
    "passenger_count": 1,
    "ratecode_id": 1,
    "store_and_fwd_flag": "N",
    "payment_type": 5,
    "trip_type": 1,
    **{name: 0 for name in MONEY_COLUMNS},
}
ROUNDED_COLUMNS = ("passenger_count", "ratecode_id", "payment_type", "trip_type")
ID_COLUMNS = ("pu_location_id", "do_location_id")  # integers in bronze already


def clean_trips(df: DataFrame) -> DataFrame:
    """Keep trips with both times in order, both locations, and distance and total not negative.

    Comparisons with NULL are not true, so NULL times, distances and totals are removed too. All terms but the
    time order are pushed into the parquet scan.
    """
    return df.where(
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("pickup_datetime") <= F.col("dropoff_datetime"))
        & (F.col("trip_distance") >= 0)
        & (F.col("total_amount") >= 0)
        & F.col("pu_location_id").isNotNull()
        & F.col("do_location_id").isNotNull()
    )


def defaulted(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(DEFAULTS[name])) if name in DEFAULTS else F.col(name)


def apply_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({name: defaulted(name) for name in DEFAULTS if name in df.columns})


def typed(name: str, to_money: Callable[[Column], Column] = money) -> Column:
    """Silver value of a bronze column: default, then integer or money type."""
    value = defaulted(name)
    if name in ROUNDED_COLUMNS:
        value = half_even_int(value)
    elif name in ID_COLUMNS:
        value = value.cast("int")
    elif name in MONEY_COLUMNS:
        value = to_money(value)
    return value.alias(name)


def trip_duration_minutes() -> Column:
    return minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("trip_duration_minutes")


def calendar_columns() -> list[Column]:
    return [value.alias(name) for name, value in pickup_parts(F.col("pickup_datetime")).items()]


def zone_side(zones: DataFrame, side: str) -> DataFrame:
    """The zone lookup in one role ('pu' or 'do')."""
    return zones.select(
        F.col("LocationID").alias(f"_{side}_id"),
        F.col("Borough").alias(f"{side}_borough"),
        F.col("Zone").alias(f"{side}_zone_name"),
        F.col("service_zone").alias(f"{side}_service_zone"),
    )


def enrich_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join the lookup twice, for pickup and dropoff; unknown locations keep NULL names.

    No broadcast hint: Spark broadcasts the lookup when its size is under the threshold and otherwise shuffles,
    with AQE splitting hot locations.
    """
    for side in ("pu", "do"):
        lookup = zone_side(zones, side)
        df = df.join(lookup, F.col(f"{side}_location_id") == F.col(f"_{side}_id"), "left").drop(f"_{side}_id")
    return df

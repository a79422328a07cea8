"""Silver layer: cleaned and enriched yellow and green trips, and their union."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money
from ..operators.clean import calendar_columns, clean_trips, enrich_zones, trip_duration_minutes, typed
from ..schemas import SERVICES, SILVER_COLUMNS, ZONE_NAME_COLUMNS

_AS_IS = ("vendor_id", "pickup_datetime", "dropoff_datetime", "trip_distance", "service_type", "source_month",
          "ingest_ts")
_ZONES = tuple(f"{side}_{name}" for side in ("pu", "do") for name in ("borough", "zone_name", "service_zone"))
_COMMON = tuple(c for c in SILVER_COLUMNS if c not in ("trip_type", "airport_fee", *ZONE_NAME_COLUMNS))


def no_trip_type() -> Column:
    return F.lit(None).cast("int")


def no_airport_fee() -> Column:
    return F.lit(0).cast("decimal(10,2)")


def _columns(names, to_money: Callable[[Column], Column] = money) -> list[Column]:
    derived = {"trip_duration_minutes": trip_duration_minutes(), **dict(zip(
        ("pickup_date", "pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour"), calendar_columns()))}
    return [derived.get(n, F.col(n) if n in _AS_IS else typed(n, to_money)) for n in names]


def _service(bronze: DataFrame, zones: DataFrame, service: str, own: str) -> DataFrame:
    trips = clean_trips(bronze.where(F.col("service_type") == service))
    named = enrich_zones(trips.select(_columns([*_COMMON, own])), zones)
    order = [c for c in SILVER_COLUMNS if c in (*_COMMON, own)]
    at = order.index("do_location_id") + 1
    return named.select(order[:at] + list(_ZONES) + order[at:])


def silver_yellow(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    return _service(bronze, zones, "yellow", "airport_fee")


def silver_green(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    return _service(bronze, zones, "green", "trip_type")


def silver_unified(yellow: DataFrame, green: DataFrame) -> DataFrame:
    """All trips in 33 columns; duplicates are kept."""
    return (
        yellow.withColumn("trip_type", no_trip_type()).select(*SILVER_COLUMNS)
        .unionByName(green.withColumn("airport_fee", no_airport_fee()).select(*SILVER_COLUMNS))
    )


def silver_base(bronze: DataFrame, to_money: Callable[[Column], Column] = money) -> DataFrame:
    """The unified trips without zone names, from one scan of bronze and no join.

    Equal to ``silver_unified`` without its four name columns as long as zone ids are unique. The fact table and the
    marts are built from it, since they look names up by location after aggregating.

    ``money_of_double`` as ``to_money`` suits readers of a few columns, as the cube: for all of them at once its code is
    more than the JVM compiles as one method.
    """
    green = F.col("service_type") == "green"
    trips = clean_trips(bronze.where(F.col("service_type").isin(*SERVICES)))
    by_service = {
        "trip_type": F.when(green, typed("trip_type")).alias("trip_type"),
        "airport_fee": F.when(green, no_airport_fee()).otherwise(typed("airport_fee", to_money)).alias("airport_fee"),
    }
    columns = dict(zip(_COMMON, _columns(_COMMON, to_money))) | by_service
    return trips.select([columns[c] for c in SILVER_COLUMNS if c in columns])

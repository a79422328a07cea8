"""The trip fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_of_week, half_even_int, money
from ..operators.surrogate import add_surrogate_key
from ..schemas import FACT_COLUMNS, MONEY_COLUMNS
from ..session import Staging
from .dims import DATE_END, DATE_START

KEY_ORDER = ("pickup_datetime", "service_type", "pu_zone_key")


def fct_trips(trips: DataFrame, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """One row per trip picked up in [start, end), without the surrogate key.

    ``trips`` are unified silver trips, with or without zone names. The limits are put on the pickup time, which equals
    the limits on its date and reaches the parquet scan.
    """
    pickup = F.col("pickup_datetime")
    inside = (pickup >= F.lit(start).cast("timestamp_ntz")) & (pickup < F.lit(end).cast("timestamp_ntz"))

    kinds = dict(trips.dtypes)

    def or_else(name: str, default: Column | int | str) -> Column:
        """The column with a default of its own type, so that silver's types pass through without conversions."""
        return F.coalesce(F.col(name), F.lit(default).cast(kinds[name]))

    def integer(name: str, default: int) -> Column:
        value = or_else(name, default)
        return value if kinds[name] == "int" else half_even_int(value)

    columns = {
        "pickup_date_key": F.col("pickup_date"),
        "pu_zone_key": F.col("pu_location_id"),
        "do_zone_key": F.col("do_location_id"),
        "payment_type_id": or_else("payment_type", 5),
        "vendor_id": integer("vendor_id", 0),
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": day_of_week(pickup),
        "passenger_count": integer("passenger_count", 1),
        "trip_distance": money(or_else("trip_distance", 0)),
        "trip_duration_minutes": money(or_else("trip_duration_minutes", 0)),
        "ratecode_id": integer("ratecode_id", 1),
        "store_and_fwd_flag": or_else("store_and_fwd_flag", "N"),
        **{name: money(or_else(name, 0)) for name in MONEY_COLUMNS},
    }
    return trips.where(inside).select([
        columns[name].alias(name) if name in columns else F.col(name) for name in FACT_COLUMNS if name != "trip_key"
    ])


def keyed_fact(fact: DataFrame, staging: Staging, replayable: bool = False) -> DataFrame:
    """The fact with trip_key 1…N by pickup time, service and pickup zone (then by a hash of the row)."""
    return add_surrogate_key(fact, KEY_ORDER, staging, "trip_key", replayable).select(*FACT_COLUMNS)

"""Business questions over the gold layer.

Every question takes the fact (lazy or stored), the dimensions it needs, and a date window [start, end). Facts are
grouped by the raw keys first; zone and payment names are joined to the few grouped rows, never to the trips. Results
are ordered, with ties broken by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_band, month_start, ratio
from ..operators.measures import MONEY_SUM
from ..operators.percentiles import exact_percentiles, value_counts
from ..operators.ranking import ascending, descending, top_k, top_k_per_group
from .layout import in_window

START, END = "2024-01-01", "2025-01-01"

_ZONE = ("zone_name", "borough")


def _month() -> Column:
    return month_start(F.col("pickup_date_key")).alias("month")


def _trips() -> Column:
    return F.count("*").alias("trips")


def _revenue() -> Column:
    return F.sum("total_amount").cast(MONEY_SUM).alias("total_revenue")


def _mean_parts(value: Column) -> tuple[Column, Column]:
    return F.sum(value).alias("value_sum"), F.count(value).alias("value_count")


def _tip_ratio() -> Column:
    return ratio(F.col("tip_amount"), F.col("fare_amount"))


def _add(*names: str) -> list[Column]:
    return [(F.sum(n).cast(MONEY_SUM) if n == "total_revenue" else F.sum(n)).alias(n) for n in names]


def _mean(name: str) -> Column:
    return ratio(F.sum("value_sum"), F.sum("value_count")).alias(name)


def _with_zone(grouped: DataFrame, zones: DataFrame, key: str, keep: Sequence[str] = _ZONE,
               prefix: str = "") -> DataFrame:
    lookup = zones.select(F.col("zone_key").alias("_zone"), *[F.col(c).alias(prefix + c) for c in keep])
    return grouped.join(lookup, F.col(key) == F.col("_zone")).drop("_zone")


def fact_bounds(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("rows"), F.min("pickup_date_key").alias("min_date"),
                    F.max("pickup_date_key").alias("max_date"))


def trips_per_month(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return in_window(fact, start, end).groupBy(_month()).agg(_trips()).orderBy(*ascending("month"))


def trips_per_month_service(fact: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """All dates unless a window is given."""
    return (in_window(fact, start, end).groupBy(_month(), "service_type").agg(_trips())
            .orderBy(*ascending("month", "service_type")))


def top_zones(fact: DataFrame, zones: DataFrame, role: str = "pu", k: int = 10, start: str = START,
              end: str = END) -> DataFrame:
    """Zones with most pickups (role 'pu') or dropoffs ('do')."""
    key = f"{role}_zone_key"
    grouped = in_window(fact, start, end).groupBy(key).agg(_trips())
    named = _with_zone(grouped, zones, key).groupBy(*_ZONE).agg(*_add("trips"))
    return top_k(named, "trips", _ZONE, k)


def top_boroughs_per_month(fact: DataFrame, zones: DataFrame, k: int = 5, exclude: str | None = None,
                           start: str = START, end: str = END) -> DataFrame:
    """Boroughs with most pickups in each month; excluding one also drops unnamed boroughs."""
    if exclude is not None:
        zones = zones.where(F.col("borough") != exclude)
    grouped = in_window(fact, start, end).groupBy(_month(), "pu_zone_key").agg(_trips())
    named = _with_zone(grouped, zones, "pu_zone_key", ["borough"]).groupBy("month", "borough").agg(*_add("trips"))
    return top_k_per_group(named, ["month"], "trips", ["borough"], k)


def peak_hours(fact: DataFrame, k: int = 5, start: str = START, end: str = END) -> DataFrame:
    grouped = in_window(fact, start, end).groupBy("pickup_day_of_week", "pickup_hour").agg(_trips())
    return top_k_per_group(grouped, ["pickup_day_of_week"], "trips", ["pickup_hour"], k)


def trips_by_dow(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return (in_window(fact, start, end).groupBy("pickup_day_of_week").agg(_trips())
            .orderBy(*descending("trips", ["pickup_day_of_week"])))


def revenue_per_month(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return in_window(fact, start, end).groupBy(_month()).agg(_revenue()).orderBy(*ascending("month"))


def revenue_per_month_service(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return (in_window(fact, start, end).groupBy(_month(), "service_type").agg(_revenue())
            .orderBy(*ascending("month", "service_type")))


def tip_pct_per_month(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Mean of tip / fare (a fraction, not percent) over trips with a positive fare."""
    return (in_window(fact, start, end).where(F.col("fare_amount") > 0).groupBy(_month())
            .agg(F.avg(_tip_ratio()).alias("avg_tip_pct")).orderBy(*ascending("month")))


def tip_pct_by_borough(fact: DataFrame, zones: DataFrame, start: str = START, end: str = END) -> DataFrame:
    grouped = (in_window(fact, start, end).where(F.col("fare_amount") > 0)
               .groupBy(_month(), "pu_zone_key").agg(*_mean_parts(_tip_ratio())))
    return (_with_zone(grouped, zones, "pu_zone_key", ["borough"]).groupBy("month", "borough")
            .agg(_mean("avg_tip_pct")).orderBy(*ascending("month", "borough")))


def top_zones_by_revenue(fact: DataFrame, zones: DataFrame, k: int = 10, start: str = START,
                         end: str = END) -> DataFrame:
    grouped = in_window(fact, start, end).groupBy("pu_zone_key").agg(_revenue())
    named = _with_zone(grouped, zones, "pu_zone_key").groupBy(*_ZONE).agg(*_add("total_revenue"))
    return top_k(named, "total_revenue", _ZONE, k)


def top_zones_by_tip(fact: DataFrame, zones: DataFrame, min_trips: int = 1000, k: int = 10, start: str = START,
                     end: str = END) -> DataFrame:
    grouped = (in_window(fact, start, end).where(F.col("fare_amount") > 0)
               .groupBy("pu_zone_key").agg(_trips(), *_mean_parts(_tip_ratio())))
    named = _with_zone(grouped, zones, "pu_zone_key").groupBy(*_ZONE).agg(*_add("trips"), _mean("tip_pct"))
    return top_k(named.where(F.col("trips") >= min_trips), "tip_pct", _ZONE, k)


def cash_vs_card(fact: DataFrame, payment_types: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Trips with a zero fare count, but have no tip ratio."""
    grouped = in_window(fact, start, end).groupBy("payment_type_id").agg(
        _trips(), _revenue(), *_mean_parts(_tip_ratio()))
    kinds = payment_types.where(F.col("payment_type").isin("cash", "card"))
    return (grouped.join(kinds, "payment_type_id").groupBy("payment_type")
            .agg(*_add("trips", "total_revenue"), _mean("avg_tip_pct")).orderBy(*ascending("payment_type")))


def _exact_average(name: str):
    """Mean of a decimal column: an exact sum, divided once."""
    return F.sum(name).cast("double") / F.count(name)


def avg_duration_per_month(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return (in_window(fact, start, end).groupBy(_month())
            .agg(_exact_average("trip_duration_minutes").alias("avg_duration_min"))
            .orderBy(*ascending("month")))


def avg_distance_per_month(fact: DataFrame, start: str = START, end: str = END) -> DataFrame:
    return (in_window(fact, start, end).groupBy(_month())
            .agg(_exact_average("trip_distance").alias("avg_distance"))
            .orderBy(*ascending("month")))


def speed_by_borough_band(fact: DataFrame, zones: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Mean of the trips' own speeds (mph), over trips with a positive distance and duration."""
    hours = F.col("trip_duration_minutes").cast("double") / 60.0
    speed = ratio(F.col("trip_distance"), hours)
    moving = in_window(fact, start, end).where((F.col("trip_duration_minutes") > 0) & (F.col("trip_distance") > 0))
    grouped = moving.groupBy("pu_zone_key", day_band(F.col("pickup_hour")).alias("time_band")).agg(
        *_mean_parts(speed))
    return (_with_zone(grouped, zones, "pu_zone_key", ["borough"]).groupBy("borough", "time_band")
            .agg(_mean("avg_speed_mph")).orderBy(*ascending("borough", "time_band")))


def _durations_by_zone(fact: DataFrame, zones: DataFrame, keep: Sequence[str], start: str, end: str) -> DataFrame:
    """(zone names, minutes, n): how often each duration occurs in a pickup zone."""
    counts = value_counts(in_window(fact, start, end), ["pu_zone_key"], "trip_duration_minutes")
    minutes = (F.col("_value").cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return _with_zone(counts.select("pu_zone_key", minutes.alias("minutes"), F.col("_n").alias("n")), zones,
                      "pu_zone_key", keep)


def duration_percentiles(fact: DataFrame, zones: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Exact p50 and p90 of the duration by pickup borough."""
    durations = _durations_by_zone(fact, zones, ["borough"], start, end)
    points = {"p50_duration": 0.5, "p90_duration": 0.9}
    return exact_percentiles(durations, ["borough"], "minutes", points, weight="n").orderBy(*ascending("borough"))


def top_zones_by_p90(fact: DataFrame, zones: DataFrame, k: int = 10, start: str = START, end: str = END) -> DataFrame:
    durations = _durations_by_zone(fact, zones, _ZONE, start, end)
    p90 = exact_percentiles(durations, _ZONE, "minutes", {"p90_duration": 0.9}, weight="n")
    return top_k(p90, "p90_duration", _ZONE, k)


def top_routes(fact: DataFrame, zones: DataFrame, k: int = 10, start: str = START, end: str = END) -> DataFrame:
    """Borough to borough routes with most trips."""
    grouped = in_window(fact, start, end).groupBy("pu_zone_key", "do_zone_key").agg(_trips())
    named = _with_zone(grouped, zones, "pu_zone_key", ["borough"], "pickup_")
    named = _with_zone(named, zones, "do_zone_key", ["borough"], "dropoff_")
    ends = ("pickup_borough", "dropoff_borough")
    return top_k(named.groupBy(*ends).agg(*_add("trips")), "trips", ends, k)

"""Summary marts over silver trips.

Daily, hourly and monthly marts share additive measures. A single mart groups the trips at its own grain; a full build
groups them once by date, hour and service (``trip_cube``) and derives all three from that small table.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..functions import day_name, day_of_week, day_type, exact_mean, percent, ratio, rounded, time_period
from ..operators.clean import enrich_zones
from ..operators.measures import MICROSECONDS_PER_MINUTE, MONEY_SUM, measure, roll_up
from ..operators.percentiles import exact_percentiles
from ..operators.ranking import ascending

_BY_DATE = ("pickup_date", "service_type")
_CUBE_KEYS = ("pickup_date", "pickup_hour", "service_type")

DAILY_MEASURES = ("trips", "passengers", "distance_sum", "duration_micros", "fare_sum", "tip_sum", "toll_sum",
                  "revenue_sum", "tip_ratio_sum", "tip_ratio_count", "tipped_trips", "card_trips", "cash_trips")
HOURLY_MEASURES = ("trips", "distance_sum", "duration_micros", "revenue_sum")
MONTHLY_MEASURES = ("trips", "passengers", "distance_sum", "duration_micros", "fare_sum", "tip_sum", "toll_sum",
                    "revenue_sum", "tipped_trips", "card_trips", "cash_trips")


def trip_cube(trips: DataFrame) -> DataFrame:
    """All measures by pickup date, hour and service: at most 48 rows per calendar day."""
    return measure(trips, _CUBE_KEYS, DAILY_MEASURES)


def with_processed_at(mart: DataFrame) -> DataFrame:
    return mart.withColumn("processed_at", F.current_timestamp())


def _mean(total: str, scale: int = 2):
    return rounded(ratio(F.col(total), F.col("trips")), scale)


def _mean_minutes():
    return rounded(ratio(F.col("duration_micros"), F.col("trips") * MICROSECONDS_PER_MINUTE))


def _total(name: str):
    return F.col(name).cast(MONEY_SUM)


def daily_revenue(trips: DataFrame) -> DataFrame:
    """Volume, revenue, tips and payment mix by date and service."""
    return daily_from_measures(measure(trips, _BY_DATE, DAILY_MEASURES))


def daily_from_cube(cube: DataFrame) -> DataFrame:
    return daily_from_measures(roll_up(cube, _BY_DATE, DAILY_MEASURES))


def daily_from_measures(m: DataFrame) -> DataFrame:
    dow = day_of_week("pickup_date")
    return m.select(
        "pickup_date",
        F.year("pickup_date").alias("pickup_year"),
        F.month("pickup_date").alias("pickup_month"),
        dow.alias("pickup_day_of_week"),
        day_name(dow).alias("day_name"),
        "service_type",
        F.col("trips").alias("total_trips"),
        F.col("passengers").alias("total_passengers"),
        rounded(F.col("distance_sum")).alias("total_distance_miles"),
        _mean("distance_sum").alias("avg_distance_miles"),
        _mean_minutes().alias("avg_duration_minutes"),
        _total("fare_sum").alias("total_fare"),
        _total("tip_sum").alias("total_tips"),
        _total("toll_sum").alias("total_tolls"),
        _total("revenue_sum").alias("total_revenue"),
        F.round(exact_mean(F.col("revenue_sum"), F.col("trips")), 2).alias("avg_revenue_per_trip"),
        # Mean of the per-trip ratios, in percent.
        rounded(ratio(F.col("tip_ratio_sum"), F.col("tip_ratio_count")) * 100.0).alias("avg_tip_percentage"),
        F.col("tipped_trips").alias("trips_with_tips"),
        F.col("card_trips").alias("credit_card_trips"),
        "cash_trips",
        percent(F.col("card_trips"), F.col("trips")).alias("credit_card_percentage"),
    )


def hourly_patterns(trips: DataFrame) -> DataFrame:
    """Volume and averages by year, month, hour, weekday and service."""
    return _hourly(measure(trips, ("pickup_year", "pickup_month", "pickup_hour", "pickup_day_of_week",
                                   "service_type"), HOURLY_MEASURES))


def hourly_from_cube(cube: DataFrame) -> DataFrame:
    keys = (F.year("pickup_date").alias("pickup_year"), F.month("pickup_date").alias("pickup_month"), F.col("pickup_hour"),
            day_of_week("pickup_date").alias("pickup_day_of_week"), F.col("service_type"))
    return _hourly(roll_up(cube, keys, HOURLY_MEASURES))


def _hourly(m: DataFrame) -> DataFrame:
    dow = F.col("pickup_day_of_week")
    return m.select(
        "pickup_year", "pickup_month", "pickup_hour", "pickup_day_of_week",
        day_name(dow).alias("day_name"),
        day_type(dow).alias("day_type"),
        time_period(F.col("pickup_hour")).alias("time_period"),
        "service_type",
        F.col("trips").alias("total_trips"),
        _mean_minutes().alias("avg_duration_minutes"),
        _mean("distance_sum").alias("avg_distance_miles"),
        F.round(exact_mean(F.col("revenue_sum"), F.col("trips")), 2).alias("avg_revenue"),
        _total("revenue_sum").alias("total_revenue"),
    )


def monthly_summary(trips: DataFrame) -> DataFrame:
    """Volume, revenue, exact median, tip and payment rates by year, month and service."""
    return monthly_from_measures(measure(trips, _BY_DATE, MONTHLY_MEASURES), _month_medians(trips))


def monthly_from_cube(cube: DataFrame, trips: DataFrame) -> DataFrame:
    return monthly_from_measures(roll_up(cube, _BY_DATE, MONTHLY_MEASURES), _month_medians(trips))


def _month_medians(trips: DataFrame) -> DataFrame:
    return exact_percentiles(trips, ["pickup_year", "pickup_month", "service_type"], "total_amount",
                             {"median_revenue": 0.5})


def monthly_from_measures(by_date: DataFrame, medians: DataFrame) -> DataFrame:
    """From measures by date and service: the number of dates is then the distinct date count."""
    keys = ["pickup_year", "pickup_month", "service_type"]
    m = roll_up(
        by_date, (F.year("pickup_date").alias("pickup_year"), F.month("pickup_date").alias("pickup_month"), F.col("service_type")),
        MONTHLY_MEASURES, F.count("*").alias("active_days"),
    )
    # Null-safe, so that no filter is pushed into one side only: both uses of the trips stay one scan.
    named = medians.select(*(F.col(key).alias(f"_{key}") for key in keys), "median_revenue")
    m = m.join(named, reduce(and_, (m[key].eqNullSafe(named[f"_{key}"]) for key in keys))).drop(*(f"_{key}" for key in keys))
    trips = F.col("trips")
    return m.select(
        F.col("pickup_year").alias("year"),
        F.col("pickup_month").alias("month"),
        F.make_date("pickup_year", "pickup_month", F.lit(1)).alias("month_start_date"),
        "service_type",
        trips.alias("total_trips"),
        "active_days",
        rounded(ratio(trips, F.col("active_days")), 0).alias("avg_trips_per_day"),
        F.col("passengers").alias("total_passengers"),
        rounded(F.col("distance_sum")).alias("total_distance_miles"),
        _total("revenue_sum").alias("total_revenue"),
        _total("fare_sum").alias("total_fares"),
        _total("tip_sum").alias("total_tips"),
        _total("toll_sum").alias("total_tolls"),
        _mean("distance_sum").alias("avg_distance_miles"),
        _mean_minutes().alias("avg_duration_minutes"),
        F.round(exact_mean(F.col("revenue_sum"), trips), 2).alias("avg_revenue_per_trip"),
        _mean("passengers").alias("avg_passengers_per_trip"),
        rounded(F.col("median_revenue")).alias("median_revenue"),
        F.col("card_trips").alias("credit_card_trips"),
        "cash_trips",
        "tipped_trips",
        percent(F.col("tipped_trips"), trips).alias("tip_rate_percentage"),
        percent(F.col("card_trips"), trips).alias("credit_card_percentage"),
        # Ratio of the sums, in percent: not the mean of ratios of the daily mart.
        percent(F.col("tip_sum"), F.col("fare_sum")).alias("avg_tip_rate"),
    ).orderBy(*ascending("year", "month", "service_type"))


def zone_flows(trips: DataFrame) -> DataFrame:
    """Trips and revenue by origin, destination, month and service: bounded by the number of zone pairs."""
    return trips.groupBy(
        "pu_location_id", "do_location_id", "pickup_year", "pickup_month", "service_type",
    ).agg(F.count("*").alias("trips"), F.sum("total_amount").cast(MONEY_SUM).alias("revenue"))


def zone_analytics(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickups and dropoffs of each named zone by month and service, and their balance."""
    return zone_analytics_from_flows(enrich_zones(zone_flows(trips), zones))


def zone_analytics_from_flows(flows: DataFrame) -> DataFrame:
    month = ["pickup_year", "pickup_month", "service_type"]

    def side(role: str) -> DataFrame:
        borough = F.col(f"{role}_borough")
        return flows.where(borough.isNotNull()).groupBy(
            F.col(f"{role}_location_id").alias("location_id"), borough.alias("borough"),
            F.col(f"{role}_zone_name").alias("zone_name"), *month,
        ).agg(F.sum("trips").alias("n"), F.sum("revenue").cast(MONEY_SUM).alias("revenue"))

    keys = ["location_id", *month]
    p, d = side("pu").alias("p"), side("do").alias("d")
    joined = p.join(d, [F.col(f"p.{k}") == F.col(f"d.{k}") for k in keys], "full")
    either = lambda name: F.coalesce(F.col(f"p.{name}"), F.col(f"d.{name}"))
    zero = F.lit(0).cast("long")
    pickups, dropoffs = F.coalesce(F.col("p.n"), zero), F.coalesce(F.col("d.n"), zero)
    no_money = F.lit(0).cast(MONEY_SUM)
    return joined.select(
        either("location_id").alias("location_id"),
        either("borough").alias("borough"),
        either("zone_name").alias("zone_name"),
        either("pickup_year").alias("year"),
        either("pickup_month").alias("month"),
        either("service_type").alias("service_type"),
        pickups.alias("total_pickups"),
        dropoffs.alias("total_dropoffs"),
        (pickups + dropoffs).alias("total_trips"),  # a trip counts in both of its zones
        F.coalesce(F.col("p.revenue"), no_money).alias("pickup_revenue"),
        F.coalesce(F.col("d.revenue"), no_money).alias("dropoff_revenue"),
        # Mean total of the pickups, despite the name.
        F.coalesce(F.round(exact_mean(F.col("p.revenue"), F.col("p.n")), 2), no_money).alias("avg_fare"),
        F.when(pickups > dropoffs, "Net Origin").when(pickups < dropoffs, "Net Destination").otherwise("Balanced")
        .alias("zone_flow_type"),
        (pickups - dropoffs).alias("net_flow"),
    )

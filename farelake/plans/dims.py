"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import day_name, day_of_week, month_name, year_month

# Fixed values of the dimensions.
BOROUGH_CODES = {"Manhattan": 1, "Brooklyn": 2, "Queens": 3, "Bronx": 4, "Staten Island": 5, "EWR": 6}
OTHER_BOROUGH = 7
SERVICE_TYPES = (
    ("yellow", "Yellow Taxi", "Medallion taxis that can pick up passengers anywhere in NYC"),
    ("green", "Green Taxi", "Boro taxis that primarily serve outer boroughs"),
)
PAYMENT_TYPES = (
    (1, "card", "Credit Card", "Payment made via credit card"),
    (2, "cash", "Cash", "Payment made in cash"),
    (3, "other", "No Charge", "No charge for the trip"),
    (4, "other", "Dispute", "Disputed transaction"),
    (5, "other", "Unknown", "Unknown payment method"),
    (6, "other", "Voided Trip", "Trip was voided"),
)
VENDORS = (
    (0, "Unknown", "Unknown vendor"),
    (1, "Creative Mobile Technologies", "CMT - Technology provider for taxi meters"),
    (2, "VeriFone Inc", "VTS - Technology provider for taxi meters"),
)
RATE_CODES = (
    (1, "Standard Rate", "Standard metered fare"),
    (2, "JFK", "JFK Airport flat fare"),
    (3, "Newark", "Newark Airport"),
    (4, "Nassau/Westchester", "Trips to Nassau or Westchester"),
    (5, "Negotiated Fare", "Negotiated fare between driver and passenger"),
    (6, "Group Ride", "Group ride shared fare"),
)

DATE_START, DATE_END = "2022-01-01", "2026-01-01"  # end not included


def _values(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A literal table; Spark knows its size, so joins to it are broadcast."""
    literal = lambda v: str(v) if isinstance(v, int) else f"'{v}'"
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def dim_date(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """One row per calendar day from start up to, not including, end."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1))).alias("date_key"))
    return with_calendar(days, F.col("date_key"))


def with_calendar(days: DataFrame, date: Column) -> DataFrame:
    dow = day_of_week(date)
    return days.select(
        date.alias("date_key"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        dow.alias("day_of_week"),
        F.dayofyear(date).alias("day_of_year"),
        F.weekofyear(date).alias("week_of_year"),
        F.quarter(date).alias("quarter"),
        day_name(dow).alias("day_name"),
        month_name(date).alias("month_name"),
        dow.isin(0, 6).alias("is_weekend"),
        year_month(date).alias("year_month"),
    )


def borough_code(borough: Column) -> Column:
    code = F.lit(OTHER_BOROUGH)
    for name, number in BOROUGH_CODES.items():
        code = F.when(borough == name, number).otherwise(code)
    return code


def dim_zone(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("zone_key"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
        borough_code(F.col("Borough")).alias("borough_code"),
    )


def dim_service_type(spark: SparkSession) -> DataFrame:
    return _values(spark, SERVICE_TYPES, "service_type, service_name, service_description")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _values(spark, PAYMENT_TYPES,
                   "payment_type_id, payment_type, payment_type_name, payment_type_description")


def dim_vendor(spark: SparkSession) -> DataFrame:
    return _values(spark, VENDORS, "vendor_id, vendor_name, vendor_description")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return _values(spark, RATE_CODES, "rate_code_id, rate_code_name, rate_code_description")

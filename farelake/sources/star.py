"""Trips and zones derived from the star-schema parquet tables (lineitem, orders, customer, supplier, nation, region).

Each lineitem is a trip: picked up on the order date in the customer's nation, dropped off on the ship date in the
supplier's nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.normalize import conform, normalize_columns
from ..schemas import BRONZE_SCHEMA


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _plus_hours(date: Column, hours: Column) -> Column:
    return date + F.make_dt_interval(F.lit(0), hours.cast("int"))


def raw_trips(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Trips under the column names of raw yellow files, with service_type and source_month.

    A pickup window [start, end) may be given by callers that filter on it anyway. A pickup is less than a day after its
    order date, so the window gives limits for the order date that reach the scan and shrink the join.
    """
    orders = table(spark, folder, "orders")
    if start is not None:
        orders = orders.where(F.col("o_orderdate") > (F.lit(start).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")))
    if end is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    # The month is text of the order, so it is made once per order rather than once per lineitem.
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("source_month"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    # Customers are joined to the orders, the smaller side, before the orders meet the lineitems.
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        table(spark, folder, "lineitem")
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    double = lambda value: value.cast("double")
    price = F.col("l_extendedprice")
    tip = (price.cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)")
    refunded = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    open_line = F.col("l_linestatus") == "O"
    return joined.select(
        (F.col("l_suppkey") % 3).cast("int").alias("VendorID"),
        _plus_hours(F.col("o_orderdate"), F.col("l_partkey") % 24).alias("tpep_pickup_datetime"),
        _plus_hours(F.col("l_shipdate"), F.col("l_suppkey") % 24).alias("tpep_dropoff_datetime"),
        double(F.nullif(F.col("l_linenumber"), F.lit(7))).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        double(F.nullif(F.col("l_partkey") % 7, F.lit(0).cast("long"))).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "N").alias("store_and_fwd_flag"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        double(F.nullif(priority, F.lit(5))).alias("payment_type"),
        price.alias("fare_amount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        double(tip).alias("tip_amount"),
        (F.col("l_tax") * 10).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when(F.col("l_linenumber") < 4, F.lit(2.5)).alias("congestion_surcharge"),
        F.when(open_line, F.lit(1.25)).alias("Airport_fee"),
        F.when(refunded, -price).otherwise(price).alias("total_amount"),
        F.when(open_line, "yellow").otherwise("green").alias("service_type"),
        "source_month",
    )


def bronze_trips(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The same trips as a bronze table."""
    trips = normalize_columns(raw_trips(spark, folder, start, end)).withColumn("ingest_ts", F.current_timestamp())
    return conform(trips, BRONZE_SCHEMA)


def zone_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones and regions as boroughs, with one unknown and one unnamed borough."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    key = F.col("n_nationkey")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        key.alias("LocationID"),
        F.when(key == 24, "Unknown").when(key != 23, F.col("r_name")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("r_name") == "AMERICA", "Yellow Zone").otherwise("Boro Zone").alias("service_zone"),
    )

"""Fixed schemas, column lists and the raw-to-bronze column names."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw file column -> bronze column. Columns not listed keep their lower-cased name.
RAW_TO_BRONZE = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}

SERVICES = ("yellow", "green")

# Charges that default to zero and are kept with two decimals.
MONEY_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
)


_KINDS = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """A StructType from 'name type, name type, …' (parsed here, so that importing needs no session)."""
    schema = T.StructType()
    for field in spec.replace("\n", " ").split(","):
        name, kind = field.split()
        schema.add(name, _KINDS[kind])
    return schema


# Lineage columns are added at ingest, the rest comes from the file.
BRONZE_FILE_SCHEMA = _struct(
    """vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count double,
       trip_distance double, ratecode_id double, store_and_fwd_flag string, pu_location_id int, do_location_id int,
       payment_type double, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double,
       improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double,
       cbd_congestion_fee double, ehail_fee double, trip_type double"""
)
BRONZE_SCHEMA = T.StructType(BRONZE_FILE_SCHEMA.fields + _struct(
    "ingest_ts timestamp, service_type string, source_month string").fields)

ZONE_CSV_SCHEMA = _struct("LocationID int, Borough string, Zone string, service_zone string")

PASSENGER_CSV_SCHEMA = _struct(
    """PassengerId int, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int,
       Ticket string, Fare double, Cabin string, Embarked string"""
)
PASSENGER_NUMBERS = ("Age", "Fare", "Parch", "Pclass", "SibSp", "Survived")

COVERAGE_COLUMNS = ("year_month", "service_type", "status", "row_count")

SILVER_COLUMNS = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "passenger_count", "trip_distance",
    "ratecode_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "pu_borough", "pu_zone_name",
    "do_borough", "do_zone_name", "payment_type", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount", "service_type",
    "source_month", "ingest_ts", "pickup_date", "pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour",
)
ZONE_NAME_COLUMNS = ("pu_borough", "pu_zone_name", "do_borough", "do_zone_name")

FACT_COLUMNS = (
    "trip_key", "pickup_date_key", "pu_zone_key", "do_zone_key", "service_type", "payment_type_id", "vendor_id",
    "pickup_datetime", "dropoff_datetime", "pickup_hour", "pickup_day_of_week", "passenger_count", "trip_distance",
    "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount", "ratecode_id",
    "store_and_fwd_flag", "source_month", "ingest_ts",
)

"""Two small flows: multi-passenger trips and the passenger list clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import minutes_between
from ..operators.median import fill_missing_with_median
from ..schemas import PASSENGER_NUMBERS
from ..sinks.tables import replace_table, write_csv
from ..sources.passengers import scan_passengers


def multi_passenger_trips(df: DataFrame, pickup: str = "tpep_pickup_datetime",
                          dropoff: str = "tpep_dropoff_datetime") -> DataFrame:
    """Parse the times, add the duration in minutes, keep trips with more than one passenger."""
    return (
        df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in (pickup, dropoff)})
        .withColumn("trip_duration_minutes", minutes_between(F.col(pickup), F.col(dropoff)))
        .where(F.col("passenger_count") > 1)
    )


def load_multi_passenger_trips(df: DataFrame, table: str) -> DataFrame:
    return replace_table(multi_passenger_trips(df), table)


def select_number_columns(df: DataFrame) -> DataFrame:
    return df.select(*PASSENGER_NUMBERS)


def clean_passengers(spark: SparkSession, source: str, target: str) -> DataFrame:
    """CSV -> number columns -> medians for missing values -> CSV."""
    cleaned = fill_missing_with_median(select_number_columns(scan_passengers(spark, source)))
    write_csv(cleaned, target)
    return cleaned

"""Passenger list CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PASSENGER_CSV_SCHEMA


def scan_passengers(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the list; a malformed value fails instead of becoming a missing one."""
    return spark.read.csv(path, header=True, schema=PASSENGER_CSV_SCHEMA, quote='"', escape='"', mode="FAILFAST")

"""Query the layer tables with SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Result of a SQL text; DataFrames given by name can be used as {name} in it."""
    return spark.sql(sql, **views)

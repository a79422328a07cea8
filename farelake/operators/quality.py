"""Data tests. Each returns the violating rows (or values); an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(AssertionError):
    """A required check did not hold."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULL is ignored."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def crowded_ranges(df: DataFrame, column: str) -> DataFrame:
    """Ranges of a whole-number key that hold more rows than values, as (range); NULL is ignored.

    Every task keeps one bit per key value of the ranges that it meets, so what is shuffled is a count and a bitmap per
    range and task instead of the keys. Meant for keys without wide gaps whose files hold stretches of them; scattered
    keys cost a bitmap of 4 KB for each range in each task, and ``unique`` is the better test.
    """
    key = F.col(column).cast("long")
    values = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(key)))
    return (
        df.where(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("range"))
        .agg(F.count("*").alias("n_rows"), values.alias("n_values")).where(F.col("n_rows") > F.col("n_values"))
        .select("range")
    )


def unique_dense(df: DataFrame, column: str) -> DataFrame:
    """The result of ``unique`` for a whole-number key without wide gaps; the ranges are counted at once, by a job.

    Without a crowded range no key is shuffled. Otherwise only the rows of crowded ranges are compared.
    """
    crowded = crowded_ranges(df, column)
    if crowded.isEmpty():
        return df.sparkSession.createDataFrame([], df.select(column).schema.add("n_records", "long", False))
    at = F.bitmap_bucket_number(F.col(column).cast("long"))
    return unique(df.select(column, at.alias("range")).join(crowded, "range", "left_semi"), column)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with their row counts; NULL is ignored.

    Counting per value first leaves one row per key to compare, so hot keys and the parent's size do not matter.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field")).agg(
        F.count("*").alias("n_records"))
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(parents, F.col("from_field") == F.col("_parent"), "left_anti")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; NULL is ignored."""
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return child.where(F.col(column).isNotNull()).join(parents, F.col(column) == F.col("_parent"), "left_anti")


def breaks_trip_rule() -> Column:
    """A missing or reversed time, or a negative distance or total."""
    return (
        F.col("pickup_datetime").isNull()
        | F.col("dropoff_datetime").isNull()
        | (F.col("pickup_datetime") > F.col("dropoff_datetime"))
        | (F.col("trip_distance") < 0)
        | (F.col("total_amount") < 0)
    )


def temporal_and_non_negative(trips: DataFrame) -> DataFrame:
    return trips.where(breaks_trip_rule())


def negative_revenue(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("total_revenue") < 0).select("pickup_date", "service_type", "total_revenue")


def invalid_hours(hourly: DataFrame) -> DataFrame:
    hour = F.col("pickup_hour")
    return hourly.where((hour < 0) | (hour > 23)).groupBy("pickup_hour").agg(F.count("*").alias("invalid_count"))


def count_mismatch(unified: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """One row (unified, separate) when the unified table and its parts differ in row count.

    The counts are added up in one aggregate instead of being cross joined.
    """
    counts = unified.agg(F.count("*").alias("unified")).withColumn("separate", F.lit(0).cast("long"))
    for part in parts:
        counts = counts.unionByName(part.agg(F.count("*").alias("separate"))
                                    .withColumn("unified", F.lit(0).cast("long")))
    totals = counts.agg(F.sum("unified").alias("unified"), F.sum("separate").alias("separate"))
    return totals.where(F.col("unified") != F.col("separate"))


def require(condition: bool, message: str) -> None:
    """Stop the run when a step's output is not usable."""
    if not condition:
        raise QualityError(message)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail on an empty table; reads at most one row."""
    require(not df.limit(1).isEmpty(), f"{what} is empty")
    return df

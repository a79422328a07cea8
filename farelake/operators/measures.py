"""Additive trip measures: grouped once at a fine grain, then rolled up without reading the trips again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import decimal_of, ratio

# Sums are exact, so that they don't depend on the order of the tasks: money as decimals with room for 10^22 in a group,
# distances and ratios as wide decimals, durations as whole microseconds.
MONEY_SUM = "decimal(24,2)"
DISTANCE, MICROSECONDS, RATIO = (28, 8), (18, 0), (28, 14)
MICROSECONDS_PER_MINUTE = 60_000_000
MONEY_MEASURES = ("fare_sum", "tip_sum", "toll_sum", "revenue_sum")


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _definitions() -> dict[str, Column]:
    tip_ratio = ratio(F.col("tip_amount"), F.col("fare_amount"))
    return {
        "trips": F.count("*"),
        "passengers": F.sum("passenger_count"),
        "distance_sum": F.sum(decimal_of(F.col("trip_distance"), *DISTANCE)),
        "duration_micros": F.sum(decimal_of(F.col("trip_duration_minutes") * MICROSECONDS_PER_MINUTE, *MICROSECONDS)),
        "fare_sum": F.sum("fare_amount"),
        "tip_sum": F.sum("tip_amount"),
        "toll_sum": F.sum("tolls_amount"),
        "revenue_sum": F.sum("total_amount"),
        "tip_ratio_sum": F.sum(decimal_of(tip_ratio, *RATIO)),
        "tip_ratio_count": F.count(tip_ratio),
        "tipped_trips": _count_where(F.col("tip_amount") > 0),
        "card_trips": _count_where(F.col("payment_type") == 1),
        "cash_trips": _count_where(F.col("payment_type") == 2),
    }


def measure(trips: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The named measures of the trips by key (partial aggregation happens before the shuffle)."""
    wanted = _definitions()
    columns = [
        (wanted[name].cast(MONEY_SUM) if name in MONEY_MEASURES else wanted[name]).alias(name) for name in names
    ]
    return trips.groupBy(*keys).agg(*columns)


def roll_up(measured: DataFrame, keys: Sequence[str | Column], names: Sequence[str], *extra: Column) -> DataFrame:
    """Sum measures to coarser keys."""
    columns = [
        (F.sum(name).cast(MONEY_SUM) if name in MONEY_MEASURES else F.sum(name)).alias(name) for name in names
    ]
    return measured.groupBy(*keys).agg(*columns, *extra)

"""The two hour bandings (marts and questions use different limits) and the day type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (label, first hour, last hour); hours outside every band get the last label.
TIME_PERIODS = (("Morning Rush", 6, 9), ("Midday", 10, 15), ("Evening Rush", 16, 19), ("Night", 20, 23))
TIME_PERIOD_ELSE = "Late Night"
DAY_BANDS = (("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 23))
DAY_BAND_ELSE = "night"


def _band(hour: Column, bands, otherwise: str) -> Column:
    label = F.lit(otherwise)
    for name, first, last in bands:
        label = F.when(hour.between(first, last), F.lit(name)).otherwise(label)
    return label


def time_period(hour: Column) -> Column:
    """Banding of the hourly mart."""
    return _band(hour, TIME_PERIODS, TIME_PERIOD_ELSE)


def day_band(hour: Column) -> Column:
    """Banding of the speed question."""
    return _band(hour, DAY_BANDS, DAY_BAND_ELSE)


def day_type(dow: Column) -> Column:
    return F.when(dow.isin(0, 6), F.lit("Weekend")).otherwise(F.lit("Weekday"))

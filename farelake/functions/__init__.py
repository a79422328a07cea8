from .bands import day_band, day_type, time_period
from .numeric import decimal_of, exact_mean, half_even_int, money, money_of_double, nan_to_null, percent, ratio, rounded
from .temporal import (
    day_name, day_of_week, first_of_month_text, minutes_between, month_name, month_start, pickup_parts, year_month,
)

__all__ = [
    "day_band", "day_type", "time_period",
    "decimal_of", "exact_mean", "half_even_int", "money", "money_of_double", "nan_to_null", "percent", "ratio", "rounded",
    "day_name", "day_of_week", "first_of_month_text", "minutes_between", "month_name", "month_start", "pickup_parts", "year_month",
]

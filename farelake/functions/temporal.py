"""Calendar expressions on zone-less timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Index 0 is Sunday.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes as double, not rounded."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def day_of_week(value: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(value) - 1


def day_name(dow: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in DAY_NAMES]), dow)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def month_name(date: Column) -> Column:
    """Month name blank-padded to nine characters."""
    return F.rpad(F.date_format(date, "MMMM"), 9, " ")


def pickup_parts(ts: Column) -> dict[str, Column]:
    return {
        "pickup_date": F.to_date(ts),
        "pickup_year": F.year(ts),
        "pickup_month": F.month(ts),
        "pickup_day_of_week": day_of_week(ts),
        "pickup_hour": F.hour(ts),
    }


def first_of_month_text(date: Column) -> Column:
    """The first day of a date's month as text: year, dash, two digits of the month, -01."""
    return F.concat(F.year(date).cast("string"), F.lit("-"), F.lpad(F.month(date).cast("string"), 2, "0"), F.lit("-01"))

"""Number rules of the warehouse: half-even integers, two-decimal money, guarded ratios, decimal rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def half_even_int(value: Column) -> Column:
    """Round a number to int with ties to even (1.5 -> 2, 2.5 -> 2); a plain cast would truncate."""
    return F.rint(value.cast("double")).cast("int")


def money(value: Column) -> Column:
    """DECIMAL(10,2), ties away from zero; overflow raises under ANSI mode."""
    return value.cast("decimal(10,2)")


def decimal_of(value: Column, precision: int, scale: int) -> Column:
    """A double as decimal, ties away from zero: what a cast gives, which writes every number as text and reads it again.

    Here the number is scaled and rounded as a double. Below 10^14 scaling and the digits of the text are off by less than
    0.02 units, so all but numbers near a tie (0.45 units or more from a whole one) have one answer; the others are cast.
    """
    kind = f"decimal({precision},{scale})"
    scaled = value * F.lit(float(10 ** scale))
    whole = F.rint(scaled)
    near = (F.abs(scaled) < 1e14) & (F.abs(scaled - whole) < 0.45)
    units = whole.cast("long").cast("decimal(15,0)")
    if scale:
        units = units * F.lit(Decimal(1).scaleb(-scale))
    return F.when(near, units.cast(kind)).otherwise(value.cast(kind))


def money_of_double(value: Column) -> Column:
    """``money`` of a double."""
    return decimal_of(value, 10, 2)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def rounded(value: Column, scale: int = 2) -> Column:
    """ROUND half away from zero on the decimal value, so that 1.005 (as double) gives 1.01.

    A warehouse turns a double into a decimal of 15 significant digits before it rounds. Ten digits after the point do the
    same here: binary noise of a computed mean, as in 49832.85499999999, counts as the tie that it is.
    """
    return F.round(value.cast("decimal(38,10)"), scale)


def percent(part: Column, whole: Column) -> Column:
    """part / whole x 100 with two decimals."""
    return rounded(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)))


def exact_mean(total: Column, count: Column) -> Column:
    """Mean of a decimal column from its exact sum and row count, before rounding."""
    return total.cast("decimal(24,2)") / F.nullif(count.cast("decimal(14,0)"), F.lit(0).cast("decimal(14,0)"))

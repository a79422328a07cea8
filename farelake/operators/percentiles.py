"""Exact continuous percentiles per group on decimal columns, with bounded work per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# A DECIMAL(10,2) has fewer than 2 x 10^10 values: at most 2 x 10^5 cells per group, 10^5 values per cell.
CELL_WIDTH = 100_000


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names])


def decimal_scale(df: DataFrame, value: str) -> int:
    """Digits after the point of a decimal column; other types have no exact cells and are refused."""
    kind = df.schema[value].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision > 18:
        raise TypeError(f"{value} is {kind.simpleString()}: percentiles need a decimal of 18 digits at most")
    return kind.scale


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows per (keys, unscaled value). Combined before the shuffle, so a hot group costs no more than its values."""
    scale = decimal_scale(df, value)
    amount = F.count("*") if weight is None else F.sum(weight)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_decimal")).agg(amount.alias("_n"))
    unscaled = (F.col("_decimal") * (10 ** scale)).cast("long")
    return counted.select(*keys, unscaled.alias("_value"), "_n").withColumn(
        "_cell", F.floor(F.col("_value") / CELL_WIDTH))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float],
                      weight: str | None = None) -> DataFrame:
    """PERCENTILE_CONT per group: {output column: fraction}. ``weight`` counts a row that many times.

    A group is never gathered: its value counts fall into cells, a running total over the cells finds the cells
    that hold the wanted ranks, and only those cells are ordered by value.
    """
    scale = decimal_scale(df, value)
    counts = value_counts(df, keys, value, weight)
    cell_keys = [*keys, "_cell"]
    by_cell = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (
        counts.groupBy(*cell_keys).agg(F.sum("_n").alias("_cell_n"))
        .withColumn("_total", F.sum("_cell_n").over(Window.partitionBy(*keys)))
        .withColumn("_below", F.sum("_cell_n").over(by_cell) - F.col("_cell_n"))
    )

    def rank(fraction: float) -> Column:
        return F.lit(float(fraction)) * (F.col("_total") - 1)

    def inside(position: Column, start: Column, size: Column) -> Column:
        return (position >= start) & (position < start + size)

    ends = [(name, end) for name in points for end in ("low", "high")]
    position = {
        (name, end): (F.floor if end == "low" else F.ceil)(rank(fraction))
        for name, fraction in points.items() for end in ("low", "high")
    }
    wanted = reduce(or_, [inside(position[key], F.col("_below"), F.col("_cell_n")) for key in ends])
    cells = cells.where(wanted).select(*cell_keys, "_total", "_below")

    by_value = Window.partitionBy(*cell_keys).orderBy("_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = (
        counts.alias("v").join(cells.alias("c"), _same("v", "c", cell_keys))
        .select("v.*", "c._total", "c._below")
        .withColumn("_start", F.col("_below") + F.sum("_n").over(by_value) - F.col("_n"))
        .groupBy(*keys)
        .agg(
            F.first("_total").alias("_total"),
            *[F.max(F.when(inside(position[key], F.col("_start"), F.col("_n")), F.col("_value"))).alias("_".join(key))
              for key in ends],
        )
    )

    def interpolated(name: str, fraction: float) -> Column:
        low, high = (F.col(f"{name}_{end}") / float(10 ** scale) for end in ("low", "high"))
        return (low + (high - low) * (rank(fraction) - F.floor(rank(fraction)))).alias(name)

    return found.select(*keys, *[interpolated(name, fraction) for name, fraction in points.items()])

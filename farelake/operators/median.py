"""Upper median per column and imputation with it, without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import Staging


def upper_median(df: DataFrame, name: str, staging: Staging):
    """sorted(non-null values)[n // 2] of a column, in the column's own type and order.

    Values are counted, the distinct ones range-partitioned and sorted; a total per partition finds the one partition that
    holds the rank, and a running total inside it finds the value. The path is the same for any number of rows and values.
    """
    counted = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    ordered = counted.repartitionByRange("value").sortWithinPartitions("value").withColumn("part", F.spark_partition_id())
    ordered = staging.write(ordered, "values")
    sizes = ordered.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row per shuffle partition
    rank = sum(row["n"] for row in sizes) // 2
    if not sizes:
        raise ValueError(f"column {name} has no value to take a median of")
    before = 0
    for row in sizes:
        if before + row["n"] > rank:
            break
        before += row["n"]
    running = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ordered.where(F.col("part") == row["part"]).withColumn("upto", F.sum("n").over(running) + before)
    return inside.where((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)).first()["value"]


def upper_medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """The upper median of each column; the input is read once and the staged values are removed."""
    with Staging(df.sparkSession) as staging:
        stored = staging.write(df.select(*columns), "input")
        return {name: upper_median(stored, name, staging) for name in columns}


def fill_missing_with_median(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL (and NaN) by the column's upper median, keeping the column type."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    clean = df.withColumns({
        name: F.when(~F.isnan(name), F.col(name)) for name in columns if kinds[name] in ("double", "float")
    }) if any(kinds[name] in ("double", "float") for name in columns) else df
    medians = upper_medians(clean, columns)
    return clean.withColumns({
        name: F.coalesce(F.col(name), F.lit(medians[name]).cast(kinds[name])) for name in columns
    })

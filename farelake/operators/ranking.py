"""Top-k over a whole result and per group, always under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def descending(measure: str, ties: Sequence[str]) -> list[Column]:
    """Largest measure first; equal measures ordered by the tie columns. NULL counts as the largest value."""
    return [F.col(measure).desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in ties]]


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def top_k(df: DataFrame, measure: str, ties: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*descending(measure, ties)).limit(k)


def top_k_per_group(df: DataFrame, groups: Sequence[str], measure: str, ties: Sequence[str], k: int) -> DataFrame:
    order = descending(measure, ties)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.where(F.col("_rn") <= k).drop("_rn").orderBy(*ascending(*groups), *order)

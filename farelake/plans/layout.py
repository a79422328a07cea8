"""Physical layout of the gold tables and readers that use it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import year_month
from ..operators.quality import QualityError
from ..operators.rules import GOLD_RULES, enforced
from ..session import session_conf
from ..sinks.tables import OPEN_PARTITIONS, replace_table
from .dims import DATE_END, DATE_START

FACT_PARTITION = "year_month"
ZONE_BUCKETS = 4


def _checked(condition: Column, value: Column, message: Column) -> Column:
    """The value, or a failed job: rows outside a table's declared partitions are rejected in the writing pass."""
    return F.when(condition, value).otherwise(F.raise_error(message))


def with_fact_partition(fact: DataFrame, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """Add the month partition; a date that is NULL or outside [start, end) fails the job."""
    date = F.col("pickup_date_key")
    declared = F.coalesce((date >= F.to_date(F.lit(start))) & (date < F.to_date(F.lit(end))), F.lit(False))
    message = F.concat(F.lit("no partition of the fact for date "), F.coalesce(date.cast("string"), F.lit("NULL")))
    return fact.withColumn(FACT_PARTITION, _checked(declared, year_month(date), message))


def write_fact(fact: DataFrame, table: str = "gold.fct_trips", start: str = DATE_START,
               end: str = DATE_END) -> DataFrame:
    """Monthly range partitions. A keyed fact arrives in pickup order, so a task writes to few months."""
    # A date that is NULL has no partition: that test rejects it already.
    rules = {name: rule for name, rule in GOLD_RULES["fct_trips"].items() if name != "pickup_date_key"}
    rows = with_fact_partition(enforced(fact, rules), start, end)
    with session_conf(fact.sparkSession, spark__sql__maxConcurrentOutputFileWriters=OPEN_PARTITIONS):
        return replace_table(rows, table, partition_by=[FACT_PARTITION])


def write_zone(dim: DataFrame, table: str = "gold.dim_zone") -> DataFrame:
    """Hash buckets on the zone key."""
    return replace_table(enforced(dim, GOLD_RULES["dim_zone"]), table, buckets=(ZONE_BUCKETS, "zone_key"))


def write_list(dim: DataFrame, table: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """One partition per listed value; any other value fails the job."""
    value = F.col(column)
    declared = F.coalesce(value.isin(*allowed), F.lit(False))
    message = F.concat(F.lit(f"no partition of {table} for "), F.coalesce(value, F.lit("NULL")))
    checked = dim.withColumn(column, _checked(declared, value, message))
    checked = enforced(checked, GOLD_RULES.get(table.rpartition(".")[2], {}))
    return replace_table(checked, table, partition_by=[column])


def in_window(fact: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Trips picked up in [start, end).

    Besides the date, the same limits are put on the pickup time (row-group statistics of the sorted files) and,
    when the fact is a stored table, on its month partition.
    """
    tests: list[Column] = []
    stored = FACT_PARTITION in fact.columns
    if start is not None:
        first = F.to_date(F.lit(start))
        tests += [F.col("pickup_date_key") >= first,
                  F.col("pickup_datetime") >= F.lit(start).cast("timestamp_ntz")]
        if stored:
            tests.append(F.col(FACT_PARTITION) >= F.lit(start[:7]))
    if end is not None:
        tests += [F.col("pickup_date_key") < F.to_date(F.lit(end)),
                  F.col("pickup_datetime") < F.lit(end).cast("timestamp_ntz")]
        if stored:
            # The end is excluded: a window that ends on the first of a month does not touch that month.
            tests.append(F.col(FACT_PARTITION) <= year_month(F.date_sub(F.to_date(F.lit(end)), 1)))
    return fact.where(reduce(and_, tests)) if tests else fact


def pruned_count(fact: DataFrame, first: str, last: str) -> DataFrame:
    """Trips with a pickup date between first and last, both included."""
    date = F.col("pickup_date_key")
    test = date.between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    if FACT_PARTITION in fact.columns:
        test &= F.col(FACT_PARTITION).between(first[:7], last[:7])
    return fact.where(test).agg(F.count("*").alias("trips"))


def zone_lookup(dim: DataFrame, key: int) -> DataFrame:
    return dim.where(F.col("zone_key") == key)


def assert_not_empty(fact: DataFrame) -> DataFrame:
    """Gate of the gold build."""
    if fact.limit(1).isEmpty():
        raise QualityError("the fact table has no rows")
    return fact

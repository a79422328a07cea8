"""Profiles of tables: counts per partition that add up, so data tests read only the partitions that changed.

A profile has one row per (part, measure, value) with a count ``n``:

* ``rows``, value NULL: rows of the partition, 0 for a partition without any;
* ``null:<column>``, value NULL: rows in which the column is missing;
* ``rule:<name>``, value NULL: rows that break a rule;
* ``value:<column>``, value as text: rows per distinct value, one of them NULL where values are missing.

All of it comes from one pass: the tested columns are grouping sets beside the partition, and every set combines before
the shuffle. A hot value is one row per task there. A profile grows with the distinct values of the tested columns, not
with the rows; it is grouped and joined like any table and never collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sinks.tables import replace_partitions

COLUMNS = ("part", "measure", "value", "n")
STORE_KEYS = ("table_name", "part")
STORE_SCHEMA = "measure string, value string, n long, table_name string, part string"
ROWS = "rows"


def profile(df: DataFrame, nulls: Sequence[str] = (), values: Sequence[str] = (), rules: Mapping[str, Column] | None = None,
            by: str | None = None) -> DataFrame:
    """(part, measure, value, n) of a table, from one scan; ``part`` is the text of the column ``by``, or empty.

    An empty table has an empty profile.
    """
    rules, values = dict(rules or {}), list(dict.fromkeys(values))
    part = F.col(by).cast("string") if by else F.lit("")
    flags = {f"null:{name}": F.col(name).isNull() for name in nulls} | {
        f"rule:{name}": F.coalesce(broken, F.lit(False)) for name, broken in rules.items()}
    # Copies under own names: grouping sets blank the grouped columns, which the flags must not see.
    own = df.select(part.alias("part"), *[F.col(name).alias(f"v{i}") for i, name in enumerate(values)],
                    *[flag.alias(f"f{i}") for i, flag in enumerate(flags.values())])
    counts = [F.count("*").alias("n"), *[F.count_if(f"f{i}").alias(f"c{i}") for i in range(len(flags))]]
    copies = [f"v{i}" for i in range(len(values))]
    sets = [["part"], *[["part", name] for name in copies]]
    counted = own.groupingSets(sets, "part", *copies).agg(F.grouping_id().cast("long").alias("s"), *counts)
    return _long(counted, flags, values)


def _long(counted: DataFrame, flags: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """Counted sets as rows; ``s`` has one bit per value column, set where the column is not grouped by."""
    def entry(measure: str, value: Column, n: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), value.cast("string").alias("value"), n.alias("n"))

    everything = (1 << len(values)) - 1
    none = F.lit(None).cast("string")
    entries = F.when(F.col("s") == everything, F.array(
        entry(ROWS, none, F.col("n")), *[entry(name, none, F.col(f"c{i}")) for i, name in enumerate(flags)]))
    for i, name in enumerate(values):
        bits = everything - (1 << (len(values) - 1 - i))
        entries = entries.when(F.col("s") == bits, F.array(entry(f"value:{name}", F.col(f"v{i}"), F.col("n"))))
    return counted.select("part", F.inline(entries)).select(*COLUMNS)


def merged(profiles: Iterable[DataFrame]) -> DataFrame:
    """(measure, value, n) of tables or partitions taken together."""
    together = reduce(DataFrame.unionByName, [one.select("measure", "value", "n") for one in profiles])
    return together.groupBy("measure", "value").agg(F.sum("n").alias("n"))


def store_profile(rows: DataFrame, table_name: str, store: str, parts: Sequence[str]) -> None:
    """Replace the stored profile of the given partitions of one table; the others are neither read nor written.

    ``rows`` is the profile of exactly these partitions. A partition that has lost all of its rows keeps one count of 0.
    """
    spark = rows.sparkSession
    if not parts:
        return
    absent = spark.createDataFrame([(part, ROWS, None, 0) for part in parts], "part string, measure string, value string, n long")
    named = rows.unionByName(absent).groupBy("part", "measure", "value").agg(F.sum("n").alias("n"))
    replace_partitions(named.withColumn("table_name", F.lit(table_name)).select("measure", "value", "n", *STORE_KEYS),
                       store, STORE_KEYS)


def stored_profile(spark: SparkSession, table_name: str, store: str) -> DataFrame:
    return spark.table(store).where(F.col("table_name") == table_name).select(*COLUMNS)

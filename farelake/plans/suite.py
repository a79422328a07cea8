"""The data-test suite: 44 tests over silver and gold, evaluated from one profile per table.

Tests are declared as data. Each table is read once for its profile, which answers row, value and relationship tests and
the row count, and once per unique column. Profiles can be stored per month, so that a later run profiles only the months
that changed. Everything becomes one DataFrame with one row per test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import quality
from ..operators.quality import QualityError
from ..schemas import SERVICES
from .profiles import ROWS, merged, profile, store_profile, stored_profile

MONTH = "source_month"
PAYMENT_KINDS = ("card", "cash", "other")


@dataclass(frozen=True)
class TableTests:
    """Tests of one table by column; ``relationships`` maps a column to (parent table, parent column).

    ``dense`` names unique columns that are numbered without wide gaps.
    """

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    dense: Sequence[str] = ()


_LOCATIONS = {"pu_location_id": ("taxi_zone_lookup", "LocationID"), "do_location_id": ("taxi_zone_lookup", "LocationID")}
_SILVER_REQUIRED = ("pickup_datetime", "dropoff_datetime", "trip_distance", "pu_location_id", "do_location_id")

SUITE = (
    TableTests("silver_yellow_trips", _SILVER_REQUIRED, (), {"service_type": ("yellow",)}, _LOCATIONS),
    TableTests("silver_green_trips", _SILVER_REQUIRED, (), {"service_type": ("green",)}, _LOCATIONS),
    TableTests("silver_trips_unified", ("pickup_datetime", "service_type"), (), {"service_type": SERVICES}),
    TableTests(
        "fct_trips", ("trip_key", "pickup_date_key", "pu_zone_key", "do_zone_key", "service_type"), ("trip_key",),
        {"service_type": SERVICES},
        {"pickup_date_key": ("dim_date", "date_key"), "pu_zone_key": ("dim_zone", "zone_key"),
         "do_zone_key": ("dim_zone", "zone_key")}, ("trip_key",),
    ),
    TableTests("dim_zone", ("zone_key",), ("zone_key",)),
    TableTests("dim_date", ("date_key",), ("date_key",)),
    TableTests("dim_service_type", ("service_type",), ("service_type",), {"service_type": SERVICES}),
    TableTests("dim_payment_type", ("payment_type_id", "payment_type"), ("payment_type_id",),
               {"payment_type": PAYMENT_KINDS}),
)
# Opt-in: keys of the fact that the suite leaves unchecked, and that may lack a dimension row.
OPTIONAL = (
    TableTests("fct_trips", (), (), {}, {
        "payment_type_id": ("dim_payment_type", "payment_type_id"),
        "vendor_id": ("dim_vendor", "vendor_id"),
        "ratecode_id": ("dim_rate_code", "rate_code_id"),
    }),
)

TEMPORAL = "rule_trips_in_order_and_not_negative"
REVENUE = "rule_daily_revenue_not_negative"
COUNTS = "rule_unified_count_equals_parts"
HOURS = "rule_pickup_hours_valid"


def _long(df: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    """One aggregate over df, turned into (test, failures) rows."""
    names = list(counters)
    row = df.agg(*[counters[name].alias(f"c{i}") for i, name in enumerate(names)])
    entries = F.array(*[F.struct(F.lit(name).alias("test"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias(
        "failures")) for i, name in enumerate(names)])
    return row.select(F.inline(entries))


def table_profile(tests: TableTests, df: DataFrame, by: str | None = None) -> DataFrame:
    """All counts that a table's row, value and relationship tests need, from one scan."""
    rules = {TEMPORAL: quality.breaks_trip_rule()} if tests.table == "silver_trips_unified" else {}
    return profile(df, tests.not_null, [*tests.accepted, *tests.relationships], rules, by)


def _profile_tests(tests: TableTests, counts: DataFrame, columns: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """(test, failures) from a profile. Parents are joined to the distinct values, not to the table."""
    def total(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("n")))

    counters = {f"not_null_{tests.table}_{c}": total(f"null:{c}") for c in tests.not_null}
    if tests.table == "silver_trips_unified":
        counters[TEMPORAL] = total(f"rule:{TEMPORAL}")
        counters[COUNTS] = total(ROWS)
    elif tests.table in ("silver_yellow_trips", "silver_green_trips"):
        counters[COUNTS] = -total(ROWS)  # the three signed counts add up to zero when consistent
    for column, allowed in tests.accepted.items():
        counters[f"accepted_values_{tests.table}_{column}"] = F.count_if(
            (F.col("measure") == f"value:{column}") & ~F.col("value").isin(*map(str, allowed)))
    values = merged([counts])
    for i, (column, (parent, parent_column)) in enumerate(tests.relationships.items()):
        # Compared as text in the child's type, so 7 and 7.0 are one key.
        key = F.col(parent_column).cast(columns.schema[column].dataType).cast("string")
        keys = tables[parent].select(key.alias(f"_parent{i}")).distinct()
        same = (F.col("measure") == f"value:{column}") & (F.col("value") == F.col(f"_parent{i}"))
        values = values.join(keys, same, "left")
        orphan = (F.col("measure") == f"value:{column}") & F.col("value").isNotNull() & F.col(f"_parent{i}").isNull()
        counters[f"relationships_{tests.table}_{column}"] = F.sum(F.when(orphan, F.col("n")))
    return _long(values, counters) if counters else None


def refresh_profiles(tables: Mapping[str, DataFrame], store: str, months: Sequence[str],
                     suite: Sequence[TableTests] = SUITE) -> None:
    """Recompute the stored profiles of the given months, for the suite's tables that have a month; only these are read.

    The first call takes every month. Later ones take the months that a load reports as changed.
    """
    for tests in suite:
        df = tables.get(tests.table)
        if df is not None and MONTH in df.columns:
            rows = table_profile(tests, df.where(F.col(MONTH).isin(*months)), MONTH)
            store_profile(rows, tests.table, store, months)


def stored_profiles(tables: Mapping[str, DataFrame], store: str, suite: Sequence[TableTests] = SUITE) -> dict[str, DataFrame]:
    """The stored profiles of the suite's tables that have a month, for ``suite_results``."""
    return {tests.table: stored_profile(tables[tests.table].sparkSession, tests.table, store)
            for tests in suite if MONTH in tables[tests.table].columns}


def _unique_tests(tests: TableTests, df: DataFrame) -> list[DataFrame]:
    repeated = {c: (quality.unique_dense if c in tests.dense else quality.unique)(df, c) for c in tests.unique}
    return [_long(values, {f"unique_{tests.table}_{c}": F.count("*")}) for c, values in repeated.items()]


def suite_results(tables: Mapping[str, DataFrame], suite: Sequence[TableTests] = SUITE,
                  profiles: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(test, failures, status) for every test of the suite and the four rules over silver and the marts.

    failures are violating rows for not_null, relationships and the rules, and violating values for unique and
    accepted_values. Dense unique columns are counted when this is called. Rules whose table is not given are left out.
    A table whose profile is given is not read, but for its unique columns.
    """
    parts: list[DataFrame] = []
    for tests in suite:
        df = tables[tests.table]
        counts = (profiles or {}).get(tests.table)
        part = _profile_tests(tests, table_profile(tests, df) if counts is None else counts, df, tables)
        parts += ([] if part is None else [part]) + _unique_tests(tests, df)
    if "gold_daily_revenue" in tables:
        parts.append(_long(quality.negative_revenue(tables["gold_daily_revenue"]), {REVENUE: F.count("*")}))
    if "gold_hourly_patterns" in tables:
        parts.append(_long(quality.invalid_hours(tables["gold_hourly_patterns"]), {HOURS: F.count("*")}))
    named = {f"part{i}": part for i, part in enumerate(parts)}
    text = " UNION ALL ".join(f"SELECT test, failures FROM {{{name}}}" for name in named)
    union = parts[0].sparkSession.sql(text, **named)  # one analysis of the union instead of one per part
    summed = union.groupBy("test").agg(F.sum("failures").alias("failures"))
    # Differing counts are one violating row.
    failures = F.when(F.col("test") == COUNTS, (F.col("failures") != 0).cast("long")).otherwise(F.col("failures"))
    return summed.select("test", failures.alias("failures")).select(
        "test", "failures", F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def run_suite(tables: Mapping[str, DataFrame], suite: Sequence[TableTests] = SUITE,
              profiles: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate the suite and fail if any test fails."""
    results = suite_results(tables, suite, profiles)
    rows = results.orderBy("test").collect()  # one row per declared test
    failed = [f"{r['test']} ({r['failures']})" for r in rows if r["failures"]]
    if failed:
        raise QualityError("data tests failed: " + ", ".join(failed))
    return results.sparkSession.createDataFrame(rows, results.schema)

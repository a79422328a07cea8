"""Monthly files -> bronze trips, with per-file status and the coverage table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..operators.ranking import ascending
from ..schemas import COVERAGE_COLUMNS, SERVICES
from ..sinks.tables import ensure_layer, replace_partitions, replace_table
from ..sources.trips import MONTHS, YEARS, discover_files, file_families, list_files, month_grid, read_files

TRIPS_TABLE = "bronze.trips"
COVERAGE_TABLE = "bronze.coverage"
PARTITION_BY = ("service_type", "source_month")
STATUS_SCHEMA = ("filename string, service_type string, source_month string, status string, row_count long, error string, "
                 "columns_left_out string, filepath string, modified timestamp")


def replace_month(df: DataFrame, table: str = TRIPS_TABLE) -> None:
    """Delete + insert of whole (service, month) partitions: loading a month twice leaves one copy.

    A service that silver does not know fails the load, since its rows would be left out later.
    """
    service = F.when(F.col("service_type").isin(*SERVICES), F.col("service_type")).otherwise(F.raise_error(
        F.concat(F.lit("unknown service: "), F.coalesce("service_type", F.lit("none")))).cast("string"))
    replace_partitions(df.withColumn("service_type", service), table, PARTITION_BY)


def loaded_months(trips: DataFrame) -> DataFrame:
    """Rows per (service_type, source_month); only partition values and row counts are read."""
    return trips.groupBy(*PARTITION_BY).agg(F.count("*").alias("row_count"))


def pending_months(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose (service, month) has no rows yet."""
    return files.join(loaded.select(*PARTITION_BY).distinct(), list(PARTITION_BY), "left_anti")


def coverage(grid: DataFrame, loaded: DataFrame, files: DataFrame) -> DataFrame:
    """Status of every month and service: rows -> loaded; no rows but a file -> failed; neither -> missing."""
    existing = files.select(*PARTITION_BY, F.lit(True).alias("file_exists")).distinct()
    keys = list(PARTITION_BY)
    joined = grid.select(*keys).join(loaded, keys, "left").join(existing, keys, "left")
    rows = F.coalesce(F.col("row_count"), F.lit(0).cast("long"))
    status = F.when(rows > 0, "loaded").when(F.col("file_exists"), "failed").otherwise("missing")
    return joined.select(
        F.col("source_month").alias("year_month"), "service_type", status.alias("status"), rows.alias("row_count"))


def coverage_listing(covered: DataFrame) -> DataFrame:
    return covered.select(*COVERAGE_COLUMNS).orderBy(*ascending("year_month", "service_type"))


def coverage_summary(covered: DataFrame) -> DataFrame:
    return covered.groupBy("status").agg(F.count("*").alias("months")).orderBy(*ascending("status"))


def update_coverage(spark: SparkSession, root: str, years: Sequence[int] = YEARS, months: Sequence[int] = MONTHS,
                    services: Sequence[str] = SERVICES, table: str = TRIPS_TABLE,
                    coverage_table: str = COVERAGE_TABLE) -> DataFrame:
    """Recompute and replace the coverage table."""
    grid = month_grid(spark, years, months, services)
    if spark.catalog.tableExists(table):
        loaded = loaded_months(spark.table(table))
    else:
        loaded = spark.createDataFrame([], "service_type string, source_month string, row_count long")
    return replace_table(coverage(grid, loaded, list_files(spark, root)), coverage_table)


def _rows_per_file(spark: SparkSession, families: Sequence[Sequence[str]]) -> dict[str, int]:
    """Row counts per file, or folder of part files; no column is read, and no row is grouped by its path."""
    counted = []
    for paths in families:
        schema = spark.read.parquet(paths[0]).schema  # files of a family have one schema
        counted += [spark.read.schema(schema).parquet(path).agg(F.lit(path).alias("path"), F.count("*").alias("count")) for path in paths]
    # One row per file of the calendar.
    return {_plain(row["path"]): row["count"] for row in reduce(DataFrame.unionAll, counted).collect()} if counted else {}


def _plain(path: str) -> str:
    """One spelling of a local path: file:/x and file:///x are the same."""
    return re.sub(r"^file:/+", "file:/", path)


def _drop_months(spark: SparkSession, table: str, months: Sequence[tuple[str, str]]) -> None:
    if months and spark.catalog.tableExists(table):
        for service, month in months:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION "
                      f"(service_type = '{service}', source_month = '{month}')")


def load_files(spark: SparkSession, files: Sequence[Row], table: str = TRIPS_TABLE) -> list[tuple]:
    """Load the given files (rows of ``discover_files``), one status row per file.

    The unit is the (service, month): all of its files must be given, and they replace its rows together. Normally all
    months are loaded by one job. If that job fails, for example on a damaged data page, each month is loaded by its own
    job. A month with a file that fails keeps its old rows, and all of its files are reported as failed.
    """
    families, broken, unknown = file_families(spark, [f["filepath"] for f in files])
    schema_of = {path: schema for schema, paths in families.items() for path in paths}
    months: dict[tuple[str, str], list[str]] = {}
    for f in files:
        months.setdefault((f["service_type"], f["source_month"]), []).append(f["filepath"])
    errors = {month: next(f"{path}: {broken[path]}" for path in paths if path in broken)
              for month, paths in months.items() if any(path in broken for path in paths)}
    counts: dict[str, int] = {}

    def load(some: Sequence[tuple[str, str]]) -> None:
        grouped: dict[str, list[str]] = {}
        for month in some:
            for path in months[month]:
                grouped.setdefault(schema_of[path], []).append(path)
        replace_month(read_files(spark, list(grouped.values())), table)
        counts.update(_rows_per_file(spark, list(grouped.values())))

    readable = [month for month in months if month not in errors]
    if readable:
        try:
            load(readable)
        except Exception:  # noqa: BLE001 - find the month at fault below
            for month in readable:
                try:
                    load([month])
                except Exception as error:  # noqa: BLE001
                    errors[month] = str(error)

    statuses = []
    for f in files:
        month = (f["service_type"], f["source_month"])
        about = (unknown.get(f["filepath"]), f["filepath"], f["modified"])
        if month in errors:
            reason = broken.get(f["filepath"]) or errors[month]
            statuses.append((f["filename"], *month, "failed", 0, reason, *about))
        else:
            statuses.append((f["filename"], *month, "loaded", counts.get(_plain(f["filepath"]), 0), None, *about))
    # Files without rows replace their month by nothing.
    emptied = [month for month, paths in months.items()
               if month not in errors and not any(counts.get(_plain(path), 0) for path in paths)]
    _drop_months(spark, table, emptied)
    return statuses


def ingest(spark: SparkSession, root: str, years: Sequence[int] = YEARS, months: Sequence[int] = MONTHS,
           services: Sequence[str] = SERVICES, table: str = TRIPS_TABLE, coverage_table: str = COVERAGE_TABLE,
           policy: str = "replace") -> DataFrame:
    """Load the calendar's files into bronze and refresh coverage.

    policy 'replace' reloads every file; 'skip' leaves months that already have rows. Returns one row per month and
    service of the calendar: loaded, failed, skipped, or missing (no file).
    """
    if policy not in ("replace", "skip"):
        raise ValueError(f"unknown policy {policy}")
    ensure_layer(spark, table.split(".")[0])
    files = discover_files(spark, root, years, months, services)
    todo, skipped = files, []
    if policy == "skip" and spark.catalog.tableExists(table):
        todo = pending_months(files, loaded_months(spark.table(table)))
        names = {row["filepath"] for row in todo.select("filepath").collect()}
        skipped = [
            (f["filename"], f["service_type"], f["source_month"], "skipped", 0, None, None, f["filepath"], f["modified"])
            for f in files.collect() if f["filepath"] not in names
        ]
    absent = month_grid(spark, years, months, services).join(files, list(PARTITION_BY), "left_anti").collect()
    missing = [(f"{m['service_type']}_tripdata_{m['source_month']}.parquet", m["service_type"], m["source_month"],
                "missing", 0, None, None, None, None) for m in absent]
    # Names and times of the calendar's files.
    statuses = load_files(spark, todo.orderBy("source_month", "service_type").collect(), table)
    update_coverage(spark, root, years, months, services, table, coverage_table)
    return spark.createDataFrame(statuses + skipped + missing, STATUS_SCHEMA)


def ingest_summary(statuses: DataFrame) -> DataFrame:
    """{total_inserted, files_processed, failed, skipped, missing} of one run."""
    loaded = F.col("status") == "loaded"
    return statuses.agg(
        F.coalesce(F.sum(F.when(loaded, F.col("row_count"))), F.lit(0).cast("long")).alias("total_inserted"),
        F.count_if(loaded).alias("files_processed"),
        *[F.count_if(F.col("status") == status).alias(status) for status in ("failed", "skipped", "missing")],
    )

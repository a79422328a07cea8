"""Incremental ingest: new, changed and failed monthly files replace their months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import FILE_PATTERN
from ..plans.ingest import COVERAGE_TABLE, PARTITION_BY, STATUS_SCHEMA, TRIPS_TABLE, load_files, update_coverage
from ..schemas import SERVICES
from ..sinks.tables import append_bronze, ensure_layer
from ..sources.trips import MONTHS, YEARS, list_files, month_grid
from .listing import FORMAT, FileChanges


def pending_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """All files of every month that has a file which the log doesn't show as loaded with this modification time."""
    done = log.where("status = 'loaded'").select("filepath", "modified").distinct()
    open_months = files.join(done, ["filepath", "modified"], "left_anti").select(*PARTITION_BY).distinct()
    return files.join(open_months, list(PARTITION_BY), "left_semi")


def ingest_changes(spark: SparkSession, root: str, table: str = TRIPS_TABLE, log_table: str = "bronze.ingest_log",
                   coverage_table: str = COVERAGE_TABLE, years: Sequence[int] = YEARS, months: Sequence[int] = MONTHS,
                   services: Sequence[str] = SERVICES, strict: bool = False) -> DataFrame:
    """One run: load what is new, changed or failed before, log every file, refresh coverage.

    Files are listed as in the batch load, for the calendar and its services only. A run that was stopped is repeated
    by the next one, since months are replaced and the log is written after them. With ``strict`` a failed file fails
    the run after the others are loaded and logged.
    """
    for name in (table, log_table, coverage_table):
        ensure_layer(spark, name.split(".")[0])
    calendar = month_grid(spark, years, months, services).select(*PARTITION_BY)
    files = list_files(spark, root).join(calendar, list(PARTITION_BY), "left_semi")
    if spark.catalog.tableExists(log_table):
        files = pending_files(files, spark.table(log_table))
    statuses = load_files(spark, files.orderBy(*PARTITION_BY, "filepath").collect(), table)  # names of the calendar's files
    if statuses:
        append_bronze(spark.createDataFrame(statuses, STATUS_SCHEMA), log_table)
    update_coverage(spark, root, years, months, services, table, coverage_table)
    failed = [f"{s[0]}: {s[5]}" for s in statuses if s[3] == "failed"]
    if strict and failed:
        raise RuntimeError("; ".join(failed))
    return spark.createDataFrame(statuses, STATUS_SCHEMA)


def ingest_stream(spark: SparkSession, root: str, checkpoint: str, table: str = TRIPS_TABLE, log_table: str = "bronze.ingest_log",
                  coverage_table: str = COVERAGE_TABLE, trigger: str | None = "1 minute", **calendar) -> StreamingQuery:
    """Runs ``ingest_changes`` whenever files are new, have changed or have gone; failed files are tried again in every run.

    Without a trigger the stream does what there is to do since its last run and ends: the form for a weekly schedule.
    """
    spark.dataSource.register(FileChanges)
    changes = spark.readStream.format(FORMAT).option("pattern", FILE_PATTERN).load(root)

    def run(_names: DataFrame, _batch_id: int) -> None:
        # The caller's session writes the tables, so that its cached file listings stay current.
        ingest_changes(spark, root, table, log_table, coverage_table, **calendar)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()

"""Table, view and CSV sinks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from ..operators.upsert import upsert_by_key
from ..session import Staging, delete_path, session_conf

# Keeps files near the size of a parquet row group or two; small enough to read in parallel, few enough to list.
ROWS_PER_FILE = 4_000_000
# Partitions that a task may write side by side; beyond them it sorts the rest of its rows by partition.
OPEN_PARTITIONS = "32"


def ensure_layer(spark: SparkSession, name: str) -> None:
    """Create the database of a layer under exactly this name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _writer(df: DataFrame, partition_by: Sequence[str], buckets: tuple[int, str] | None) -> DataFrameWriter:
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    return writer


def _version_path(spark: SparkSession, table: str, stem: str) -> str | None:
    """Folder of a version written by ``replace_table``; None for files that are not ours to remove."""
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    location = about.get("Location", "")
    return location if re.fullmatch(rf".*/{re.escape(stem)}-[0-9a-f]{{12}}", location) else None


def _names(table: str) -> tuple[str, str]:
    """Names of the version being written and of the previous version."""
    return f"{table}__new", f"{table}__old"


def _drop_version(spark: SparkSession, table: str, stem: str) -> None:
    if spark.catalog.tableExists(table):
        path = _version_path(spark, table, stem)
        spark.sql(f"DROP TABLE {table}")
        if path:
            delete_path(spark, path)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with the files of all versions that ``replace_table`` wrote."""
    for name in (table, *_names(table)):
        _drop_version(spark, name, table.rpartition(".")[2])


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo a replacement that was interrupted, before anything is dropped.

    A run that ends between the two renames leaves no table of this name: its previous version gets the name back.
    """
    fresh, old = _names(table)
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    _drop_version(spark, fresh, table.rpartition(".")[2])


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                  buckets: tuple[int, str] | None = None) -> DataFrame:
    """Replace a table by a DataFrame that may read that table.

    Every version has its own folder. The new one is written under another name and the names are swapped after the
    write has succeeded: a failed write leaves the old table as it was, an interrupted swap is undone by the next call.
    The previous version stays, as ``<table>__old``, until the next replacement, so that running readers can finish.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    fresh, old = _names(table)
    recover_table(spark, table)
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = f"{home.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _writer(df, partition_by, buckets).option("path", path).saveAsTable(fresh)
    if spark.catalog.tableExists(table):
        _drop_version(spark, old, name)
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    return spark.table(table)


materialize = replace_table
refresh = replace_table  # an incremental model that empties its target first is a full replace


def upsert_table(batch: DataFrame, table: str, key: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Delete + insert by key into a table, creating it when absent; columns follow the batch.

    Where the key holds the partition columns and the columns are the table's own, only the partitions that the batch
    touches are read and rewritten.
    """
    spark = batch.sparkSession
    recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        return replace_table(batch, table, partition_by)
    target = spark.table(table)
    if partition_by and set(partition_by) <= set(key) and dict(target.dtypes) == dict(batch.dtypes):
        with Staging(spark) as staging:
            batch = staging.write(batch, "batch")
            touched = batch.select(*(F.col(name).alias(f"_touched_{name}") for name in partition_by)).distinct()
            same = reduce(and_, (target[name].eqNullSafe(touched[f"_touched_{name}"]) for name in partition_by))
            merged = upsert_by_key(target.join(touched, same, "left_semi"), batch, key)
            replace_partitions(staging.write(merged, "merged"), table, partition_by)
        return spark.table(table)
    return replace_table(upsert_by_key(target, batch, key), table, partition_by)


def append_bronze(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                  rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append rows in chunks (files) of bounded length."""
    writer = df.write.format("parquet").mode("append").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def create_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partitions}")


def replace_partitions(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that the rows belong to; the other partitions are not read or written.

    The table is created first, so that a failed load leaves an empty table and can be repeated.
    """
    spark = df.sparkSession
    create_table(spark, table, df.schema, partition_by)
    with session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic",
                      spark__sql__maxConcurrentOutputFileWriters=OPEN_PARTITIONS,
                      spark__sql__files__maxRecordsPerFile=str(ROWS_PER_FILE)):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

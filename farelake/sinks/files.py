"""Tables as a list of live files: an upsert by any key rewrites the files that hold one of its keys, the others stay.

The catalog table ``<table>__files`` lists the files of the current version with the columns to read them by; it is replaced
as one (``replace_table``), which publishes all changes of an upsert together. Files are read by name, so columns that a batch
adds are NULL in older files and columns that it drops are not read. Files that neither the current nor the previous list
holds are removed by the next upsert; readers that run keep their files that long. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.upsert import upsert_by_key
from ..session import Staging, delete_path, session_conf
from .tables import ROWS_PER_FILE, replace_table

LIST_SCHEMA = "path string, columns string"


def _list_name(table: str) -> str:
    return f"{table}__files"


def _home(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}-files"


def live_files(spark: SparkSession, table: str) -> list[str]:
    """Paths of the current version."""
    return [row["path"] for row in spark.table(_list_name(table)).where("path IS NOT NULL").orderBy("path").collect()]


def _read(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _schema(spark: SparkSession, table: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.table(_list_name(table)).first()["columns"]))


def read_files_table(spark: SparkSession, table: str) -> DataFrame:
    """The current version, whatever is written later."""
    return _read(spark, live_files(spark, table), _schema(spark, table))


def _add_files(df: DataFrame, table: str) -> list[str]:
    """Write rows as new files, which no list holds yet."""
    spark = df.sparkSession
    folder = f"{_home(spark, table)}/{uuid.uuid4().hex[:12]}"
    with session_conf(spark, spark__sql__files__maxRecordsPerFile=str(ROWS_PER_FILE)):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder).inputFiles()


def _publish(spark: SparkSession, table: str, paths: Sequence[str], schema: T.StructType) -> None:
    """Replace the list, by files of the folder; an empty table keeps its columns in a row without a path."""
    columns = json.dumps(schema.jsonValue())
    listed = spark.createDataFrame([(path, columns) for path in paths] or [(None, columns)], LIST_SCHEMA)
    replace_table(listed.coalesce(1), _list_name(table))


def store_files_table(df: DataFrame, table: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write a whole table. Sorted by its key, a file holds a narrow range, and a batch of near keys touches few files."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # given, so that small ranges aren't put together
    rows = df.repartitionByRange(parts, *sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    _publish(spark, table, _add_files(rows, table), df.schema)
    return read_files_table(spark, table)


def _remove_unlisted(spark: SparkSession, table: str) -> None:
    names = [_list_name(table), f"{_list_name(table)}__old"]
    listed = {row["path"] for name in names if spark.catalog.tableExists(name) for row in spark.table(name).collect()}
    for path in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(
            _home(spark, table)).select("path").collect():
        if not any(_same(path["path"], other) for other in listed if other):
            delete_path(spark, path["path"])


def _same(one: str, other: str) -> bool:
    """Two spellings of a local path are one: file:/x and file:///x."""
    return one.split(":", 1)[-1].lstrip("/") == other.split(":", 1)[-1].lstrip("/")


def upsert_files_table(batch: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Delete + insert by key; columns follow the batch.

    Only the key columns of the table are read to find the files that hold a key of the batch. Those are read whole and
    written anew without these keys, and the batch with them. A column that changes its type rewrites all files.
    """
    spark = batch.sparkSession
    if not spark.catalog.tableExists(_list_name(table)):
        return store_files_table(batch, table, key)
    with Staging(spark) as staging:
        batch = staging.write(batch, "batch")
        old, paths = _schema(spark, table), live_files(spark, table)
        _remove_unlisted(spark, table)
        kinds = {field.name: field.dataType for field in old.fields}
        if any(kinds.get(field.name, field.dataType) != field.dataType for field in batch.schema.fields):
            touched = paths
        else:
            keys = batch.select(*key).distinct()
            found = _read(spark, paths, T.StructType([old[name] for name in key])).select(*key, "_metadata.file_path") if paths else None
            touched = [row["file_path"] for row in found.join(keys, list(key), "left_semi").select("file_path").distinct().collect()] if paths else []
        kept = [path for path in paths if not any(_same(path, other) for other in touched)]
        merged = upsert_by_key(_read(spark, [path for path in paths if path not in kept], old), batch, key)
        _publish(spark, table, [*kept, *_add_files(merged, table)], batch.schema)
    return read_files_table(spark, table)

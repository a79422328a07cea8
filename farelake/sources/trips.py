"""Trip files: listing, scans by schema family, CSV."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.normalize import FILE_PATTERN, file_month, file_service, union_months, with_lineage
from ..operators.quality import require_rows
from ..schemas import BRONZE_FILE_SCHEMA, RAW_TO_BRONZE, SERVICES

YEARS = (2022, 2023, 2024, 2025)
MONTHS = tuple(range(1, 13))


def month_grid(spark: SparkSession, years: Sequence[int] = YEARS, months: Sequence[int] = MONTHS,
               services: Sequence[str] = SERVICES) -> DataFrame:
    """Every (source_month, service_type, year, month) of the load calendar."""
    rows = [(f"{y}-{m:02d}", s, y, m) for y, m, s in product(years, months, services)]
    return spark.createDataFrame(rows, "source_month string, service_type string, year int, month int")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(filepath, filename, service_type, source_month, modified) of the trip files under a folder; no content is read.

    A folder of part files counts as one file, modified when the last of its parts was.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime")
        .withColumn("filepath", F.regexp_extract("path", rf"^(.*/{FILE_PATTERN})", 1))
        .where(F.col("filepath") != "")
    )
    files = listed.groupBy("filepath").agg(F.max("modificationTime").alias("modified"))
    return files.select(
        "filepath",
        F.substring_index("filepath", "/", -1).alias("filename"),
        file_service(F.col("filepath")).alias("service_type"),
        file_month(F.col("filepath")).alias("source_month"),
        "modified",
    )


def discover_files(spark: SparkSession, root: str, years: Sequence[int] = YEARS, months: Sequence[int] = MONTHS,
                   services: Sequence[str] = SERVICES) -> DataFrame:
    """Files that exist for the load calendar; fails when there is none."""
    grid = month_grid(spark, years, months, services)
    found = list_files(spark, root).join(grid, ["service_type", "source_month"])
    columns = ["filepath", "filename", "service_type", "source_month", "modified", "year", "month"]
    return require_rows(found.select(columns), f"trip files under {root}")


def file_families(spark: SparkSession, paths: Sequence[str]) -> tuple[dict[str, list[str]], dict[str, str], dict[str, str]]:
    """Group files by schema, reading footers only.

    Returns {schema: paths}, {unreadable path: whole error} and {path: its columns that bronze has no place for}. The
    load calendar bounds the number of files; their footers are read side by side.
    """
    known = {field.name for field in BRONZE_FILE_SCHEMA.fields}

    def schema_of(path: str):
        try:
            return path, spark.read.parquet(path).schema, None
        except Exception as error:  # noqa: BLE001 - any unreadable file is reported, the others go on
            return path, None, str(error)

    families: dict[str, list[str]] = {}
    broken: dict[str, str] = {}
    unknown: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for path, schema, error in pool.map(schema_of, paths):
            if schema is None:
                broken[path] = error
                continue
            families.setdefault(schema.simpleString(), []).append(path)
            left_out = [name for name in schema.names if RAW_TO_BRONZE.get(name, name.lower()) not in known]
            if left_out:
                unknown[path] = ", ".join(sorted(left_out))
    return families, broken, unknown


def read_files(spark: SparkSession, families: Iterable[Sequence[str]]) -> DataFrame:
    """Bronze rows of trip files: one scan per schema family, service and month taken from the file path."""
    lineage = ("service_type", "source_month", "ingest_ts")
    path = F.col("_metadata.file_path")
    frames = [
        with_lineage(spark.read.parquet(*paths), file_service(path), file_month(path)) for paths in families
    ]
    bronze = union_months(frames, keep=lineage)
    return bronze.select(*[c for c in bronze.columns if c not in lineage], "ingest_ts", "service_type", "source_month")


def scan_trips(spark: SparkSession, root: str, service: str, months: Sequence[str]) -> DataFrame:
    """Bronze rows of one service for the given 'YYYY-MM' months."""
    paths = [f"{root.rstrip('/')}/{service}_tripdata_{month}.parquet" for month in months]
    families, broken, _ = file_families(spark, paths)
    if broken:
        raise FileNotFoundError("; ".join(f"{p}: {e}" for p, e in broken.items()))
    return read_files(spark, families.values())


def scan_trips_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Trip CSV with a header; a malformed value fails. Types are inferred (one extra pass) unless a schema is given."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)

"""Raw file columns -> bronze columns, lineage columns, and unification of files with different schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import nan_to_null
from ..schemas import BRONZE_FILE_SCHEMA, RAW_TO_BRONZE

# Trip files are named <service>_tripdata_<year>-<month>.parquet, as one file or as a folder of part files.
FILE_PATTERN = r"([A-Za-z]+)_tripdata_(\d{4}-\d{2})\.parquet"


def normalize_columns(df: DataFrame, mapping: Mapping[str, str] = RAW_TO_BRONZE) -> DataFrame:
    """Rename through the mapping, lower-casing what it does not list, in one projection."""
    return df.select([F.col(f"`{name}`").alias(mapping.get(name, name.lower())) for name in df.columns])


_MARK = "_tripdata_"


def file_service(path: Column) -> Column:
    """Service in a path that matches FILE_PATTERN; plain substrings, since scans evaluate this for every row."""
    last = F.substring_index(path, _MARK, -2)  # folders above may contain the mark too
    return F.substring_index(F.substring_index(last, _MARK, 1), "/", -1)


def file_month(path: Column) -> Column:
    return F.left(F.substring_index(path, _MARK, -1), F.lit(7))


def with_lineage(df: DataFrame, service: Column | str, month: Column | str, ts: Column | None = None) -> DataFrame:
    """Add service_type, source_month and one load timestamp (Spark fixes current_timestamp per query)."""
    as_column = lambda value: F.lit(value) if isinstance(value, str) else value
    return df.withColumns({
        "service_type": as_column(service),
        "source_month": as_column(month),
        "ingest_ts": F.current_timestamp() if ts is None else ts,
    })


def conform(df: DataFrame, schema: T.StructType = BRONZE_FILE_SCHEMA, keep: Iterable[str] = ()) -> DataFrame:
    """Cast to the schema in its order: NaN becomes NULL, absent columns become NULL, ``keep`` follows unchanged."""
    present = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        kind = present.get(field.name)
        if kind is None:
            value = F.lit(None)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = nan_to_null(F.col(field.name))
        else:
            value = F.col(field.name)
        return value.cast(field.dataType).alias(field.name)

    return df.select([column(field) for field in schema.fields] + [F.col(name) for name in keep])


def union_months(frames: Iterable[DataFrame], schema: T.StructType = BRONZE_FILE_SCHEMA,
                 keep: Iterable[str] = ()) -> DataFrame:
    """One frame from months whose columns or types differ (each is conformed, so no schema merge is needed)."""
    keep = tuple(keep)
    conformed = [conform(normalize_columns(frame), schema, keep) for frame in frames]
    return reduce(lambda left, right: left.unionByName(right), conformed)

"""Key-based delete + insert on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def sync_columns(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Give the old rows the batch's columns: new ones as NULL, dropped ones removed."""
    present = set(old.columns)
    return old.select([
        (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in batch.schema.fields
    ])


def upsert_by_key(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch, in the batch's columns.

    Rows of the target with a NULL key never match and stay.
    """
    kept = target.join(batch.select(*key).distinct(), list(key), "left_anti")
    return sync_columns(kept, batch).unionByName(batch)

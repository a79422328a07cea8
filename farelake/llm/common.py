"""Helpers shared by the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# A document's key: its id (nulls as the smallest number) and a hash of id and text. Both are never null.
KEY = ["_llm_id", "_llm_key"]


def once_per_worker(slot: str, key: Hashable, make: Callable):
    """``make()``, kept in the Python worker until the slot is asked for another key.

    A task's functions are copies with module variables of their own, so what outlives a task is kept beside them.
    """
    held = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__.setdefault("held", {})
    if slot not in held or held[slot][0] != key:
        held.pop(slot, None)  # let go first, or the worker holds two of them while the next one is made
        held[slot] = key, make()
    return held[slot][1]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have."""
    while wanted.lower() in (name.lower() for name in df.columns):
        wanted += "_"
    return wanted


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Short slices of Arrow batches: they bound what is held as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def append_columns(df: DataFrame, source: str, fields: Sequence[T.StructField],
                   function: Callable[[list], Sequence[pa.Array]], arrow: bool = False) -> DataFrame:
    """Append ``fields``, computed by ``function`` from the values of one column, batch by batch.

    With ``arrow`` the function is given the Arrow array instead of a list.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    place, names = df.columns.index(source), [*df.columns, *(field.name for field in fields)]

    def run(batches):
        for batch in slices(batches):
            values = batch.column(place)
            added = function(values if arrow else values.to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return df.mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """Add the key. Rows with equal id and text are one document and get one decision."""
    return docs.withColumns({
        KEY[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), KEY[1]: F.xxhash64("doc_id", "text")})


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; an id that is null belongs to fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))

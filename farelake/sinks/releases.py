"""Tables that are published together: a layer points to one release, a set of versions.

A release is a database of its own, ``<layer>__r<id>``, that nobody reads until it is published. Publishing is one change of
the layer's properties, so all tables switch at once or none does; ``published`` reads that pointer once and returns the
tables of one release, however long the reader needs for them. The tables' plain names are views of the current release, for
SQL text; they are set after the switch, and again by the next build if that was interrupted. The release before the current
one stays for readers that are still running, older ones and interrupted ones are removed by the next release. One build
at a time writes a layer.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path
from .tables import drop_table, ensure_layer

CURRENT, PREVIOUS = "release", "previous_release"


def _about(spark: SparkSession, database: str) -> dict[str, str]:
    return {row["info_name"]: row["info_value"] for row in spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()}


def _pointer(spark: SparkSession, layer: str) -> dict[str, str]:
    """The layer's current and previous release, as far as there are any."""
    if not spark.catalog.databaseExists(layer):
        return {}
    properties = _about(spark, layer).get("Properties", "")
    return dict(re.findall(rf"\(({CURRENT}|{PREVIOUS}),\s*([^()]*)\)", properties))


def _names(spark: SparkSession, database: str) -> list[str]:
    """Tables of a database; previous versions that a replacement keeps are not among them."""
    listed = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN `{database}`").collect() if not row["isTemporary"]]
    return [name for name in listed if not name.endswith(("__new", "__old"))]


def published(spark: SparkSession, layer: str) -> dict[str, DataFrame]:
    """All tables of the layer's current release; empty before the first one."""
    release = _pointer(spark, layer).get(CURRENT)
    return {name: spark.table(f"{release}.{name}") for name in _names(spark, release)} if release else {}


def _set_names(spark: SparkSession, layer: str, release: str) -> None:
    for name in _names(spark, release):
        target = f"{layer}.{name}"
        if spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType != "VIEW":
            drop_table(spark, target)  # from before the layer had releases
        spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {release}.{name}")


def _drop_release(spark: SparkSession, release: str) -> None:
    location = _about(spark, release)["Location"]
    for row in spark.sql(f"SHOW TABLES IN `{release}`").collect():
        if not row["isTemporary"]:
            drop_table(spark, f"{release}.{row['tableName']}")
    spark.sql(f"DROP DATABASE `{release}` CASCADE")
    delete_path(spark, location)


def _clean(spark: SparkSession, layer: str, keep: set[str]) -> None:
    for row in spark.sql(f"SHOW DATABASES LIKE '{layer}__r*'").collect():
        if re.fullmatch(rf"{re.escape(layer)}__r[0-9a-f]{{12}}", row["namespace"]) and row["namespace"] not in keep:
            _drop_release(spark, row["namespace"])


@contextmanager
def new_release(spark: SparkSession, layer: str) -> Iterator[str]:
    """The database for the tables of the next release, published when the block ends without an exception.

    Otherwise everything stays as it was, and what was written is removed.
    """
    ensure_layer(spark, layer)
    before = _pointer(spark, layer)
    if CURRENT in before:
        _set_names(spark, layer, before[CURRENT])
    _clean(spark, layer, set(before.values()))
    release = f"{layer}__r{uuid.uuid4().hex[:12]}"
    ensure_layer(spark, release)
    try:
        yield release
    except BaseException:
        _drop_release(spark, release)
        raise
    previous = f", '{PREVIOUS}' = '{before[CURRENT]}'" if CURRENT in before else ""
    spark.sql(f"ALTER DATABASE `{layer}` SET DBPROPERTIES ('{CURRENT}' = '{release}'{previous})")
    _set_names(spark, layer, release)
    _clean(spark, layer, {release, before.get(CURRENT)})

"""Session settings and the shared staging area."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on the first three; the others only affect speed.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "farelake", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set SQL options (dots written as double underscores) for the duration of one write."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or a folder in the warehouse where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of tables written by this package."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Staging:
    """Written tables that cut lineage: once written, a lost executor costs a re-read, not a recompute.

    As a context manager the tables are removed on exit; otherwise they live as long as the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or staging_root(spark)}/farelake-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        target = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self) -> None:
        delete_path(self.spark, self.path)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.drop()

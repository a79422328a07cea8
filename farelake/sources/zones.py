"""Zone lookup: the raw CSV (missing-value words become NULL) and the typed seed (text kept as written)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import QualityError
from ..schemas import ZONE_CSV_SCHEMA
from ..sinks.tables import replace_table

# Words the raw CSV reader takes as missing.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=ZONE_CSV_SCHEMA, mode="FAILFAST", encoding="UTF-8")


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Raw lookup with missing-value words as NULL and the load time."""
    raw = _csv(spark, path)
    text = [name for name, kind in raw.dtypes if kind == "string"]
    return raw.withColumns({
        name: F.when(~F.col(name).isin(*MISSING_WORDS), F.col(name)) for name in text
    }).withColumn("ingest_ts", F.current_timestamp())


def load_zones(spark: SparkSession, path: str, table: str = "bronze.taxi_zone_lookup") -> DataFrame:
    """Replace the lookup table from the CSV."""
    return replace_table(scan_zones(spark, path), table)


def load_zones_if_missing(spark: SparkSession, path: str, table: str = "bronze.taxi_zone_lookup") -> int:
    """Load the lookup only when the table is absent or empty; returns its row count."""
    if not spark.catalog.tableExists(table) or spark.table(table).limit(1).isEmpty():
        load_zones(spark, path, table)
    return spark.table(table).count()


def load_seed(spark: SparkSession, path: str) -> DataFrame:
    """Typed lookup with text as written; ids must be present and unique."""
    seed = _csv(spark, path)
    bad = seed.groupBy("LocationID").count().where(F.col("LocationID").isNull() | (F.col("count") > 1))
    if not bad.limit(1).isEmpty():
        raise QualityError("zone seed has missing or repeated LocationID values")
    return seed

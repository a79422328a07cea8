"""CSV reads that keep bad lines aside instead of ending at the first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import Staging

LINE, FILE = "_rejected_line", "_rejected_file"
_OPTIONS = {"quote": '"', "escape": '"'}


def _reason(schema: T.StructType) -> Column:
    """Names the columns whose text has no value of their type; without any, the number of fields is wrong."""
    as_text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema.fields])
    raw = F.from_csv(F.col(LINE), as_text.simpleString()[len("struct<"):-1].replace(":", " "), _OPTIONS)
    bad = [F.when(F.col(f.name).isNull() & (raw[f.name] != ""), F.lit(f.name)) for f in schema.fields]
    names = F.concat_ws(", ", *bad)
    return F.when(names != "", F.concat(F.lit("no value: "), names)).otherwise("number of fields")


def split_csv(spark: SparkSession, path: str, schema: T.StructType, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of CSV files with a header; good rows plus rejects are all lines.

    Rejects are (file, line, reason): the whole line as it stands, and the columns whose text doesn't fit their type or the
    note that the number of fields differs. Empty fields are missing values and no fault; empty lines are no lines. Column
    names are words of letters, digits and underscores. The files are read once, into the staging folder: both results come
    from there, so reading few columns of the good rows can't change which lines are good.
    """
    wanted = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    read = spark.read.csv(path, header=True, schema=wanted, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, **_OPTIONS)
    stored = staging.write(read.withColumn(FILE, F.col("_metadata.file_path")), "csv")
    rejected = stored.where(F.col(LINE).isNotNull())
    return (stored.where(F.col(LINE).isNull()).select(*schema.names),
            rejected.select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), _reason(schema).alias("reason")))


def rejects_per_file(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("file", "reason").agg(F.count("*").alias("lines"))

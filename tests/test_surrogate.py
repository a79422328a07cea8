from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from farelake.operators.surrogate import add_surrogate_key, placed
from farelake.session import Staging

ORDER = ["t", "service"]


def hot_table(spark, rows=60_000):
    """A third of the rows share the order columns, another third are copies of one row."""
    n = F.col("id")
    return spark.range(0, rows, 1, 6).select(
        F.when(n % 3 == 0, n).when(n % 3 == 1, 5_000).otherwise(7_000).alias("t"),
        F.when(n % 2 == 0, "a").otherwise("b").alias("service"),
        F.when(n % 3 == 2, 0).otherwise(n).alias("payload"),
    ).withColumn("service", F.when(F.col("t") == 7_000, "a").otherwise(F.col("service")))


def test_key_is_contiguous_ordered_and_complete(spark):
    df = hot_table(spark)
    with Staging(spark) as staging:
        keyed = add_surrogate_key(df, ORDER, staging).cache()
        rows = keyed.orderBy("trip_key").collect()
        assert [r["trip_key"] for r in rows] == list(range(1, 60_001))
        order = [(r["t"], r["service"]) for r in rows]
        assert order == sorted(order)
        assert Counter((r["t"], r["service"], r["payload"]) for r in rows) == Counter(
            tuple(r) for r in df.collect())
        keyed.unpersist()


def test_hot_values_and_copies_are_spread(spark):
    with Staging(spark) as staging:
        sizes = [r["count"] for r in placed(hot_table(spark), ORDER, staging).groupBy("_range").count().collect()]
        plan_text = final_plan(add_surrogate_key(hot_table(spark), ORDER, staging, replayable=True))
    even = 60_000 / (8 * 3)
    assert sum(sizes) == 60_000 and len(sizes) > 16 and max(sizes) < 3 * even
    # The rows are shuffled once, by range; the counts' plan is read from its table.
    assert plan_text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan_text and "rangepartitioning" not in plan_text


@pytest.mark.parametrize("span", [1, 40])
def test_hours_of_pickup_times(spark, span):
    """Quiet hours share ranges, crowded ones are cut; missing times come first."""
    seconds = F.when(F.col("id") % 5 == 0, F.col("id") * 977 % (span * 3600)).otherwise(F.col("id") % 7)
    df = spark.range(0, 20_000, 1, 5).select(
        F.when(F.col("id") % 1000 != 0, F.timestamp_seconds(1_700_000_000 + seconds).cast("timestamp_ntz")).alias("t"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("service"), "id")
    with Staging(spark) as staging:
        rows = add_surrogate_key(df, ORDER, staging, replayable=True).orderBy("trip_key").collect()
        sizes = [r["count"] for r in placed(df, ORDER, staging).groupBy("_range").count().collect()]
    assert [r["trip_key"] for r in rows] == list(range(1, 20_001)) and {r["id"] for r in rows} == set(range(20_000))
    order = [(r["t"] is not None, str(r["t"]), r["service"]) for r in rows]
    assert order == sorted(order, key=lambda one: (one[0], one[1] if one[0] else "", one[2])) and max(sizes) < 3 * 20_000 / 24


def test_one_write_of_the_rows(spark):
    """From a stored table nothing but counts is written before the result."""
    spark.range(5_000).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), F.lit("a").alias("service"), "id").write.mode(
        "overwrite").saveAsTable("key_source")
    written = []

    class Watched(Staging):
        def write(self, df, name):
            written.append((name, df.columns))
            return super().write(df, name)

    keyed = add_surrogate_key(spark.table("key_source"), ORDER, Watched(spark), replayable=True)
    assert keyed.count() == 5_000 and all("id" not in columns for _, columns in written)
    assert add_surrogate_key(spark.table("key_source").where("id < 0"), ORDER, Staging(spark)).count() == 0


def test_content_decides_the_key(spark):
    df = hot_table(spark, 3_000)
    with Staging(spark) as staging:
        one = add_surrogate_key(df, ORDER, staging)
        two = add_surrogate_key(df.repartition(5, "payload"), ORDER, staging)
        assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}

import re

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from farelake.operators import quality


def found(df, column="k"):
    return sorted(map(tuple, quality.unique_dense(df, column).select(column, "n_records").collect()))


def plain(df, column="k"):
    return sorted(map(tuple, quality.unique(df, column).collect()))


@pytest.mark.parametrize("kind", ["int", "long"])
def test_a_duplicate_hidden_by_a_gap_is_found(spark, kind):
    keys = spark.range(1, 200_001).select(F.col("id").cast(kind).alias("k"))
    assert found(keys) == []
    # One key replaced by its neighbour: row count, smallest and largest key stay the same.
    shifted = keys.select(F.when(F.col("k") == 70_000, 69_999).otherwise(F.col("k")).alias("k"))
    assert found(shifted) == plain(shifted) == [(69_999, 2)]


def test_edges_negative_keys_nulls_and_hot_keys(spark):
    edges = [-2**63, 2**63 - 1, -32_769, -32_768, -32_767, -1, 0, 1, 32_767, 32_768, 32_769, 65_536, 65_537]
    make = lambda values: spark.createDataFrame([(value,) for value in values], "k long")
    assert found(make(edges + [None, None])) == []
    for value in edges:
        assert found(make([*edges, value, None])) == [(value, 2)]
    hot = make(edges).union(spark.range(50_000).select(F.lit(7).cast("long")))
    assert found(hot) == [(7, 50_000)]
    assert found(make([])) == [] and quality.unique_dense(make([]), "k").columns == ["k", "n_records"]


def test_no_key_is_shuffled(spark, tmp_path):
    spark.range(1, 500_001).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    ranges = quality.crowded_ranges(keys, "k")
    text = final_plan(ranges)
    assert re.search(r"Exchange hashpartitioning\(range", text) or re.search(r"Exchange hashpartitioning\(_group", text)
    assert text.index("partial_bitmap_construct_agg") > text.index("Exchange")  # bits are set below the shuffle
    assert "FileScan" not in final_plan(quality.unique_dense(keys, "k"))

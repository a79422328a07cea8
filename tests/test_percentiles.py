import random
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest

from pyspark.sql import functions as F

from farelake.operators import percentiles
from farelake.operators.median import fill_missing_with_median, upper_medians
from farelake.operators.percentiles import exact_percentiles

POINTS = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def test_percentiles_match_brute_force(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.choice([1, 2]),
             Decimal(rng.randrange(-50_000_000, 50_000_000)) / 100 if rng.random() < 0.6 else Decimal("12.34"))
            for _ in range(4_000)]
    rows += [("single", 1, Decimal("7.00")), ("nothing", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v decimal(10,2)")
    groups = defaultdict(list)
    for g, h, v in rows:
        if v is not None:
            groups[g, h].append(float(v))
    got = {(r["g"], r["h"]): [r[p] for p in POINTS] for r in exact_percentiles(df, ["g", "h"], "v", POINTS).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key] == pytest.approx([np.percentile(values, 100 * p) for p in POINTS.values()], abs=1e-6)


def test_weighted_counts_equal_repeated_rows(spark):
    rows = [("a", Decimal("1.00"), 3), ("a", Decimal("2.00"), 1), ("a", Decimal("2.00"), 2), ("a", Decimal("9.50"), 5)]
    df = spark.createDataFrame(rows, "g string, v decimal(10,2), n long")
    values = [float(v) for _, v, n in rows for _ in range(n)]
    row = exact_percentiles(df, ["g"], "v", POINTS, weight="n").first()
    assert [row[p] for p in POINTS] == pytest.approx([np.percentile(values, 100 * p) for p in POINTS.values()])


def test_small_cells_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "CELL_WIDTH", 3)
    df = spark.createDataFrame([("a", Decimal(i) / 100) for i in range(101)], "g string, v decimal(10,2)")
    row = exact_percentiles(df, ["g"], "v", POINTS).first()
    assert [row[p] for p in POINTS] == pytest.approx([0.0, 0.5, 0.9, 1.0])


@pytest.mark.parametrize("values, expected", [([1, 2, 3, 4], 3), ([1, 2, 3, 4, 5], 3), ([7], 7), ([2, None, 1], 2)])
def test_upper_median(spark, values, expected):
    assert upper_medians(spark.createDataFrame([(v,) for v in values], "x int"), ["x"]) == {"x": expected}


def test_median_of_nothing_fails(spark):
    with pytest.raises(ValueError, match="no value"):
        fill_missing_with_median(spark.createDataFrame([(None,), (None,)], "x int"))


def test_many_values_and_heavy_ones(spark):
    rng = random.Random(3)
    columns = {
        "uniform": [rng.random() for _ in range(6_000)],
        "heavy": [5.0 if i % 3 else rng.gauss(5, 1e6) for i in range(6_000)],
        "edge": [rng.random() for _ in range(3_000)] + [2.0] * 2_999 + [3.0],
        "wild": [rng.gauss(0, 1) * 10 ** rng.randrange(-9, 9) for _ in range(6_000)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    expected = {c: sorted(v)[len(v) // 2] for c, v in columns.items()}
    assert upper_medians(df, list(columns)) == expected


def test_median_keeps_the_columns_own_type(spark):
    wide = 2 ** 53
    df = spark.createDataFrame([(wide + n, Decimal(n) / 3, str(n)) for n in (1, 3, 5)] + [(None, None, None)],
                               "a long, b decimal(38,20), c string")
    assert upper_medians(df, ["a", "b", "c"]) == {"a": wide + 3, "b": Decimal(1).quantize(Decimal(10) ** -20), "c": "3"}
    assert fill_missing_with_median(df).where(f"a = {wide + 3}").count() == 2


def test_percentiles_refuse_other_types(spark):
    for kind in ("double", "decimal(20,2)", "int"):
        with pytest.raises(TypeError, match="decimal"):
            exact_percentiles(spark.createDataFrame([(1,)], "v int").withColumn("v", F.col("v").cast(kind)), [], "v", POINTS)
    df = spark.createDataFrame([(Decimal(n) / 1000,) for n in (1001, 1002, 1004)], "v decimal(10,3)").withColumn("g", F.lit(1))
    assert exact_percentiles(df, ["g"], "v", POINTS).first()["p50"] == 1.002


def test_fill_keeps_types_and_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1, 1.5), (None, float("nan")), (3, 2.5), (4, None)], "a int, b double")
    filled = fill_missing_with_median(df)
    assert filled.dtypes == [("a", "int"), ("b", "double")]
    assert [tuple(r) for r in filled.collect()] == [(1, 1.5), (3, 2.5), (3, 2.5), (4, 2.5)]

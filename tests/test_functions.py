import math
from datetime import date, datetime
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from farelake import functions as fx
from farelake.operators.normalize import file_month, file_service
from farelake.plans.dims import borough_code, dim_date


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_integers_round_half_even(spark):
    rows = [(1.5,), (2.5,), (-0.5,), (3.49,), (None,)]
    assert values(spark, rows, "x double", fx.half_even_int(F.col("x"))) == [(2,), (2,), (0,), (3,), (None,)]


def test_money_rounds_half_away_and_overflow_fails(spark):
    rows = [(0.125,), (-0.125,), (2.675,), (99999999.99,)]
    got = values(spark, rows, "x double", fx.money(F.col("x")))
    assert got == [(Decimal("0.13"),), (Decimal("-0.13"),), (Decimal("2.68"),), (Decimal("99999999.99"),)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        values(spark, [(123456789.5,)], "x double", fx.money(F.col("x")))


@pytest.mark.parametrize("precision, scale, top", [(10, 2, 9e7), (28, 8, 1e12), (28, 14, 1e3), (18, 0, 1e16)])
def test_doubles_become_the_decimals_of_a_cast(spark, precision, scale, top):
    """Also at ties, one step of a double beside them, and where scaled numbers have no digits left."""
    random = Random(7)
    unit = 10.0 ** -scale
    rows = [None, 0.0, -0.0, 1.005, 2.675, 0.285, 1e13, 1e14 * unit, 5e-324, unit, unit / 2]
    rows += [random.uniform(-1, 1) * 10 ** random.uniform(-scale - 2, math.log10(top)) for _ in range(3000)]
    ties = [(random.randrange(10 ** random.randrange(1, 9)) + 0.5) * unit for _ in range(1000)]
    cents = [random.randrange(-10 ** 7, 10 ** 7) / 100 for _ in range(1000)]
    rows += ties + cents + [math.nextafter(x, side) for x in ties for side in (-math.inf, math.inf)]
    rows = [(x,) for x in rows if x is None or abs(x) <= top] + [(math.inf,), (-math.inf,), (math.nan,)]
    x = F.col("x")
    cast = x.cast(f"decimal({precision},{scale})")
    df = spark.createDataFrame(rows, "x double").select("x", fx.decimal_of(x, precision, scale).alias("fast"), cast.alias("cast"))
    assert df.schema["fast"].dataType == df.schema["cast"].dataType
    assert df.where(~F.col("fast").eqNullSafe(F.col("cast"))).collect() == []
    for beyond in (10.0 ** (precision - scale), 1e30):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            values(spark, [(beyond,)], "x double", fx.decimal_of(x, precision, scale))


def test_ratio_percent_and_means(spark):
    rows = [(3.0, 0.0), (3.0, 4.0), (None, 2.0)]
    assert values(spark, rows, "a double, b double", fx.ratio(F.col("a"), F.col("b"))) == [(None,), (0.75,), (None,)]
    assert values(spark, [(1, 32), (1, 0)], "a int, b int", fx.percent(F.col("a"), F.col("b"))) == [
        (Decimal("3.13"),), (None,)]
    assert values(spark, [(1.005,), (25.125,)], "x double", fx.rounded(F.col("x"))) == [
        (Decimal("1.01"),), (Decimal("25.13"),)]
    mean = F.round(fx.exact_mean(F.col("s"), F.col("n")), 2)
    assert values(spark, [(Decimal("2.01"), 2)], "s decimal(20,2), n long", mean) == [(Decimal("1.01"),)]


def test_rounding_takes_binary_noise_as_a_tie(spark):
    row = spark.sql("SELECT 1.005D AS a, 49832.85499999999D AS b, -2.675D AS c, 1.0049999D AS d").select(
        *[fx.rounded(F.col(name)).cast("string").alias(name) for name in "abcd"]).first()
    assert tuple(map(float, row)) == (1.01, 49832.86, -2.68, 1.0)


def test_nan_becomes_null(spark):
    assert values(spark, [(float("nan"),), (1.0,)], "x double", fx.nan_to_null(F.col("x"))) == [(None,), (1.0,)]


def test_calendar_parts(spark):
    rows = [(datetime(2024, 2, 25, 23, 59, 59),)]
    parts = fx.pickup_parts(F.col("t"))
    assert values(spark, rows, "t timestamp_ntz", *parts.values()) == [(date(2024, 2, 25), 2024, 2, 0, 23)]
    minutes = fx.minutes_between(F.col("a"), F.col("b"))
    rows = [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1, 30, 500_000))]
    got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", minutes)[0][0]
    assert got == pytest.approx(90.5 / 60)


def test_lineage_from_paths(spark):
    paths = ["hdfs:///raw/yellow_tripdata_2024-01.parquet",
             "s3a://b/x_tripdata_old/green_tripdata_2023-12.parquet/part-00000_c000.snappy.parquet"]
    got = values(spark, [(p,) for p in paths], "p string", file_service(F.col("p")), file_month(F.col("p")))
    assert got == [("yellow", "2024-01"), ("green", "2023-12")]


def test_hour_bands(spark):
    hours = [0, 5, 6, 9, 10, 11, 12, 15, 16, 17, 18, 19, 20, 23]
    got = values(spark, [(h,) for h in hours], "h int", fx.time_period(F.col("h")), fx.day_band(F.col("h")))
    assert [p for p, _ in got] == (["Late Night"] * 2 + ["Morning Rush"] * 2 + ["Midday"] * 4 + ["Evening Rush"] * 4
                                   + ["Night"] * 2)
    assert [b for _, b in got] == ["night"] * 2 + ["morning"] * 4 + ["afternoon"] * 4 + ["evening"] * 4


def test_dim_date(spark):
    rows = {r["date_key"]: r for r in dim_date(spark).collect()}
    assert len(rows) == 1461
    leap = rows[date(2024, 2, 29)]
    assert (leap["day_of_year"], leap["quarter"], leap["day_name"], leap["month_name"], leap["is_weekend"]) == (
        60, 1, "Thursday", "February ", False)
    assert rows[date(2023, 1, 1)]["week_of_year"] == 52  # ISO week of the year before
    assert rows[date(2024, 3, 3)]["is_weekend"] and rows[date(2024, 3, 2)]["is_weekend"]
    assert rows[date(2024, 9, 1)]["year_month"] == "2024-09"
    assert max(rows) == date(2025, 12, 31)


def test_borough_codes(spark):
    names = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown", None]
    got = values(spark, [(n,) for n in names], "b string", borough_code(F.col("b")))
    assert [c for (c,) in got] == [1, 2, 3, 4, 5, 6, 7, 7]

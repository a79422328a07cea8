import pytest
from pyspark.sql import functions as F

from farelake.operators.rules import GOLD_RULES, Rule, enforced, violations
from farelake.plans import dims, layout
from farelake.sinks.tables import ensure_layer


def test_violations_are_counted_per_column(spark):
    df = spark.createDataFrame([("ab", 1), (None, None), ("a", 2), ("", 3)], "flag string, n int")
    rules = {"flag": Rule(length=1), "n": Rule(required=True)}
    assert {tuple(r) for r in violations(df, rules).collect()} == {("flag", 1), ("n", 1)}
    assert violations(df.where("false"), rules).count() == 2


def test_broken_rules_fail_the_write(spark):
    df = spark.createDataFrame([("Y", "2024-01-01"), (None, "2024-01-02")], "store_and_fwd_flag string, d string").withColumn(
        "pickup_date_key", F.to_date("d"))
    assert enforced(df, GOLD_RULES["fct_trips"]).count() == 2 and enforced(df, GOLD_RULES["fct_trips"]).dtypes == df.dtypes
    for bad in (df.withColumn("store_and_fwd_flag", F.lit("NO")), df.withColumn("pickup_date_key", F.lit(None).cast("date"))):
        with pytest.raises(Exception, match="column rule of"):
            enforced(bad, GOLD_RULES["fct_trips"]).collect()


def test_layout_enforces_the_rules(spark, zones):
    ensure_layer(spark, "ruled")
    assert layout.write_zone(dims.dim_zone(zones), "ruled.dim_zone").count() == zones.count()
    missing = dims.dim_zone(zones).withColumn("zone_key", F.when(F.col("zone_key") > 1, F.col("zone_key")))
    with pytest.raises(Exception, match="column rule of zone_key"):
        layout.write_zone(missing, "ruled.dim_zone")
    assert spark.table("ruled.dim_zone").count() == zones.count()

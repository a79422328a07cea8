import pytest
from pyspark.sql import functions as F

from farelake.operators.upsert import upsert_by_key
from farelake.sinks import files as f
from farelake.sinks.tables import ensure_layer


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def orders(spark):
    ensure_layer(spark, "files")
    return spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("old").alias("name"))


def test_upsert_touches_files_of_its_keys_only(spark, orders):
    f.store_files_table(orders, "files.a", ["k"])
    before = f.live_files(spark, "files.a")
    batch = spark.createDataFrame([(3, 70, "new"), (4, 71, "new"), (5000, 1, "new"), (5000, 2, "new")], "k long, v long, name string")
    reader = f.read_files_table(spark, "files.a")
    out = f.upsert_files_table(batch, "files.a", ["k"])
    after = f.live_files(spark, "files.a")
    assert len(before) > 3 and len(set(before) & set(after)) == len(before) - 1
    assert rows(out) == rows(upsert_by_key(orders, batch, ["k"]))
    assert rows(reader) == rows(orders)  # a reader of the version before still finds its files
    f.upsert_files_table(batch.limit(0), "files.a", ["k"])
    out = f.upsert_files_table(batch.withColumn("v", -F.col("v")), "files.a", ["k"])
    assert rows(out) == rows(upsert_by_key(orders, batch.withColumn("v", -F.col("v")), ["k"]))
    home = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f._home(spark, "files.a"))
    listed = {name for table in ("files.a__files", "files.a__files__old") for name in [row["path"] for row in spark.table(table).collect()]}
    f._remove_unlisted(spark, "files.a")
    assert home.count() == len(listed)


def test_columns_follow_the_batch(spark, orders):
    f.store_files_table(orders.unionByName(spark.createDataFrame([(None, 1, "none")], "k long, v long, name string")), "files.b", ["k"])
    before = f.live_files(spark, "files.b")
    batch = spark.createDataFrame([(900, True, 5)], "k long, fresh boolean, v long")
    out = f.upsert_files_table(batch, "files.b", ["k"])
    assert out.columns == ["k", "fresh", "v"] and out.count() == 1001 and out.where("fresh").count() == 1
    assert out.where("k IS NULL").count() == 1 and len(set(before) & set(f.live_files(spark, "files.b"))) == len(before) - 1
    wider = f.upsert_files_table(batch.withColumn("v", F.lit("text")), "files.b", ["k"])
    assert wider.where("v = '1'").count() > 100 and not set(before) & set(f.live_files(spark, "files.b"))


def test_a_failed_upsert_changes_nothing(spark, orders, monkeypatch):
    f.store_files_table(orders, "files.c", ["k"])
    before = f.live_files(spark, "files.c")
    bad = spark.range(1).select(F.lit(3).cast("long").alias("k"), F.raise_error(F.lit("stop")).cast("long").alias("v"), F.lit("x").alias("name"))
    with pytest.raises(Exception, match="stop"):
        f.upsert_files_table(bad, "files.c", ["k"])

    def stopped(*_):
        raise KeyboardInterrupt

    batch = spark.createDataFrame([(3, 70, "new")], "k long, v long, name string")
    monkeypatch.setattr(f, "_publish", stopped)
    with pytest.raises(KeyboardInterrupt):
        f.upsert_files_table(batch, "files.c", ["k"])
    monkeypatch.undo()
    assert f.live_files(spark, "files.c") == before and rows(f.read_files_table(spark, "files.c")) == rows(orders)
    assert rows(f.upsert_files_table(batch, "files.c", ["k"])) == rows(upsert_by_key(orders, batch, ["k"]))


def test_empty_tables(spark, orders):
    f.store_files_table(orders.limit(0), "files.d", ["k"])
    assert f.read_files_table(spark, "files.d").count() == 0
    assert rows(f.upsert_files_table(orders, "files.d", ["k"])) == rows(orders)
    assert rows(f.upsert_files_table(orders.limit(5), "files.e", ["k"])) == rows(orders.limit(5))

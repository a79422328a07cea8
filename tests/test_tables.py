from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from farelake.sinks import tables as t
from farelake.session import Staging, staging_root
from farelake.operators.upsert import upsert_by_key


@pytest.fixture(scope="module", autouse=True)
def layer(spark):
    t.ensure_layer(spark, "sink")
    t.ensure_layer(spark, "sink")
    assert spark.catalog.databaseExists("sink")


def test_replace_reads_its_own_table_and_survives_a_failed_write(spark):
    t.replace_table(spark.range(5), "sink.a")
    assert t.replace_table(spark.table("sink.a").where("id > 1"), "sink.a").count() == 3
    with pytest.raises(Exception):
        t.replace_table(spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), "sink.a")
    assert spark.table("sink.a").count() == 3
    assert [r["tableName"] for r in spark.sql("SHOW TABLES IN sink LIKE 'a*'").collect()] in (["a", "a__old"], ["a", "a__new", "a__old"])
    assert t.replace_table(spark.range(2), "sink.a").count() == 2


def test_partitioned_replace(spark):
    df = spark.range(6).withColumn("p", F.col("id") % 3)
    t.replace_table(df, "sink.parts", ["p"])
    assert t.replace_table(spark.table("sink.parts").where("p < 2"), "sink.parts", ["p"]).count() == 4


def test_upsert_syncs_columns(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, name string, gone double")
    batch = spark.createDataFrame([(2, "B", True), (3, "C", False), (3, "D", False)], "k int, name string, fresh boolean")
    rows = {tuple(r) for r in upsert_by_key(old, batch, ["k"]).collect()}
    assert rows == {(1, "a", None), (None, "n", None), (2, "B", True), (3, "C", False), (3, "D", False)}
    t.upsert_table(old, "sink.up", ["k"])
    assert t.upsert_table(batch, "sink.up", ["k"]).count() == 5
    assert t.refresh(batch, "sink.up").count() == 3


def test_append_and_replace_partitions(spark):
    t.append_bronze(spark.range(10).coalesce(1), "sink.app", rows_per_file=4)
    t.append_bronze(spark.range(10).coalesce(1), "sink.app", rows_per_file=4)
    table = spark.table("sink.app")
    assert table.count() == 20 and table.select(F.input_file_name()).distinct().count() == 6
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    t.replace_partitions(df, "sink.rp", ["p"])
    t.replace_partitions(df.where("p = 'y'").withColumn("v", F.lit(9)), "sink.rp", ["p"])
    assert {tuple(r) for r in spark.table("sink.rp").collect()} == {(1, "x"), (9, "y")}


def test_csv_and_view(spark, tmp_path):
    t.write_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True, inferSchema=True).agg(F.sum("id")).first()[0] == 3
    t.register_view(spark.range(4), "four")
    assert spark.table("four").count() == 4


@pytest.mark.parametrize("stop_at", [1, 2, 3])
def test_interrupted_swap_loses_nothing(spark, monkeypatch, stop_at):
    name = f"sink.swap{stop_at}"
    rows = spark.createDataFrame([(n, "old") for n in range(5)], "k int, v string")
    batch = spark.createDataFrame([(0, "new"), (9, "new")], "k int, v string")
    t.replace_table(rows, name)
    t.replace_table(rows, name)  # now there is a previous version as well
    real, calls = type(spark).sql, []

    def stopping(self, text, *args, **kwargs):
        if "RENAME" in text or "DROP" in text:
            calls.append(text)
            if len(calls) == stop_at:
                raise KeyboardInterrupt
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(KeyboardInterrupt):
        t.upsert_table(batch, name, ["k"])
    monkeypatch.undo()
    out = t.upsert_table(batch, name, ["k"])
    assert {tuple(r) for r in out.collect()} == {(0, "new"), (9, "new")} | {(n, "old") for n in range(1, 5)}


def test_upsert_rewrites_touched_partitions_only(spark):
    rows = spark.createDataFrame([(n, p, "old") for n in range(4) for p in ("a", "b", None)], "k int, p string, v string")
    t.replace_table(rows, "sink.touch", ["p"])
    files = lambda: {r[0] for r in spark.table("sink.touch").where("p = 'b'").select(F.input_file_name()).distinct().collect()}
    before = files()
    batch = spark.createDataFrame([(1, "a", "new"), (7, "a", "new"), (8, None, "new")], "k int, p string, v string")
    t.upsert_table(batch.select("k", "v", "p"), "sink.touch", ["k", "p"], ["p"])
    got = {tuple(r) for r in spark.table("sink.touch").select("k", "p", "v").collect()}
    wanted = {(n, p, "old") for n in range(4) for p in ("a", "b", None)} - {(1, "a", "old")}
    assert got == wanted | {(1, "a", "new"), (7, "a", "new"), (8, None, "new")} and files() == before


def session_stub(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: settings.get(name, *default)))


def test_staging_root_is_a_shared_folder():
    assert staging_root(session_stub(**{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    assert staging_root(session_stub(**{"spark.sql.warehouse.dir": "hdfs:///warehouse"})) == "hdfs:///warehouse/_staging"


def test_staged_tables_are_removed_on_exit(spark):
    with Staging(spark) as staging:
        staged = staging.write(spark.range(3), "x")
        assert staging.path in staged.inputFiles()[0] and staged.count() == 3
        path = staging.path
    with pytest.raises(Exception):
        spark.read.parquet(path + "/*")

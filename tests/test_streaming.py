import os

import pytest
from pyspark.sql import functions as F

from files import damaged_file, raw_file
from farelake.operators.normalize import FILE_PATTERN
from farelake.streaming.listing import FileChangesReader, list_paths
from farelake.streaming.monthly import ingest_changes, ingest_stream

CALENDAR = {"years": [2024], "months": [1, 2, 3]}


def run(spark, raw, layer, **more):
    return ingest_changes(spark, str(raw), f"{layer}.trips", f"{layer}.log", f"{layer}.coverage", **CALENDAR, **more)


def months(spark, layer):
    return {(r["service_type"], r["source_month"]): r["count"]
            for r in spark.table(f"{layer}.trips").groupBy("service_type", "source_month").count().collect()}


def later(path, seconds):
    """Set the modification time: some file systems keep whole seconds."""
    os.utime(path, (os.stat(path).st_mtime + seconds,) * 2)


def test_new_changed_and_repaired_files(spark, tmp_path):
    layer, raw = "bronze_changes", tmp_path / "raw"
    (raw / "deep").mkdir(parents=True)
    raw_file(raw, "yellow", "2024-01", 3)
    raw_file(raw / "deep", "yellow", "2024-01", 4)  # a month of two files
    raw_file(raw, "green", "2024-01", 5)
    raw_file(raw, "fhv", "2024-01", 7)              # not a service of the calendar
    raw_file(raw, "green", "2023-12", 5)            # not a month of the calendar
    damaged_file(raw, "green", "2024-02")
    status = {(r["service_type"], r["source_month"], r["status"]) for r in run(spark, raw, layer).collect()}
    assert status == {("yellow", "2024-01", "loaded"), ("green", "2024-01", "loaded"), ("green", "2024-02", "failed")}
    expected = {("yellow", "2024-01"): 7, ("green", "2024-01"): 5}
    assert months(spark, layer) == expected
    covered = {(r["service_type"], r["year_month"]): r["status"] for r in spark.table(f"{layer}.coverage").collect()}
    assert covered["green", "2024-02"] == "failed" and covered["yellow", "2024-02"] == "missing"
    # Nothing new but the failed file, which is tried again.
    assert [r["status"] for r in run(spark, raw, layer).collect()] == ["failed"]
    later(raw_file(raw, "green", "2024-02", 2), 5)
    later(raw_file(raw, "yellow", "2024-01", 30), 5)
    assert run(spark, raw, layer).count() == 3
    assert months(spark, layer) == {("yellow", "2024-01"): 34, ("green", "2024-01"): 5, ("green", "2024-02"): 2}
    assert run(spark, raw, layer).count() == 0
    assert spark.table(f"{layer}.coverage").where("status = 'loaded'").count() == 3


def test_folder_of_part_files(spark, tmp_path):
    layer, raw = "bronze_parts", tmp_path / "raw"
    raw.mkdir()
    (tmp_path / "one").mkdir()
    source = raw_file(tmp_path / "one", "yellow", "2024-01", 8)
    spark.read.parquet(source).repartition(3).write.parquet(str(raw / "yellow_tripdata_2024-01.parquet"))
    rows = run(spark, raw, layer).collect()
    assert [(r["status"], r["row_count"]) for r in rows] == [("loaded", 8)]
    assert run(spark, raw, layer).count() == 0


def test_strict_fails_after_the_others_are_loaded(spark, tmp_path):
    layer, raw = "bronze_strict", tmp_path / "raw"
    raw.mkdir()
    damaged_file(raw, "yellow", "2024-01")
    raw_file(raw, "green", "2024-01", 5)
    with pytest.raises(RuntimeError, match="yellow_tripdata_2024-01"):
        run(spark, raw, layer, strict=True)
    assert months(spark, layer) == {("green", "2024-01"): 5}


@pytest.fixture
def stream(spark, tmp_path):
    """A running stream over ``raw``; wait() returns the months when all changes are loaded."""
    layer, raw = f"bronze_{tmp_path.name.strip('0123456789')}", tmp_path / "raw"
    raw.mkdir()
    query = ingest_stream(spark, str(raw), str(tmp_path / "checkpoint"), f"{layer}.trips", f"{layer}.log", f"{layer}.coverage",
                          "1 second", **CALENDAR)

    def wait():
        query.processAllAvailable()
        return months(spark, layer)

    yield raw, wait, layer
    query.stop()


def test_stream_loads_new_names(spark, stream):
    raw, wait, layer = stream
    raw_file(raw, "yellow", "2024-01", 3)
    assert wait() == {("yellow", "2024-01"): 3}
    raw_file(raw, "green", "2024-02", 2)
    assert wait() == {("yellow", "2024-01"): 3, ("green", "2024-02"): 2}
    assert spark.table(f"{layer}.log").where(F.col("status") == "loaded").count() == 2


def test_stream_loads_a_file_published_again(spark, stream):
    raw, wait, _ = stream
    raw_file(raw, "yellow", "2024-01", 3)
    raw_file(raw, "green", "2024-01", 5)
    assert wait() == {("yellow", "2024-01"): 3, ("green", "2024-01"): 5}
    later(raw_file(raw, "yellow", "2024-01", 30), 5)
    assert wait() == {("yellow", "2024-01"): 30, ("green", "2024-01"): 5}


def test_stream_loads_a_repaired_file(spark, stream):
    raw, wait, layer = stream
    damaged_file(raw, "green", "2024-02")
    raw_file(raw, "yellow", "2024-01", 3)
    assert wait() == {("yellow", "2024-01"): 3}
    assert spark.table(f"{layer}.coverage").where("status = 'failed'").count() == 1
    later(raw_file(raw, "green", "2024-02", 2), 5)
    assert wait() == {("yellow", "2024-01"): 3, ("green", "2024-02"): 2}
    assert spark.table(f"{layer}.coverage").where("status = 'failed'").count() == 0


def test_stream_that_ends_goes_on_from_its_checkpoint(spark, tmp_path):
    layer, raw = "bronze_weekly", tmp_path / "raw"
    raw.mkdir()

    def week():
        query = ingest_stream(spark, f"file://{raw}", str(tmp_path / "checkpoint"), f"{layer}.trips", f"{layer}.log", f"{layer}.coverage",
                              None, **CALENDAR)
        assert query.awaitTermination(120)
        return len(query.recentProgress), spark.table(f"{layer}.log").count()

    raw_file(raw, "yellow", "2024-01", 3)
    week()
    assert months(spark, layer) == {("yellow", "2024-01"): 3}
    assert week()[1] == 1  # nothing has changed: no run
    later(raw_file(raw, "yellow", "2024-01", 4), 5)
    assert week()[1] == 2 and months(spark, layer) == {("yellow", "2024-01"): 4}


def test_offsets_hold_time_and_length(tmp_path):
    path = raw_file(tmp_path, "yellow", "2024-01", 3)
    (tmp_path / "notes.txt").write_text("not a trip file")
    (tmp_path / "green_tripdata_2024-01.parquet").mkdir()
    (tmp_path / "green_tripdata_2024-01.parquet" / "_SUCCESS").write_text("")
    reader = FileChangesReader(str(tmp_path), FILE_PATTERN)
    first = reader.latestOffset()
    assert first == {path: [os.stat(path).st_mtime_ns, os.stat(path).st_size]}
    assert [part.rows for part in reader.partitions(reader.initialOffset(), first)] == [[(path, *first[path])]]
    later(path, 5)
    second = reader.latestOffset()
    assert [row[0] for row in reader.partitions(first, second)[0].rows] == [path] and reader.partitions(second, second)[0].rows == []
    assert list_paths(str(tmp_path / "none"), FILE_PATTERN) == {}

"""The registered queries over stored tables: what is written once, and what a step reads."""

from pathlib import Path

from farelake.plans import ingest, layout
from farelake.sinks import tables

from checks import stored

FOLDER = "/root/testdata/sf0.001"


def folders(spark, name):
    root = Path(stored.Store.of(spark, FOLDER).staging.path.removeprefix("file:"))
    return sorted(path for path in root.glob(f"{name}-*"))


def test_month_files_are_written_from_their_own_rows(spark):
    store = stored.Store.of(spark, FOLDER)
    root = Path(store.months().removeprefix("file:"))
    [raw] = folders(spark, "raw")
    parts = {path.relative_to(raw).as_posix() for path in raw.glob("service_type=*/file_year=*")}
    assert parts <= {f"service_type={s}/file_year={y}" for s in stored.SERVICES for y in stored.YEARS} and parts
    assert len(list(root.glob("*_tripdata_*-01.parquet"))) == len(stored.SERVICES) * len(stored.YEARS)


def test_replaced_months_and_profiles_join_the_trips_once(spark):
    before = len(folders(spark, "bronze"))
    for query in (stored.s13_replace_month, stored.d09c_month_profiles):
        assert query(spark, FOLDER).count() > 0
    assert len(folders(spark, "bronze")) == before + 2


def test_partitions_are_written_without_a_sort(spark, bronze, monkeypatch):
    seen = []
    for module in (tables, layout):
        real = module.session_conf
        monkeypatch.setattr(module, "session_conf", lambda spark, real=real, **conf: seen.append(conf) or real(spark, **conf))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    tables.ensure_layer(spark, "unsorted")
    ingest.replace_month(bronze([{"source_month": f"2024-0{n}"} for n in range(1, 5)]), "unsorted.trips")
    assert [int(conf["spark__sql__maxConcurrentOutputFileWriters"]) for conf in seen] == [32]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert spark.table("unsorted.trips").count() == 4


def test_rows_per_file_group_no_rows_by_path(spark, tmp_path):
    paths = []
    for n in (0, 3, 5):
        paths.append(f"{tmp_path}/yellow_tripdata_2024-0{n + 1}.parquet")
        spark.range(n).write.parquet(paths[-1])
    plans = []
    collect = type(spark.range(0)).collect
    counts = {}
    try:
        type(spark.range(0)).collect = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df)
        counts = ingest._rows_per_file(spark, [paths])
    finally:
        type(spark.range(0)).collect = collect
    assert list(counts.values()) == [0, 3, 5] and not any("file_path" in plan for plan in plans)

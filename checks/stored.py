"""Registered queries that pass the tables through files and stored tables.

The given trips are written once per session and folder as monthly files (one per service and year, named by January), as
CSV, and into tables of a layer of their own; everything lies in the staging folder or the warehouse.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelake.operators import clean, quality
from farelake.operators.rules import GOLD_RULES, Rule, violations
from farelake.plans import build, dims, fact, ingest, layout, passengers, silver, suite
from farelake.session import Staging, session_conf
from farelake.sinks import files, tables
from farelake.sinks.releases import published
from farelake.sources import rejects, star, trips as trip_files, zones as zone_files
from farelake.sources.passengers import scan_passengers
from farelake.streaming.monthly import ingest_changes, ingest_stream

from .queries import DOMAIN, query

YEARS, SERVICES = range(1995, 2002), ("yellow", "green")
CALENDAR = {"years": list(YEARS), "months": [1]}


class Store:
    """Files of one folder of tables, written on first use."""

    _known: dict[tuple, "Store"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.staging = spark, folder, Staging(spark)
        self.layer = f"checks_{uuid.uuid4().hex[:8]}"
        self.made: dict[str, str] = {}
        tables.ensure_layer(spark, self.layer)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Store":
        key = (spark.sparkContext.applicationId, folder)
        return cls._known.setdefault(key, cls(spark, folder)) if key not in cls._known else cls._known[key]

    def path(self, name: str, write) -> str:
        if name not in self.made:
            self.made[name] = f"{self.staging.path}/{name}"
            write(self.made[name])
        return self.made[name]

    def months(self) -> str:
        """Raw files of all trips: the published column names differ by service."""
        def write(root: str) -> None:
            raw = star.raw_trips(self.spark, self.folder).withColumn("file_year", F.left("source_month", F.lit(4)))
            with session_conf(self.spark, spark__sql__maxConcurrentOutputFileWriters=tables.OPEN_PARTITIONS):
                raw = self.staging.write(raw, "raw", ["service_type", "file_year"])  # a file is written from its own rows only

            def publish(service: str, year: int) -> None:
                own = raw.where((F.col("service_type") == service) & (F.col("file_year") == str(year)))
                if service == "green":
                    own = own.withColumnsRenamed({f"tpep_{end}_datetime": f"lpep_{end}_datetime" for end in ("pickup", "dropoff")})
                    own = own.drop("Airport_fee")
                own.drop("service_type", "source_month", "file_year").write.parquet(f"{root}/{service}_tripdata_{year}-01.parquet")
            self.together(publish)
        return self.path("months", write)

    def together(self, publish) -> None:
        """Call publish(service, year) for every file, some side by side."""
        run = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(max_workers=4) as pool:
            for job in [pool.submit(run(publish), service, year) for service in SERVICES for year in YEARS]:
                job.result()

    def bronze(self) -> DataFrame:
        """The bronze rows, written for one query; a file holds all rows of few months, or a part of one month."""
        rows = star.bronze_trips(self.spark, self.folder).hint("rebalance", "service_type", "source_month")
        return self.staging.write(rows, "bronze")

    def zones(self) -> str:
        return self.path("zones", lambda path: tables.write_csv(star.zone_lookup(self.spark, self.folder).na.fill("N/A"), path))

    def passengers(self) -> str:
        key = F.col("c_custkey")
        rows = star.table(self.spark, self.folder, "customer").select(
            key.cast("int").alias("PassengerId"), (key % 2).cast("int").alias("Survived"), (key % 3 + 1).cast("int").alias("Pclass"),
            F.col("c_name").alias("Name"), F.lit("x").alias("Sex"), F.when(key % 5 != 0, (key % 80).cast("double")).alias("Age"),
            (F.col("c_nationkey") % 4).cast("int").alias("SibSp"), F.when(key % 7 != 0, (key % 6).cast("int")).alias("Parch"),
            F.col("c_mktsegment").alias("Ticket"), F.col("c_acctbal").alias("Fare"), F.lit(None).cast("string").alias("Cabin"),
            F.lit("S").alias("Embarked"))
        return self.path("passengers", lambda path: tables.write_csv(rows, path))

    def table(self, name: str) -> str:
        return f"{self.layer}.{name}"


def _totals(trips: DataFrame, *keys: str) -> DataFrame:
    return trips.groupBy(*keys).agg(F.count("*").alias("trips"), F.sum(F.col("total_amount").cast("decimal(14,2)")).alias("revenue"))


@query
def s01_scan_month_files(spark, folder):
    root = Store.of(spark, folder).months()
    months = [f"{year}-01" for year in YEARS]
    both = trip_files.scan_trips(spark, root, "yellow", months).unionByName(trip_files.scan_trips(spark, root, "green", months))
    return _totals(both, "service_type", "source_month")


@query
def s02_discover_files(spark, folder):
    found = trip_files.discover_files(spark, Store.of(spark, folder).months(), **CALENDAR)
    return found.select("filename", "service_type", "source_month", "year", "month")


@query
def s03_zone_csv(spark, folder):
    store = Store.of(spark, folder)
    return zone_files.load_zones(spark, store.zones(), store.table("zones")).drop("ingest_ts")


@query
def s04_zone_if_missing(spark, folder):
    store = Store.of(spark, folder)
    for _ in range(2):
        zone_files.load_zones_if_missing(spark, store.zones(), store.table("zones_once"))
    return spark.table(store.table("zones_once")).groupBy("Borough").agg(F.count("*").alias("zones"))


@query
def s05_zone_seed(spark, folder):
    return zone_files.load_seed(spark, Store.of(spark, folder).zones())


@query
def s06_trip_csv(spark, folder):
    store = Store.of(spark, folder)
    raw = star.raw_trips(spark, folder)
    path = store.path("trips_csv", lambda target: tables.write_csv(raw, target))
    read = trip_files.scan_trips_csv(spark, path, ", ".join(f"{name} {kind}" for name, kind in raw.dtypes))
    return _totals(read, "service_type", "payment_type")


@query
def s06b_rejected_lines(spark, folder):
    """All trips as CSV, the fare of every thirteenth pickup zone spoilt: good rows by service, other lines by reason."""
    store = Store.of(spark, folder)
    raw = star.raw_trips(spark, folder)
    spoilt = raw.withColumn("fare_amount", F.when(F.col("PULocationID") % 13 == 0, "n/a").otherwise(F.col("fare_amount").cast("string")))
    path = store.path("spoilt_csv", lambda target: tables.write_csv(spoilt, target))
    good, bad = rejects.split_csv(spark, path, raw.schema, store.staging)
    kept = good.groupBy("service_type").agg(F.lit("good").alias("reason"), F.count("*").alias("lines"))
    aside = rejects.rejects_per_file(bad).groupBy("reason").agg(F.sum("lines").alias("lines"))
    return kept.unionByName(aside.withColumn("service_type", F.lit(None).cast("string")))


@query
def s07_passenger_csv(spark, folder):
    return scan_passengers(spark, Store.of(spark, folder).passengers()).drop("Cabin")


@query
def s11_append(spark, folder):
    """All lineitems, appended in two halves and in chunks."""
    store = Store.of(spark, folder)
    name = store.table(f"appended_{uuid.uuid4().hex[:8]}")
    lines = star.table(spark, folder, "lineitem")
    for half in (0, 1):
        tables.append_bronze(lines.where(F.col("l_orderkey") % 2 == half), name, rows_per_file=10_000)
    return spark.table(name).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("lines"))


@query
def s13_replace_month(spark, folder):
    """Every month loaded twice, then those of 1999 once more without their cheap trips."""
    store = Store.of(spark, folder)
    name = store.table(f"replaced_{uuid.uuid4().hex[:8]}")
    bronze = store.bronze()
    for part in (bronze, bronze, bronze.where(F.col("source_month").startswith("1999") & (F.col("fare_amount") > 20000))):
        ingest.replace_month(part, name)
    return _totals(spark.table(name), "service_type", "source_month")


@query
def d09c_month_profiles(spark, folder):
    """Stored profiles of the service views: all months, then only those of 1999 after they lost their cheap trips."""
    store = Store.of(spark, folder)
    name, profiled = (store.table(f"{kind}_{uuid.uuid4().hex[:8]}") for kind in ("profiled", "profiles"))
    trips, zones = store.bronze(), star.zone_lookup(spark, folder)
    months = [row["source_month"] for row in trips.select("source_month").distinct().collect()]  # the load calendar
    late = [month for month in months if month.startswith("1999")]
    for rows, changed in ((trips, months), (trips.where(F.col("source_month").startswith("1999") & (F.col("fare_amount") > 20000)), late)):
        ingest.replace_month(rows, name)
        bronze = spark.table(name)
        suite.refresh_profiles({"silver_yellow_trips": silver.silver_yellow(bronze, zones),
                                "silver_green_trips": silver.silver_green(bronze, zones)}, profiled, changed)
    return spark.table(profiled).select("table_name", "part", "measure", "value", "n")


@query
def s15_ingest_status(spark, folder):
    """Status of every file and of the months without one."""
    store = Store.of(spark, folder)
    status = ingest.ingest(spark, store.months(), years=[*YEARS, 2002], months=[1], table=store.table("trips"),
                           coverage_table=store.table("coverage"))
    return status.select("filename", "service_type", "source_month", "status", "row_count", "error", "columns_left_out")


@query
def s17_replace(spark, folder):
    """A table replaced by a part of itself."""
    name = Store.of(spark, folder).table("orders")
    tables.replace_table(star.table(spark, folder, "orders"), name)
    return tables.replace_table(spark.table(name).where("o_orderstatus <> 'P'"), name).groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"))


@query
def s18_csv_sink(spark, folder):
    part = star.table(spark, folder, "part")
    path = Store.of(spark, folder).path("part_csv", lambda target: tables.write_csv(part, target))
    read = spark.read.csv(path, header=True, schema=", ".join(f"{name} {kind}" for name, kind in part.dtypes), mode="FAILFAST")
    return read.groupBy("p_brand").agg(F.count("*").alias("parts"), F.sum("p_size").alias("size"))


@query
def s21_materialize(spark, folder):
    lines = star.table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("lines"))
    return tables.materialize(lines, Store.of(spark, folder).table("supplier_lines"))


@query
def s22b_stored_upsert(spark, folder):
    """Orders by status after the last quarter of them is replaced, and as many are added; files without their keys stay."""
    name = Store.of(spark, folder).table(f"orders_{uuid.uuid4().hex[:8]}")
    orders = star.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(14,2)").alias("price"))
    files.store_files_table(orders, name, ["o_orderkey"])
    before = set(files.live_files(spark, name))
    last = orders.agg(F.max("o_orderkey")).first()[0]
    part = orders.where(F.col("o_orderkey") > last - last // 4)
    batch = part.withColumn("price", -F.col("price")).unionByName(part.withColumn("o_orderkey", F.col("o_orderkey") + last)).withColumn(
        "corrected", F.lit(True))
    out = files.upsert_files_table(batch, name, ["o_orderkey"])
    stay = bool(before & set(files.live_files(spark, name)))
    return out.groupBy("o_orderstatus", "corrected").agg(F.count("*").alias("orders"), F.sum("price").alias("price"), F.lit(stay).alias("files_stay"))


@query
def s19_layers(spark, folder):
    """Rows of a table in each layer, under exactly the layer's name."""
    store = Store.of(spark, folder)
    counts = []
    for layer in ("bronze", "silver", "gold"):
        name = f"{store.layer}_{layer}"
        tables.ensure_layer(spark, name)
        tables.materialize(star.table(spark, folder, "nation"), f"{name}.nation")
        exact = F.lit(name in [row["namespace"] for row in spark.sql(f"SHOW DATABASES LIKE '{name}'").collect()])
        counts.append(spark.table(f"{name}.nation").groupBy("n_regionkey").agg(F.count("*").alias("nations")).select(
            F.lit(layer).alias("layer"), "n_regionkey", "nations", exact.alias("exact")))
    return reduce(DataFrame.unionAll, counts)


@query
def s23_changes(spark, folder):
    """Coverage after an incremental run over all files, and a second one that finds nothing new."""
    store = Store.of(spark, folder)
    names = (store.table("inc_trips"), store.table("inc_log"), store.table("inc_coverage"))
    for _ in range(2):
        ingest_changes(spark, store.months(), *names, years=[*YEARS, 2002], months=[1])
    log = spark.table(names[1]).groupBy(F.col("source_month").alias("year_month"), "service_type").agg(F.count("*").alias("logged"))
    return spark.table(names[2]).join(log, ["year_month", "service_type"], "left")


@query
def s23b_stream_of_changes(spark, folder):
    """Coverage and revenue after two runs of the stream: between them, one file is published again and one is repaired."""
    store = Store.of(spark, folder)
    root = f"{store.staging.path}/arriving-{uuid.uuid4().hex[:8]}"
    layer = uuid.uuid4().hex[:8]
    names = [store.table(f"{name}_{layer}") for name in ("trips", "log", "coverage")]
    changed, damaged = ("yellow", 1999), ("green", 1997)

    def publish(service: str, year: int, some: DataFrame) -> None:
        some.write.mode("overwrite").parquet(f"{root}/{service}_tripdata_{year}-01.parquet")

    def first(service: str, year: int) -> None:
        raw = spark.read.parquet(f"{months}/{service}_tripdata_{year}-01.parquet")
        if (service, year) == damaged:
            raw.select(F.lit("no trips")).limit(1).write.text(f"{root}/{service}_tripdata_{year}-01.parquet")
        else:
            publish(service, year, raw.where("passenger_count = 1") if (service, year) == changed else raw)

    months = store.months()
    store.together(first)

    def run() -> None:
        query = ingest_stream(spark, root, f"{root}/_checkpoint", *names, trigger=None, **CALENDAR)
        query.awaitTermination()

    run()
    seen = spark.table(names[2]).select("year_month", "service_type", F.col("status").alias("first_status"), F.col("row_count").alias("first_rows"))
    seen = store.staging.write(seen, "first-coverage")
    for service, year in (changed, damaged):
        publish(service, year, spark.read.parquet(f"{months}/{service}_tripdata_{year}-01.parquet"))
    run()
    revenue = _totals(spark.table(names[0]), "service_type", "source_month").withColumnRenamed("source_month", "year_month").drop("trips")
    return spark.table(names[2]).join(seen, ["year_month", "service_type"]).join(revenue, ["year_month", "service_type"])


def _stored_fact(spark, folder) -> DataFrame:
    """The fact in its monthly partitions, written once."""
    store = Store.of(spark, folder)
    name = store.table("fct_trips")
    if not spark.catalog.tableExists(name):
        base = silver.silver_base(star.bronze_trips(spark, folder))
        layout.write_fact(fact.fct_trips(base, *DOMAIN).hint("rebalance", "source_month"), name, *DOMAIN)
    return spark.table(name)


@query
def l01_fact_partitions(spark, folder):
    """Rows per month partition of the stored fact; a row outside the declared months would have failed the write."""
    return _stored_fact(spark, folder).groupBy(F.col(layout.FACT_PARTITION).alias("year_month")).agg(F.count("*").alias("trips"))


@query
def l05_pruned_count(spark, folder):
    """One month of the stored fact: the scan reads one partition."""
    return layout.pruned_count(_stored_fact(spark, folder), "1997-03-01", "1997-03-31")


@query
def l06_zone_lookup(spark, folder):
    """One zone of the stored, bucketed dimension."""
    name = Store.of(spark, folder).table("dim_zone_lookup")
    return layout.zone_lookup(layout.write_zone(dims.dim_zone(star.zone_lookup(spark, folder)), name), 13)


@query
def d11_column_rules(spark, folder):
    """Rows that break the rules of the fact, and stricter ones, so that some are broken."""
    trips = star.bronze_trips(spark, folder).withColumn("pickup_date_key", F.to_date("pickup_datetime"))
    stricter = {**GOLD_RULES["fct_trips"], "store_and_fwd_flag": Rule(required=True, length=1), "service_type": Rule(length=5),
                "passenger_count": Rule(required=True)}
    return violations(trips, stricter)


@query
def l02_zone_buckets(spark, folder):
    """The bucketed zone table, with its declared number of buckets."""
    name = Store.of(spark, folder).table("dim_zone")
    stored = layout.write_zone(dims.dim_zone(star.zone_lookup(spark, folder)), name)
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    return stored.withColumn("buckets", F.lit(int(about["Num Buckets"])))


@query
def l03_service_partitions(spark, folder):
    """Trips per partition of the service dimension."""
    store = Store.of(spark, folder)
    stored = layout.write_list(dims.dim_service_type(spark), store.table("dim_service_type"), "service_type", SERVICES)
    trips = star.bronze_trips(spark, folder).groupBy("service_type").agg(F.count("*").alias("trips"))
    return stored.join(trips, "service_type")


@query
def l04_payment_partitions(spark, folder):
    """Trips per partition of the payment dimension."""
    store = Store.of(spark, folder)
    stored = layout.write_list(dims.dim_payment_type(spark), store.table("dim_payment_type"), "payment_type", ("card", "cash", "other"))
    trips = star.bronze_trips(spark, folder).groupBy(F.col("payment_type").cast("int").alias("payment_type_id")).agg(F.count("*").alias("n"))
    return stored.join(trips, "payment_type_id").groupBy("payment_type").agg(F.sum("n").alias("trips"))


@query
def l07_empty_gate(spark, folder):
    """Rows behind the gate, and whether it stops an empty table."""
    orders = star.table(spark, folder, "orders")
    try:
        layout.assert_not_empty(orders.where("o_orderkey IS NULL"))
        stops = False
    except quality.QualityError:
        stops = True
    return layout.assert_not_empty(orders).groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.lit(stops).alias("stops"))


@query
def l08_build(spark, folder):
    """Rows of every published gold table after a whole build, and a second one that a test stops: its bronze has a trip to no zone."""
    store = Store.of(spark, folder)
    trips, zones, gold = store.table("build_trips"), store.table("build_zones"), f"{store.layer}_gold"
    ingest.replace_month(star.bronze_trips(spark, folder).hint("rebalance", "service_type", "source_month"), trips)
    tables.replace_table(star.zone_lookup(spark, folder), zones)
    build.build_all(spark, build.BuildConfig(trips, zones, gold, *DOMAIN))
    first, end = (F.lit(day).cast("timestamp_ntz") for day in DOMAIN)
    inside = (F.col("pickup_datetime") >= first) & (F.col("pickup_datetime") < end)
    # From the stored trips, by a scan that ends at the first row; stored, since it goes back into the same table.
    lost = store.staging.write(clean.clean_trips(spark.table(trips)).where(inside).limit(1), "lost")
    ingest.replace_month(lost.withColumns({"do_location_id": F.lit(-1), "source_month": F.lit("1994-12")}), trips)
    try:
        build.build_all(spark, build.BuildConfig(trips, zones, gold, *DOMAIN))
        stopped = False
    except quality.QualityError:
        stopped = True
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in published(spark, gold).items()]
    return reduce(DataFrame.unionAll, counts).withColumn("stopped", F.lit(stopped))


@query
def b02_number_columns(spark, folder):
    return passengers.select_number_columns(scan_passengers(spark, Store.of(spark, folder).passengers()))


@query
def b03b_median_of_keys_and_prices(spark, folder):
    """Columns with as many values as rows, in their own types."""
    orders = star.table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") + (1 << 53)).alias("key"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice").cast("decimal(12,2)")).alias("price"))
    return passengers.fill_missing_with_median(orders).groupBy("key").agg(F.count("*").alias("orders"), F.sum("price").alias("price"))


@query
def b04_clean_passengers(spark, folder):
    store = Store.of(spark, folder)
    path = store.path("clean_passengers", lambda target: passengers.clean_passengers(spark, store.passengers(), target))
    kinds = "Age double, Fare double, Parch int, Pclass int, SibSp int, Survived int"
    return spark.read.csv(path, header=True, schema=kinds, mode="FAILFAST")


@query
def d10_require(spark, folder):
    """Rows that pass the gate, and whether it stops an empty input."""
    lines = star.table(spark, folder, "lineitem")
    try:
        quality.require_rows(lines.where("l_orderkey IS NULL"), "none")
        stops = False
    except quality.QualityError:
        stops = True
    return quality.require_rows(lines, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("lines"), F.lit(stops).alias("stops"))


@query
def g02b_borough_codes(spark, folder):
    """Zones with real borough names, so that every code occurs."""
    names = {"AFRICA": "Manhattan", "AMERICA": "Brooklyn", "ASIA": "Queens", "EUROPE": "Bronx", "MIDDLE EAST": "Staten Island"}
    borough = F.when(F.col("LocationID") == 5, "EWR")
    for region, name in names.items():
        borough = borough.when(F.col("Borough") == region, name)
    zones = star.zone_lookup(spark, folder)
    return dims.dim_zone(zones.withColumn("Borough", borough))

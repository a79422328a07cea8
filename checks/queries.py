"""Registered queries: every operator of the package over the star-schema tables.

A query takes (spark, folder) and returns a DataFrame. ``plain`` makes results comparable across engines: decimals as
double, doubles with six decimals, dates and times as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from farelake import functions as fx
from farelake.operators import clean, quality
from farelake.operators.median import fill_missing_with_median
from farelake.operators.normalize import normalize_columns, union_months, with_lineage
from farelake.operators.surrogate import add_surrogate_key
from farelake.operators.upsert import upsert_by_key
from farelake.plans import analytics, dims, fact, ingest, layout, marts, passengers, silver, suite
from farelake.session import Staging
from farelake.sinks.tables import register_view
from farelake.sources import sql, star, trips as trip_files

# The tables hold orders of 1995 to 2001; the questions look at one year.
DOMAIN = ("1995-01-01", "2002-01-01")
YEAR = {"start": "1997-01-01", "end": "1998-01-01"}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    def column(name: str, kind: str):
        value = F.col(name)
        if kind.startswith("decimal"):
            return value.cast("double").alias(name)
        if kind == "double":
            return F.round(value, 6).alias(name)
        if kind in ("date", "timestamp_ntz"):
            return value.cast("string").alias(name)
        return value

    return df.select([column(name, kind) for name, kind in df.dtypes])


def query(function: Query) -> Query:
    """Register under the function's name."""
    REGISTRY[function.__name__] = lambda spark, folder: plain(function(spark, folder))
    return function


# -- inputs ----------------------------------------------------------------------------------------------------------

def _bronze(spark, folder, window=None):
    return star.bronze_trips(spark, folder, **(window or {}))


def _zones(spark, folder):
    return star.zone_lookup(spark, folder)


def _silver(spark, folder):
    bronze, zones = _bronze(spark, folder), _zones(spark, folder)
    yellow, green = silver.silver_yellow(bronze, zones), silver.silver_green(bronze, zones)
    return yellow, green, silver.silver_unified(yellow, green)


def _base(spark, folder, window=None):
    return silver.silver_base(_bronze(spark, folder, window))


def _fact(spark, folder, window=None):
    """The fact without its key; ``window`` is a filter that the caller's question puts on it anyway."""
    return fact.fct_trips(_base(spark, folder, window), *DOMAIN)


def _dim_zone(spark, folder):
    return dims.dim_zone(_zones(spark, folder))


def _daily(spark, folder):
    return marts.daily_revenue(_base(spark, folder))


# -- sources and sinks -----------------------------------------------------------------------------------------------

@query
def s08_sql_text(spark, folder):
    text = """SELECT service_type, COUNT(*) AS trips, MIN(pickup_date_key) AS min_date, MAX(pickup_date_key) AS max_date
              FROM {fct_trips} GROUP BY service_type"""
    return sql.run(spark, text, fct_trips=_fact(spark, folder))


@query
def s09_normalize_columns(spark, folder):
    trips = normalize_columns(star.raw_trips(spark, folder))
    names = [c for c in trips.columns if c not in ("service_type", "source_month")]
    return trips.groupBy("service_type", "source_month").agg(*[F.count(c).alias(c) for c in names])


@query
def s10_lineage(spark, folder):
    raw = star.raw_trips(spark, folder)
    tagged = with_lineage(raw.drop("service_type", "source_month"), "yellow", "2024-01")
    return tagged.groupBy("service_type", "source_month").agg(
        F.count("*").alias("row_count"), F.count_distinct("ingest_ts").alias("load_times"))


@query
def s12_union_months(spark, folder):
    raw = star.raw_trips(spark, folder)
    lineage = ("service_type", "source_month")
    yellow = raw.where(F.col("service_type") == "yellow").withColumn(
        "passenger_count", F.col("passenger_count").cast("long"))
    green = raw.where(F.col("service_type") == "green").drop("Airport_fee").withColumn("trip_type", F.lit(2.0))
    trips = union_months([yellow, green], keep=lineage)
    return trips.groupBy(*lineage).agg(
        F.count("*").alias("row_count"), F.sum("passenger_count").alias("passengers"),
        F.count("airport_fee").alias("with_airport_fee"), F.count("trip_type").alias("with_trip_type"))


@query
def s14_pending_months(spark, folder):
    bronze = _bronze(spark, folder)
    files = bronze.select("service_type", "source_month").distinct()
    loaded = ingest.loaded_months(bronze.where(F.col("source_month") < "1998-01"))
    return ingest.pending_months(files, loaded)


def _coverage(spark, folder):
    """All months of 1994 to 2002; every month with orders has a file; loads before 1997 have failed."""
    bronze = _bronze(spark, folder)
    grid = trip_files.month_grid(spark, range(1994, 2003), range(1, 13))
    loaded = ingest.loaded_months(bronze.where(F.col("source_month") >= "1997-01"))
    return ingest.coverage(grid, loaded, bronze.select("service_type", "source_month"))


@query
def s16_coverage(spark, folder):
    return ingest.coverage_listing(_coverage(spark, folder))


@query
def s16b_coverage_summary(spark, folder):
    return ingest.coverage_summary(_coverage(spark, folder))


@query
def s20_view(spark, folder):
    register_view(_silver(spark, folder)[2], "silver_trips_unified")
    return spark.table("silver_trips_unified").groupBy("service_type", "pickup_year").agg(
        F.count("*").alias("trips"), F.sum("total_amount").alias("total_revenue"))


@query
def s22_upsert(spark, folder):
    """Months from 1999 on are replaced by rows that gain a revenue column and lose the passengers column."""
    trips = _base(spark, folder)
    keys = ["service_type", "source_month"]
    target = trips.groupBy(*keys).agg(F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers"))
    batch = trips.where((F.col("source_month") >= "1999-01") & (F.col("fare_amount") > 0)).groupBy(*keys).agg(
        F.count("*").alias("trips"), F.sum("total_amount").alias("revenue"))
    return upsert_by_key(target, batch, keys)


# -- silver ----------------------------------------------------------------------------------------------------------

@query
def v01_clean_trips(spark, folder):
    return clean.clean_trips(_bronze(spark, folder)).drop("ingest_ts", "cbd_congestion_fee", "ehail_fee", "trip_type")


@query
def v02_duration(spark, folder):
    return _bronze(spark, folder).select("pickup_datetime", "dropoff_datetime", clean.trip_duration_minutes())


@query
def v03_defaults(spark, folder):
    filled = clean.apply_defaults(_bronze(spark, folder))
    return filled.groupBy("passenger_count", "ratecode_id", "store_and_fwd_flag", "payment_type", "trip_type").agg(
        F.count("*").alias("trips"), *[F.sum(c).alias(c) for c in ("extra", "congestion_surcharge", "airport_fee")])


@query
def v04_numeric_casts(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return lines.select(
        "l_quantity", fx.half_even_int(F.col("l_quantity") / 2).alias("half"),
        "l_extendedprice", fx.money(F.col("l_extendedprice") / 8).alias("eighth"))


@query
def v05_date_parts(spark, folder):
    events = star.table(spark, folder, "events")
    return events.select("event_id", *[v.alias(n) for n, v in fx.pickup_parts(F.col("ts")).items()])


@query
def v06_enrich_zones(spark, folder):
    """With a lookup that lacks the zones of one region, so that some trips stay unnamed."""
    zones = _zones(spark, folder).where(F.col("service_zone") != "Yellow Zone")
    named = clean.enrich_zones(_bronze(spark, folder), zones)
    names = [f"{side}_{c}" for side in ("pu", "do") for c in ("borough", "zone_name", "service_zone")]
    return named.groupBy(*names).agg(F.count("*").alias("trips"))


@query
def v07_silver_yellow(spark, folder):
    return _silver(spark, folder)[0].drop("ingest_ts")


@query
def v08_silver_green(spark, folder):
    return _silver(spark, folder)[1].drop("ingest_ts")


@query
def v09_silver_unified(spark, folder):
    return _silver(spark, folder)[2].drop("ingest_ts")


# -- gold ------------------------------------------------------------------------------------------------------------

def _daily_trips(spark, folder):
    return _fact(spark, folder).groupBy("pickup_date_key").agg(F.count("*").alias("trips"))


@query
def g01_dim_date(spark, folder):
    """The calendar of the fact's domain with the trips of each day."""
    calendar = dims.dim_date(spark, *DOMAIN)
    trips = _daily_trips(spark, folder)
    joined = calendar.join(trips, calendar["date_key"] == trips["pickup_date_key"], "left").drop("pickup_date_key")
    return joined.withColumn("trips", F.coalesce("trips", F.lit(0).cast("long")))


@query
def g02_dim_zone(spark, folder):
    return _dim_zone(spark, folder)


def _with_trips(dim, spark, folder, key, fact_key=None):
    """A dimension with the number of trips of each member."""
    trips = _fact(spark, folder).groupBy(F.col(fact_key or key).alias(key)).agg(F.count("*").alias("trips"))
    return dim.join(trips, key, "left")


@query
def g03_dim_service_type(spark, folder):
    return _with_trips(dims.dim_service_type(spark), spark, folder, "service_type")


@query
def g04_dim_payment_type(spark, folder):
    return _with_trips(dims.dim_payment_type(spark), spark, folder, "payment_type_id")


@query
def g05_dim_vendor(spark, folder):
    return _with_trips(dims.dim_vendor(spark), spark, folder, "vendor_id")


@query
def g06_dim_rate_code(spark, folder):
    return _with_trips(dims.dim_rate_code(spark), spark, folder, "rate_code_id", "ratecode_id")


@query
def g07_fct_trips(spark, folder):
    return _fact(spark, folder).drop("ingest_ts")


@query
def g08_surrogate_key(spark, folder):
    """The key with its order columns. Trips equal in all of them are interchangeable, so the result is determined."""
    columns = _fact(spark, folder).drop("ingest_ts")
    keyed = add_surrogate_key(columns, fact.KEY_ORDER, Staging(spark))
    return keyed.select("trip_key", *fact.KEY_ORDER)


@query
def g09_daily_revenue(spark, folder):
    return _daily(spark, folder)


@query
def g10_hourly_patterns(spark, folder):
    return marts.hourly_patterns(_base(spark, folder))


@query
def g11_monthly_summary(spark, folder):
    return marts.monthly_summary(_base(spark, folder))


@query
def g12_zone_analytics(spark, folder):
    return marts.zone_analytics(_base(spark, folder), _zones(spark, folder))


@query
def g13_processed_at(spark, folder):
    return marts.with_processed_at(_daily(spark, folder)).groupBy("service_type").agg(
        F.count("processed_at").alias("stamped"), F.count_distinct("processed_at").alias("stamps"))


# -- questions -------------------------------------------------------------------------------------------------------

def _question(function, zones=False, **options) -> Query:
    def run(spark, folder):
        window = {} if options.get("all_dates") else YEAR
        arguments = {k: v for k, v in options.items() if k != "all_dates"}
        inputs = [_fact(spark, folder, window)] + ([_dim_zone(spark, folder)] if zones else [])
        return function(*inputs, **arguments, **window)

    return run


_QUESTIONS: dict[str, Query] = {
    "q00_fact_bounds": lambda spark, folder: analytics.fact_bounds(_fact(spark, folder)),
    "q01_trips_per_month": _question(analytics.trips_per_month),
    "q02_trips_per_month_service": _question(analytics.trips_per_month_service, all_dates=True),
    "q02b_trips_per_month_service_in_year": _question(analytics.trips_per_month_service),
    "q03_top_pickup_zones": _question(analytics.top_zones, True, role="pu"),
    "q04_top_dropoff_zones": _question(analytics.top_zones, True, role="do"),
    "q05_top_boroughs_per_month": _question(analytics.top_boroughs_per_month, True),
    "q05b_top_known_boroughs_per_month": _question(analytics.top_boroughs_per_month, True, exclude="Unknown"),
    "q06_peak_hours": _question(analytics.peak_hours),
    "q07_trips_by_dow": _question(analytics.trips_by_dow),
    "q08_revenue_per_month": _question(analytics.revenue_per_month),
    "q09_revenue_per_month_service": _question(analytics.revenue_per_month_service),
    "q10_tip_pct_per_month": _question(analytics.tip_pct_per_month),
    "q11_tip_pct_by_borough": _question(analytics.tip_pct_by_borough, True),
    "q12_top_zones_by_revenue": _question(analytics.top_zones_by_revenue, True),
    "q13_top_zones_by_tip": _question(analytics.top_zones_by_tip, True, min_trips=20),
    "q14_cash_vs_card": lambda spark, folder: analytics.cash_vs_card(
        _fact(spark, folder, YEAR), dims.dim_payment_type(spark), **YEAR),
    "q15_avg_duration_per_month": _question(analytics.avg_duration_per_month),
    "q16_avg_distance_per_month": _question(analytics.avg_distance_per_month),
    "q17_speed_by_borough_band": _question(analytics.speed_by_borough_band, True),
    "q18_duration_percentiles": _question(analytics.duration_percentiles, True),
    "q19_top_zones_by_p90": _question(analytics.top_zones_by_p90, True),
    "q20_top_routes": _question(analytics.top_routes, True),
}
for _name, _run in _QUESTIONS.items():
    REGISTRY[_name] = lambda spark, folder, run=_run: plain(run(spark, folder))


# -- small flows -----------------------------------------------------------------------------------------------------

@query
def b01_multi_passenger_trips(spark, folder):
    raw = star.raw_trips(spark, folder)
    text = {c: F.col(c).cast("string") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    return passengers.multi_passenger_trips(raw.withColumns(text)).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_minutes", "passenger_count", "total_amount")


@query
def b03_fill_with_median(spark, folder):
    columns = ["passenger_count", "payment_type", "ratecode_id", "extra"]
    filled = fill_missing_with_median(_bronze(spark, folder).select(*columns))
    return filled.groupBy(*columns).agg(F.count("*").alias("trips"))


# -- data tests ------------------------------------------------------------------------------------------------------

@query
def d01_not_null(spark, folder):
    return quality.not_null(_bronze(spark, folder), "passenger_count").select(
        "vendor_id", "pickup_datetime", "service_type", "total_amount")


@query
def d02_unique(spark, folder):
    return quality.unique(star.table(spark, folder, "lineitem"), "l_orderkey")


@query
def d03_accepted_values(spark, folder):
    return quality.accepted_values(_bronze(spark, folder), "payment_type", [1, 2])


@query
def d04_relationships(spark, folder):
    return quality.relationships(_bronze(spark, folder), "pu_location_id",
                                 _zones(spark, folder).where(F.col("service_zone") != "Yellow Zone"), "LocationID"
                                 ).groupBy("pu_location_id").agg(F.count("*").alias("trips"))


@query
def d04b_orphan_values(spark, folder):
    return quality.orphan_values(_bronze(spark, folder), "vendor_id",
                                 dims.dim_vendor(spark).where(F.col("vendor_id") > 0), "vendor_id")


@query
def d05_temporal_and_non_negative(spark, folder):
    return quality.temporal_and_non_negative(_bronze(spark, folder)).select(
        "pickup_datetime", "dropoff_datetime", "trip_distance", "total_amount", "service_type")


@query
def d06_revenue_not_negative(spark, folder):
    """Over the refunds of the raw trips, which the cleaned marts do not contain."""
    refunds = _bronze(spark, folder).where(F.col("total_amount") < 0)
    daily = refunds.groupBy(F.to_date("pickup_datetime").alias("pickup_date"), "service_type").agg(
        F.sum(fx.money(F.col("total_amount"))).alias("total_revenue"))
    return quality.negative_revenue(daily)


@query
def d07_count_consistent(spark, folder):
    """The cleaned parts against the uncleaned whole, so that there is a difference to report."""
    yellow, green, _ = _silver(spark, folder)
    return quality.count_mismatch(_bronze(spark, folder), [yellow, green])


@query
def d08_valid_hours(spark, folder):
    """Hours shifted by half a day, so that some leave the valid range."""
    hourly = marts.hourly_patterns(_base(spark, folder))
    return quality.invalid_hours(hourly.withColumn("pickup_hour", F.col("pickup_hour") + 12))


@query
def d09_suite(spark, folder):
    """All 44 tests over the layers built from the tables, on the fact with its real key.

    As in a build, bronze, the fact and the cube of the marts are written once and the tests read the written tables.
    """
    staging = Staging(spark)
    bronze, zones = staging.write(_bronze(spark, folder), "bronze"), _zones(spark, folder)
    yellow, green = silver.silver_yellow(bronze, zones), silver.silver_green(bronze, zones)
    base = silver.silver_base(bronze)
    cube = staging.write(marts.trip_cube(silver.silver_base(bronze, fx.money_of_double)), "cube")
    facts = fact.keyed_fact(fact.fct_trips(base, *DOMAIN), staging, replayable=True)
    return suite.suite_results({
        "silver_yellow_trips": yellow, "silver_green_trips": green,
        "silver_trips_unified": base,
        "taxi_zone_lookup": zones, "fct_trips": staging.write(facts, "fact"), "dim_zone": dims.dim_zone(zones),
        "dim_date": dims.dim_date(spark, *DOMAIN), "dim_service_type": dims.dim_service_type(spark),
        "dim_payment_type": dims.dim_payment_type(spark), "gold_daily_revenue": marts.daily_from_cube(cube),
        "gold_hourly_patterns": marts.hourly_from_cube(cube),
    })


@query
def d09b_optional_keys(spark, folder):
    """Opt-in relationship tests of the fact's payment, vendor and rate keys."""
    return suite.suite_results({
        "fct_trips": _fact(spark, folder), "dim_payment_type": dims.dim_payment_type(spark).where(
            F.col("payment_type") != "other"),
        "dim_vendor": dims.dim_vendor(spark), "dim_rate_code": dims.dim_rate_code(spark),
    }, suite.OPTIONAL)


# -- scalar functions ------------------------------------------------------------------------------------------------

@query
def f02_guarded_ratio(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    share = fx.ratio(F.col("l_discount"), F.col("l_tax"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.avg(share).alias("mean_ratio"), F.count(share).alias("with_ratio"), F.count("*").alias("lines"))


@query
def f04_rounding(spark, folder):
    price = F.col("o_totalprice")
    return star.table(spark, folder, "orders").select(
        "o_orderkey", fx.rounded(price / 8, 2).alias("two"), fx.rounded(price / 3, 0).alias("whole"))


@query
def f08_calendar_text(spark, folder):
    """Truncation, month names and first-of-month dates of the order dates."""
    date = F.to_date("o_orderdate")
    return star.table(spark, folder, "orders").select(
        "o_orderkey", fx.month_start(date).alias("month"), fx.year_month(date).alias("year_month"),
        fx.month_name(date).alias("month_name"),
        fx.first_of_month_text(date).alias("first_text"),
        F.make_date(F.year(date), F.month(date), F.lit(1)).alias("first_date"))


@query
def f11_bands(spark, folder):
    hour, dow = F.hour("ts"), fx.day_of_week(F.col("ts"))
    return star.table(spark, folder, "events").groupBy(
        hour.alias("hour"), fx.time_period(hour).alias("time_period"), fx.day_band(hour).alias("day_band"),
        fx.day_type(dow).alias("day_type"), fx.day_name(dow).alias("day_name"),
    ).agg(F.count("*").alias("events"))


@query
def f12_date_series(spark, folder):
    """One row per day between the first and the last event."""
    bounds = star.table(spark, folder, "events").agg(
        F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date_key"))


@query
def f14_parse_datetimes(spark, folder):
    events = star.table(spark, folder, "events").select("event_id", F.col("ts").cast("string").alias("text"))
    parsed = F.col("text").cast("timestamp_ntz")
    midnight = F.to_date(parsed).cast("timestamp_ntz")
    return events.select("event_id", fx.rounded(fx.minutes_between(midnight, parsed)).alias("minutes"))


@query
def f16_percentages(spark, folder):
    orders = star.table(spark, folder, "orders")
    return orders.groupBy("o_orderpriority").agg(
        fx.percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("finished_percentage"),
        F.count("*").alias("orders"))


from . import stored  # noqa: E402,F401 - registers its queries here

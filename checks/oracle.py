"""The same results in DuckDB SQL over the same parquet tables."""

from __future__ import annotations

# Fixed values, written out here so that the package's own constants are compared with something.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONEY_COLUMNS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
                 "airport_fee", "total_amount")
DEFAULTS = {"passenger_count": 1, "ratecode_id": 1, "store_and_fwd_flag": "N", "payment_type": 5, "trip_type": 1,
            **{name: 0 for name in MONEY_COLUMNS}}
BOROUGH_CASE = ("CASE {b} WHEN 'Manhattan' THEN 1 WHEN 'Brooklyn' THEN 2 WHEN 'Queens' THEN 3 WHEN 'Bronx' THEN 4"
                " WHEN 'Staten Island' THEN 5 WHEN 'EWR' THEN 6 ELSE 7 END")
SERVICE_ROWS = (("yellow", "Yellow Taxi", "Medallion taxis that can pick up passengers anywhere in NYC"),
                ("green", "Green Taxi", "Boro taxis that primarily serve outer boroughs"))
PAYMENT_ROWS = ((1, "card", "Credit Card", "Payment made via credit card"), (2, "cash", "Cash", "Payment made in cash"),
                (3, "other", "No Charge", "No charge for the trip"), (4, "other", "Dispute", "Disputed transaction"),
                (5, "other", "Unknown", "Unknown payment method"), (6, "other", "Voided Trip", "Trip was voided"))
VENDOR_ROWS = ((0, "Unknown", "Unknown vendor"), (1, "Creative Mobile Technologies", "CMT - Technology provider for taxi meters"),
               (2, "VeriFone Inc", "VTS - Technology provider for taxi meters"))
RATE_ROWS = ((1, "Standard Rate", "Standard metered fare"), (2, "JFK", "JFK Airport flat fare"), (3, "Newark", "Newark Airport"),
             (4, "Nassau/Westchester", "Trips to Nassau or Westchester"),
             (5, "Negotiated Fare", "Negotiated fare between driver and passenger"), (6, "Group Ride", "Group ride shared fare"))

FROM, TO = "1995-01-01", "2002-01-01"
IN_YEAR = "pickup_date_key >= DATE '1997-01-01' AND pickup_date_key < DATE '1998-01-01'"


def r2(value: str, scale: int = 2) -> str:
    """Round half away from zero on the decimal value."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def r6(value: str) -> str:
    return f"ROUND({value}, 6)"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def values(rows, columns: str, name: str) -> str:
    body = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS {name}({columns})"


def day_name(dow: str) -> str:
    return f"CASE {dow} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(DAY_NAMES)) + " END"


def money(name: str) -> str:
    return f"CAST(COALESCE({name}, 0) AS DECIMAL(10,2))"


TIME_PERIOD = """CASE WHEN {h} BETWEEN 6 AND 9 THEN 'Morning Rush' WHEN {h} BETWEEN 10 AND 15 THEN 'Midday'
  WHEN {h} BETWEEN 16 AND 19 THEN 'Evening Rush' WHEN {h} BETWEEN 20 AND 23 THEN 'Night' ELSE 'Late Night' END"""
DAY_BAND = """CASE WHEN {h} BETWEEN 6 AND 11 THEN 'morning' WHEN {h} BETWEEN 12 AND 17 THEN 'afternoon'
  WHEN {h} BETWEEN 18 AND 23 THEN 'evening' ELSE 'night' END"""
DAY_TYPE = "CASE WHEN {d} IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"

# Bronze columns that the queries return for whole trips.
BRONZE_OUT = ("vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "ratecode_id",
              "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type", *MONEY_COLUMNS,
              "service_type", "source_month")

CTES = {
    "bronze": """
SELECT CAST(l_suppkey % 3 AS INT) AS vendor_id,
  o_orderdate + to_hours(CAST(l_partkey % 24 AS INT)) AS pickup_datetime,
  l_shipdate + to_hours(CAST(l_suppkey % 24 AS INT)) AS dropoff_datetime,
  CAST(NULLIF(l_linenumber, 7) AS DOUBLE) AS passenger_count, l_quantity AS trip_distance,
  CAST(NULLIF(l_partkey % 7, 0) AS DOUBLE) AS ratecode_id,
  CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS store_and_fwd_flag,
  c_nationkey AS pu_location_id, s_nationkey AS do_location_id,
  CAST(NULLIF(CAST(SUBSTR(o_orderpriority, 1, 1) AS INT), 5) AS DOUBLE) AS payment_type,
  l_extendedprice AS fare_amount, NULLIF(l_tax, 0) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS DOUBLE)
    AS tip_amount,
  l_tax * 10 AS tolls_amount, CAST(1.0 AS DOUBLE) AS improvement_surcharge,
  CASE WHEN l_linenumber < 4 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
  CASE WHEN l_linestatus = 'O' THEN CAST(1.25 AS DOUBLE) END AS airport_fee,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS total_amount,
  CASE l_linestatus WHEN 'O' THEN 'yellow' ELSE 'green' END AS service_type,
  strftime(o_orderdate, '%Y-%m') AS source_month
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "zones": """
SELECT n_nationkey AS LocationID,
  CASE WHEN n_nationkey = 24 THEN 'Unknown' WHEN n_nationkey = 23 THEN NULL ELSE r_name END AS Borough,
  n_name AS Zone, CASE r_name WHEN 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "clean": """
SELECT * FROM bronze WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
  AND pickup_datetime <= dropoff_datetime AND trip_distance >= 0 AND total_amount >= 0
  AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL""",
    "silver": f"""
SELECT vendor_id, pickup_datetime, dropoff_datetime,
  date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7 AS trip_duration_minutes,
  CAST(COALESCE(passenger_count, 1) AS INTEGER) AS passenger_count, trip_distance,
  CAST(COALESCE(ratecode_id, 1) AS INTEGER) AS ratecode_id, COALESCE(store_and_fwd_flag, 'N') AS store_and_fwd_flag,
  pu_location_id, do_location_id,
  p.Borough AS pu_borough, p.Zone AS pu_zone_name, p.service_zone AS pu_service_zone,
  q.Borough AS do_borough, q.Zone AS do_zone_name, q.service_zone AS do_service_zone,
  CAST(COALESCE(payment_type, 5) AS INTEGER) AS payment_type,
  CASE WHEN service_type = 'green' THEN 1 END AS trip_type,
  {", ".join(f"{money(m)} AS {m}" for m in MONEY_COLUMNS if m != "airport_fee")},
  CASE WHEN service_type = 'yellow' THEN {money("airport_fee")} ELSE CAST(0 AS DECIMAL(10,2)) END AS airport_fee,
  service_type, source_month, CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year, CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(dayofweek(pickup_datetime) AS INTEGER) AS pickup_day_of_week, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour
FROM clean LEFT JOIN zones p ON pu_location_id = p.LocationID LEFT JOIN zones q ON do_location_id = q.LocationID""",
    "fact": f"""
SELECT pickup_date AS pickup_date_key, pu_location_id AS pu_zone_key, do_location_id AS do_zone_key, service_type,
  payment_type AS payment_type_id, COALESCE(vendor_id, 0) AS vendor_id, pickup_datetime, dropoff_datetime, pickup_hour,
  pickup_day_of_week, passenger_count, CAST(trip_distance AS DECIMAL(10,2)) AS trip_distance,
  CAST(trip_duration_minutes AS DECIMAL(10,2)) AS trip_duration_minutes, {", ".join(MONEY_COLUMNS)}, ratecode_id,
  store_and_fwd_flag, source_month
FROM silver WHERE pickup_date >= DATE '{FROM}' AND pickup_date < DATE '{TO}'""",
    "year_fact": f"SELECT * FROM fact WHERE {IN_YEAR}",
    "dim_zone": "SELECT LocationID AS zone_key, Borough AS borough, Zone AS zone_name, service_zone,"
                f" {BOROUGH_CASE.format(b='Borough')} AS borough_code FROM zones",
    "dim_service_type": values(SERVICE_ROWS, "service_type, service_name, service_description", "t"),
    "dim_payment_type": values(
        PAYMENT_ROWS, "payment_type_id, payment_type, payment_type_name, payment_type_description", "t"),
    "dim_vendor": values(VENDOR_ROWS, "vendor_id, vendor_name, vendor_description", "t"),
    "dim_rate_code": values(RATE_ROWS, "rate_code_id, rate_code_name, rate_code_description", "t"),
    "grid": """
SELECT strftime(make_date(CAST(y AS INT), CAST(m AS INT), 1), '%Y-%m') AS source_month, s AS service_type
FROM range(1994, 2003) a(y), range(1, 13) b(m), (VALUES ('yellow'), ('green')) c(s)""",
    "covered": """
SELECT g.source_month AS year_month, g.service_type,
  CASE WHEN COALESCE(n, 0) > 0 THEN 'loaded' WHEN f.service_type IS NOT NULL THEN 'failed' ELSE 'missing' END AS status,
  COALESCE(n, 0) AS row_count
FROM grid g
LEFT JOIN (SELECT service_type, source_month, COUNT(*) AS n FROM bronze WHERE source_month >= '1997-01'
           GROUP BY 1, 2) l ON g.source_month = l.source_month AND g.service_type = l.service_type
LEFT JOIN (SELECT DISTINCT service_type, source_month FROM bronze) f
  ON g.source_month = f.source_month AND g.service_type = f.service_type""",
    "trip_ends": """
SELECT LocationID AS location_id, Borough AS borough, Zone AS zone_name, begins, pickup_year, pickup_month, service_type, total_amount
FROM (SELECT *, pu_location_id AS place, true AS begins FROM silver UNION ALL SELECT *, do_location_id, false FROM silver)
JOIN zones ON place = LocationID WHERE Borough IS NOT NULL""",
    "daily": f"""
SELECT pickup_date, pickup_year, pickup_month, pickup_day_of_week, {day_name("pickup_day_of_week")} AS day_name,
  service_type, COUNT(*) AS total_trips, CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
  {r2("SUM(trip_distance)")} AS total_distance_miles, {r2("AVG(trip_distance)")} AS avg_distance_miles,
  {r2("AVG(trip_duration_minutes)")} AS avg_duration_minutes, {dbl("SUM(fare_amount)")} AS total_fare,
  {dbl("SUM(tip_amount)")} AS total_tips, {dbl("SUM(tolls_amount)")} AS total_tolls,
  {dbl("SUM(total_amount)")} AS total_revenue,
  {r2("CAST(SUM(total_amount) AS DOUBLE) / COUNT(*)")} AS avg_revenue_per_trip,
  {r2("AVG(CAST(tip_amount AS DOUBLE) / NULLIF(CAST(fare_amount AS DOUBLE), 0)) * 100")} AS avg_tip_percentage,
  COUNT(CASE WHEN tip_amount > 0 THEN 1 END) AS trips_with_tips,
  COUNT(CASE WHEN payment_type = 1 THEN 1 END) AS credit_card_trips,
  COUNT(CASE WHEN payment_type = 2 THEN 1 END) AS cash_trips,
  {r2("COUNT(CASE WHEN payment_type = 1 THEN 1 END) * 100.0::DOUBLE / COUNT(*)")} AS credit_card_percentage
FROM silver GROUP BY pickup_date, pickup_year, pickup_month, pickup_day_of_week, service_type""",
    "hourly": f"""
SELECT pickup_year, pickup_month, pickup_hour, pickup_day_of_week, {day_name("pickup_day_of_week")} AS day_name,
  {DAY_TYPE.format(d="pickup_day_of_week")} AS day_type, {TIME_PERIOD.format(h="pickup_hour")} AS time_period,
  service_type, COUNT(*) AS total_trips, {r2("AVG(trip_duration_minutes)")} AS avg_duration_minutes,
  {r2("AVG(trip_distance)")} AS avg_distance_miles,
  {r2("CAST(SUM(total_amount) AS DOUBLE) / COUNT(*)")} AS avg_revenue, {dbl("SUM(total_amount)")} AS total_revenue
FROM silver GROUP BY pickup_year, pickup_month, pickup_hour, pickup_day_of_week, service_type""",
}
NEEDS = {
    "clean": ["bronze"], "silver": ["clean", "zones"], "fact": ["silver"], "year_fact": ["fact"],
    "dim_zone": ["zones"], "covered": ["grid", "bronze"], "daily": ["silver"], "hourly": ["silver"],
    "trip_ends": ["silver"],
}


def sql(body: str, *ctes: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in ctes:
        add(name)
    head = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in order)
    return (f"WITH {head}\n" if order else "") + body


MONTH = "CAST(CAST(date_trunc('month', pickup_date_key) AS DATE) AS VARCHAR) AS month"
RATIO = "CAST(tip_amount AS DOUBLE) / NULLIF(CAST(fare_amount AS DOUBLE), 0)"
PU_ZONE = "year_fact f JOIN dim_zone z ON f.pu_zone_key = z.zone_key"

_PLAIN_TYPES = {"pickup_datetime": text, "dropoff_datetime": text, "pickup_date": text, "pickup_date_key": text,
                "trip_duration_minutes": r6, "tolls_amount": r6}


def columns(names, *, decimals=()) -> str:
    out = []
    for name in names:
        if name in decimals:
            out.append(f"{dbl(name)} AS {name}")
        elif name in _PLAIN_TYPES:
            out.append(f"{_PLAIN_TYPES[name](name)} AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


_SILVER_KEYS = ("vendor_id", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "passenger_count",
                "trip_distance", "ratecode_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "pu_borough",
                "pu_zone_name", "do_borough", "do_zone_name", "payment_type", "service_type", "source_month",
                "pickup_date", "pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour")


def _silver(*names: str) -> str:
    return columns([*_SILVER_KEYS, *names], decimals=MONEY_COLUMNS)


def _top_zones(role: str) -> str:
    return sql(f"""SELECT z.zone_name, z.borough, COUNT(*) AS trips
FROM year_fact f JOIN dim_zone z ON f.{role}_zone_key = z.zone_key GROUP BY 1, 2
ORDER BY trips DESC, z.zone_name NULLS LAST, z.borough NULLS LAST LIMIT 10""", "year_fact", "dim_zone")


def _top_boroughs(condition: str) -> str:
    return sql(f"""SELECT month, borough, trips FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY trips DESC, borough NULLS LAST) AS rn
  FROM (SELECT {MONTH}, z.borough, COUNT(*) AS trips FROM {PU_ZONE} {condition} GROUP BY 1, 2)) WHERE rn <= 5""",
               "year_fact", "dim_zone")


def _dimension(name: str, key: str, fact_key: str | None = None) -> str:
    return sql(f"SELECT t.*, trips FROM {name} t LEFT JOIN (SELECT {fact_key or key} AS k, COUNT(*) AS trips FROM fact"
               f" GROUP BY 1) ON {key} = k", name, "fact")


def _median(name: str) -> str:
    return (f"(SELECT {name} FROM bronze WHERE {name} IS NOT NULL ORDER BY {name}"
            f" LIMIT 1 OFFSET (SELECT COUNT({name}) // 2 FROM bronze))")


def _suite() -> str:
    """(test, failures) of the 44 tests."""
    tests: list[tuple[str, str]] = []
    silver = {
        "silver_yellow_trips": ("silver WHERE service_type = 'yellow'", ["yellow"]),
        "silver_green_trips": ("silver WHERE service_type = 'green'", ["green"]),
    }
    for name, (source, services) in silver.items():
        for column in ("pickup_datetime", "dropoff_datetime", "trip_distance", "pu_location_id", "do_location_id"):
            tests.append((f"not_null_{name}_{column}", f"SELECT COUNT(*) FROM {source} AND {column} IS NULL"))
        for column in ("pu_location_id", "do_location_id"):
            tests.append((f"relationships_{name}_{column}",
                          f"SELECT COUNT(*) FROM {source} AND {column} IS NOT NULL AND {column} NOT IN"
                          f" (SELECT LocationID FROM zones)"))
        tests.append((f"accepted_values_{name}_service_type",
                      f"SELECT COUNT(DISTINCT service_type) FROM {source} AND service_type NOT IN ('{services[0]}')"))
    both = "('yellow', 'green')"
    for table, column in (("silver", "pickup_datetime"), ("silver", "service_type"), ("fact", "pickup_date_key"),
                          ("fact", "pu_zone_key"), ("fact", "do_zone_key"), ("fact", "service_type"),
                          ("dim_zone", "zone_key"), ("dim_service_type", "service_type"),
                          ("dim_payment_type", "payment_type_id"), ("dim_payment_type", "payment_type")):
        name = {"silver": "silver_trips_unified", "fact": "fct_trips"}.get(table, table)
        tests.append((f"not_null_{name}_{column}", f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL"))
    for table, column in (("dim_zone", "zone_key"), ("dim_service_type", "service_type"),
                          ("dim_payment_type", "payment_type_id")):
        tests.append((f"unique_{table}_{column}", f"SELECT COUNT(*) FROM (SELECT {column} FROM {table} WHERE {column}"
                                                  f" IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"))
    for table, column, allowed in (("silver", "service_type", both), ("fact", "service_type", both),
                                   ("dim_service_type", "service_type", both),
                                   ("dim_payment_type", "payment_type", "('card', 'cash', 'other')")):
        name = {"silver": "silver_trips_unified", "fact": "fct_trips"}.get(table, table)
        tests.append((f"accepted_values_{name}_{column}",
                      f"SELECT COUNT(DISTINCT {column}) FROM {table} WHERE {column} NOT IN {allowed}"))
    for column in ("pu_zone_key", "do_zone_key"):
        tests.append((f"relationships_fct_trips_{column}",
                      f"SELECT COUNT(*) FROM fact WHERE {column} NOT IN (SELECT zone_key FROM dim_zone)"))
    tests += [
        ("relationships_fct_trips_pickup_date_key",
         f"SELECT COUNT(*) FROM fact WHERE pickup_date_key < DATE '{FROM}' OR pickup_date_key >= DATE '{TO}'"),
        # The key and the calendar are made without NULLs and repeats.
        ("not_null_fct_trips_trip_key", "SELECT 0"), ("unique_fct_trips_trip_key", "SELECT 0"),
        ("not_null_dim_date_date_key", "SELECT 0"), ("unique_dim_date_date_key", "SELECT 0"),
        ("rule_trips_in_order_and_not_negative",
         "SELECT COUNT(*) FROM silver WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL"
         " OR pickup_datetime > dropoff_datetime OR trip_distance < 0 OR total_amount < 0"),
        ("rule_daily_revenue_not_negative", "SELECT COUNT(*) FROM daily WHERE total_revenue < 0"),
        ("rule_unified_count_equals_parts",
         "SELECT COUNT(*) FROM (SELECT COUNT(*) AS n, COUNT(CASE WHEN service_type IN ('yellow', 'green') THEN 1 END)"
         " AS m FROM silver) WHERE n <> m"),
        ("rule_pickup_hours_valid",
         "SELECT COUNT(DISTINCT pickup_hour) FROM hourly WHERE pickup_hour < 0 OR pickup_hour > 23"),
    ]
    union = "\nUNION ALL ".join(f"SELECT '{name}' AS test, ({query}) AS failures" for name, query in tests)
    return sql(f"SELECT test, CAST(failures AS BIGINT) AS failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END"
               f" AS status FROM ({union})", "silver", "fact", "dim_zone", "dim_service_type", "dim_payment_type",
               "daily", "hourly")


_DEFAULTED = ("passenger_count", "ratecode_id", "store_and_fwd_flag", "payment_type")

ORACLE: dict[str, str] = {
    "s08_sql_text": sql(f"""SELECT service_type, COUNT(*) AS trips, {text("MIN(pickup_date_key)")} AS min_date,
  {text("MAX(pickup_date_key)")} AS max_date FROM fact GROUP BY 1""", "fact"),
    "s09_normalize_columns": sql(
        "SELECT service_type, source_month, "
        + ", ".join(f"COUNT({c}) AS {c}" for c in BRONZE_OUT if c not in ("service_type", "source_month"))
        + " FROM bronze GROUP BY 1, 2", "bronze"),
    "s10_lineage": sql("SELECT 'yellow' AS service_type, '2024-01' AS source_month, COUNT(*) AS row_count,"
                       " CAST(1 AS BIGINT) AS load_times FROM bronze", "bronze"),
    "s12_union_months": sql("""SELECT service_type, source_month, COUNT(*) AS row_count,
  SUM(passenger_count) AS passengers, COUNT(CASE WHEN service_type = 'yellow' THEN airport_fee END) AS with_airport_fee,
  COUNT(CASE WHEN service_type = 'green' THEN 1 END) AS with_trip_type FROM bronze GROUP BY 1, 2""", "bronze"),
    "s14_pending_months": sql(
        "SELECT DISTINCT service_type, source_month FROM bronze WHERE source_month >= '1998-01'", "bronze"),
    "s16_coverage": sql("SELECT * FROM covered ORDER BY year_month, service_type", "covered"),
    "s16b_coverage_summary": sql("SELECT status, COUNT(*) AS months FROM covered GROUP BY 1", "covered"),
    "s20_view": sql(f"""SELECT service_type, pickup_year, COUNT(*) AS trips, {dbl("SUM(total_amount)")} AS total_revenue
FROM silver GROUP BY 1, 2""", "silver"),
    "s22_upsert": sql(f"""SELECT service_type, source_month, COUNT(*) AS trips, CAST(NULL AS DOUBLE) AS revenue
FROM silver WHERE source_month < '1999-01' GROUP BY 1, 2
UNION ALL SELECT service_type, source_month, COUNT(*), {dbl("SUM(total_amount)")}
FROM silver WHERE source_month >= '1999-01' AND fare_amount > 0 GROUP BY 1, 2""", "silver"),
    "l01_fact_partitions": sql(
        "SELECT strftime(pickup_date_key, '%Y-%m') AS year_month, COUNT(*) AS trips FROM fact GROUP BY 1", "fact"),
    "l05_pruned_count": sql("SELECT COUNT(*) AS trips FROM fact WHERE pickup_date_key BETWEEN DATE '1997-03-01'"
                            " AND DATE '1997-03-31'", "fact"),
    "l06_zone_lookup": sql("SELECT * FROM dim_zone WHERE zone_key = 13", "dim_zone"),
    "v01_clean_trips": sql(f"SELECT {columns(BRONZE_OUT)} FROM clean", "clean"),
    "v02_duration": sql(f"""SELECT {text("pickup_datetime")} AS pickup_datetime,
  {text("dropoff_datetime")} AS dropoff_datetime,
  {r6("date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7")} AS trip_duration_minutes
FROM bronze""", "bronze"),
    "v03_defaults": sql(
        "SELECT " + ", ".join(
            f"COALESCE({c}, {repr(DEFAULTS[c])}) AS {c}" for c in _DEFAULTED)
        + ", CAST(1 AS DOUBLE) AS trip_type, COUNT(*) AS trips, "
        + ", ".join(f"{r6(f'SUM(COALESCE({c}, 0))')} AS {c}" for c in ("extra", "congestion_surcharge", "airport_fee"))
        + " FROM bronze GROUP BY 1, 2, 3, 4", "bronze"),
    "v04_numeric_casts": """SELECT l_quantity, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half, l_extendedprice,
  CAST(ROUND(CAST(l_extendedprice / 8 AS DECIMAL(20,6)), 2) AS DOUBLE) AS eighth FROM lineitem""",
    "v05_date_parts": f"""SELECT event_id, {text("CAST(ts AS DATE)")} AS pickup_date, CAST(year(ts) AS INTEGER) AS pickup_year,
  CAST(month(ts) AS INTEGER) AS pickup_month, CAST(dayofweek(ts) AS INTEGER) AS pickup_day_of_week, CAST(hour(ts) AS INTEGER) AS pickup_hour FROM events""",
    "v06_enrich_zones": sql("""SELECT p.Borough AS pu_borough, p.Zone AS pu_zone_name, p.service_zone AS pu_service_zone,
  q.Borough AS do_borough, q.Zone AS do_zone_name, q.service_zone AS do_service_zone, COUNT(*) AS trips
FROM bronze LEFT JOIN (SELECT * FROM zones WHERE service_zone <> 'Yellow Zone') p ON pu_location_id = p.LocationID
LEFT JOIN (SELECT * FROM zones WHERE service_zone <> 'Yellow Zone') q ON do_location_id = q.LocationID
GROUP BY 1, 2, 3, 4, 5, 6""", "bronze", "zones"),
    "v07_silver_yellow": sql(
        f"SELECT {_silver(*MONEY_COLUMNS, 'pu_service_zone', 'do_service_zone')} FROM silver"
        " WHERE service_type = 'yellow'", "silver"),
    "v08_silver_green": sql(
        f"SELECT {_silver(*[m for m in MONEY_COLUMNS if m != 'airport_fee'], 'trip_type', 'pu_service_zone', 'do_service_zone')}"
        " FROM silver WHERE service_type = 'green'", "silver"),
    "v09_silver_unified": sql(f"SELECT {_silver(*MONEY_COLUMNS, 'trip_type')} FROM silver", "silver"),
    "g01_dim_date": sql(f"""SELECT {text("date_key")} AS date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
  CAST(day(date_key) AS INTEGER) AS day, CAST(dayofweek(date_key) AS INTEGER) AS day_of_week, CAST(dayofyear(date_key) AS INTEGER) AS day_of_year,
  CAST(weekofyear(date_key) AS INTEGER) AS week_of_year, CAST(quarter(date_key) AS INTEGER) AS quarter, {day_name("dayofweek(date_key)")} AS day_name,
  rpad(strftime(date_key, '%B'), 9, ' ') AS month_name, dayofweek(date_key) IN (0, 6) AS is_weekend,
  strftime(date_key, '%Y-%m') AS year_month, COALESCE(n, 0) AS trips
FROM (SELECT CAST(unnest(generate_series(DATE '{FROM}', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS date_key)
LEFT JOIN (SELECT pickup_date_key, COUNT(*) AS n FROM fact GROUP BY 1) ON date_key = pickup_date_key""", "fact"),
    "g02_dim_zone": sql("SELECT * FROM dim_zone", "dim_zone"),
    "g03_dim_service_type": _dimension("dim_service_type", "service_type"),
    "g04_dim_payment_type": _dimension("dim_payment_type", "payment_type_id"),
    "g05_dim_vendor": _dimension("dim_vendor", "vendor_id"),
    "g06_dim_rate_code": _dimension("dim_rate_code", "rate_code_id", "ratecode_id"),
    "g07_fct_trips": sql("SELECT " + columns(
        ["pickup_date_key", "pu_zone_key", "do_zone_key", "service_type", "payment_type_id", "vendor_id",
         "pickup_datetime", "dropoff_datetime", "pickup_hour", "pickup_day_of_week", "passenger_count", "trip_distance",
         "trip_duration_minutes", *MONEY_COLUMNS, "ratecode_id", "store_and_fwd_flag", "source_month"],
        decimals=(*MONEY_COLUMNS, "trip_distance", "trip_duration_minutes")) + " FROM fact", "fact"),
    "g08_surrogate_key": sql(f"""SELECT ROW_NUMBER() OVER (ORDER BY pickup_datetime, service_type, pu_zone_key)
  AS trip_key, {text("pickup_datetime")} AS pickup_datetime, service_type, pu_zone_key FROM fact""", "fact"),
    "g09_daily_revenue": sql("SELECT * REPLACE (CAST(pickup_date AS VARCHAR) AS pickup_date) FROM daily", "daily"),
    "g10_hourly_patterns": sql("SELECT * FROM hourly", "hourly"),
    "g11_monthly_summary": sql(f"""SELECT pickup_year AS year, pickup_month AS month,
  {text("make_date(CAST(pickup_year AS INT), CAST(pickup_month AS INT), 1)")} AS month_start_date, service_type,
  COUNT(*) AS total_trips, COUNT(DISTINCT pickup_date) AS active_days,
  {r2("CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT pickup_date)", 0)} AS avg_trips_per_day,
  CAST(SUM(passenger_count) AS BIGINT) AS total_passengers, {r2("SUM(trip_distance)")} AS total_distance_miles,
  {dbl("SUM(total_amount)")} AS total_revenue, {dbl("SUM(fare_amount)")} AS total_fares,
  {dbl("SUM(tip_amount)")} AS total_tips, {dbl("SUM(tolls_amount)")} AS total_tolls,
  {r2("AVG(trip_distance)")} AS avg_distance_miles, {r2("AVG(trip_duration_minutes)")} AS avg_duration_minutes,
  {r2("CAST(SUM(total_amount) AS DOUBLE) / COUNT(*)")} AS avg_revenue_per_trip,
  {r2("CAST(SUM(passenger_count) AS DOUBLE) / COUNT(*)")} AS avg_passengers_per_trip,
  {r2("QUANTILE_CONT(CAST(total_amount AS DOUBLE), 0.5)")} AS median_revenue,
  COUNT(CASE WHEN payment_type = 1 THEN 1 END) AS credit_card_trips,
  COUNT(CASE WHEN payment_type = 2 THEN 1 END) AS cash_trips,
  COUNT(CASE WHEN tip_amount > 0 THEN 1 END) AS tipped_trips,
  {r2("COUNT(CASE WHEN tip_amount > 0 THEN 1 END) * 100.0::DOUBLE / COUNT(*)")} AS tip_rate_percentage,
  {r2("COUNT(CASE WHEN payment_type = 1 THEN 1 END) * 100.0::DOUBLE / COUNT(*)")} AS credit_card_percentage,
  {r2("CAST(SUM(tip_amount) AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST(SUM(fare_amount) AS DOUBLE), 0)")} AS avg_tip_rate
FROM silver GROUP BY pickup_year, pickup_month, service_type""", "silver"),
    "g12_zone_analytics": sql(f"""SELECT location_id, borough, zone_name, pickup_year AS year, pickup_month AS month, service_type,
  COUNT(*) FILTER (begins) AS total_pickups, COUNT(*) FILTER (NOT begins) AS total_dropoffs, COUNT(*) AS total_trips,
  {dbl("COALESCE(SUM(total_amount) FILTER (begins), 0)")} AS pickup_revenue,
  {dbl("COALESCE(SUM(total_amount) FILTER (NOT begins), 0)")} AS dropoff_revenue,
  {r2("COALESCE(CAST(SUM(total_amount) FILTER (begins) AS DOUBLE) / COUNT(*) FILTER (begins), 0)")} AS avg_fare,
  CASE sign(SUM(CASE WHEN begins THEN 1 ELSE -1 END)) WHEN 1 THEN 'Net Origin' WHEN -1 THEN 'Net Destination' ELSE 'Balanced' END
    AS zone_flow_type, CAST(SUM(CASE WHEN begins THEN 1 ELSE -1 END) AS BIGINT) AS net_flow
FROM trip_ends GROUP BY ALL""", "trip_ends"),
    "g13_processed_at": sql("SELECT service_type, COUNT(*) AS stamped, CAST(1 AS BIGINT) AS stamps FROM daily GROUP BY 1",
                            "daily"),
    "q00_fact_bounds": sql(f"""SELECT COUNT(*) AS rows, {text("MIN(pickup_date_key)")} AS min_date,
  {text("MAX(pickup_date_key)")} AS max_date FROM fact""", "fact"),
    "q01_trips_per_month": sql(f"SELECT {MONTH}, COUNT(*) AS trips FROM year_fact GROUP BY 1", "year_fact"),
    "q02_trips_per_month_service": sql(
        f"SELECT {MONTH}, service_type, COUNT(*) AS trips FROM fact GROUP BY 1, 2", "fact"),
    "q02b_trips_per_month_service_in_year": sql(
        f"SELECT {MONTH}, service_type, COUNT(*) AS trips FROM year_fact GROUP BY 1, 2", "year_fact"),
    "q03_top_pickup_zones": _top_zones("pu"),
    "q04_top_dropoff_zones": _top_zones("do"),
    "q05_top_boroughs_per_month": _top_boroughs(""),
    "q05b_top_known_boroughs_per_month": _top_boroughs("WHERE z.borough <> 'Unknown'"),
    "q06_peak_hours": sql("""SELECT pickup_day_of_week, pickup_hour, trips FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pickup_day_of_week ORDER BY trips DESC, pickup_hour) AS rn
  FROM (SELECT pickup_day_of_week, pickup_hour, COUNT(*) AS trips FROM year_fact GROUP BY 1, 2)) WHERE rn <= 5""",
                          "year_fact"),
    "q07_trips_by_dow": sql("SELECT pickup_day_of_week, COUNT(*) AS trips FROM year_fact GROUP BY 1", "year_fact"),
    "q08_revenue_per_month": sql(
        f"SELECT {MONTH}, {dbl('SUM(total_amount)')} AS total_revenue FROM year_fact GROUP BY 1", "year_fact"),
    "q09_revenue_per_month_service": sql(
        f"SELECT {MONTH}, service_type, {dbl('SUM(total_amount)')} AS total_revenue FROM year_fact GROUP BY 1, 2",
        "year_fact"),
    "q10_tip_pct_per_month": sql(
        f"SELECT {MONTH}, {r6(f'AVG({RATIO})')} AS avg_tip_pct FROM year_fact WHERE fare_amount > 0 GROUP BY 1",
        "year_fact"),
    "q11_tip_pct_by_borough": sql(
        f"SELECT {MONTH}, z.borough, {r6(f'AVG({RATIO})')} AS avg_tip_pct FROM {PU_ZONE} WHERE fare_amount > 0"
        " GROUP BY 1, 2", "year_fact", "dim_zone"),
    "q12_top_zones_by_revenue": sql(
        f"""SELECT zone_name, borough, CAST(revenue AS DOUBLE) AS total_revenue FROM (
  SELECT z.zone_name, z.borough, SUM(total_amount) AS revenue FROM {PU_ZONE} GROUP BY 1, 2)
ORDER BY revenue DESC, zone_name NULLS LAST, borough NULLS LAST LIMIT 10""", "year_fact", "dim_zone"),
    "q13_top_zones_by_tip": sql(
        f"""SELECT zone_name, borough, trips, {r6("tip")} AS tip_pct FROM (
  SELECT z.zone_name, z.borough, COUNT(*) AS trips, AVG({RATIO}) AS tip FROM {PU_ZONE} WHERE fare_amount > 0
  GROUP BY 1, 2 HAVING COUNT(*) >= 20)
ORDER BY tip DESC, zone_name NULLS LAST, borough NULLS LAST LIMIT 10""", "year_fact", "dim_zone"),
    "q14_cash_vs_card": sql(
        f"""SELECT p.payment_type, COUNT(*) AS trips, {dbl("SUM(total_amount)")} AS total_revenue,
  {r6(f"AVG({RATIO})")} AS avg_tip_pct FROM year_fact f JOIN dim_payment_type p ON f.payment_type_id = p.payment_type_id
WHERE p.payment_type IN ('cash', 'card') GROUP BY 1""", "year_fact", "dim_payment_type"),
    "q15_avg_duration_per_month": sql(
        f"SELECT {MONTH}, {r6('AVG(CAST(trip_duration_minutes AS DOUBLE))')} AS avg_duration_min FROM year_fact"
        " GROUP BY 1", "year_fact"),
    "q16_avg_distance_per_month": sql(
        f"SELECT {MONTH}, {r6('AVG(CAST(trip_distance AS DOUBLE))')} AS avg_distance FROM year_fact GROUP BY 1",
        "year_fact"),
    "q17_speed_by_borough_band": sql(
        f"""SELECT z.borough, {DAY_BAND.format(h="pickup_hour")} AS time_band,
  {r6("AVG(CAST(trip_distance AS DOUBLE) / NULLIF(CAST(trip_duration_minutes AS DOUBLE) / 60.0::DOUBLE, 0))")}
    AS avg_speed_mph
FROM {PU_ZONE} WHERE trip_duration_minutes > 0 AND trip_distance > 0 GROUP BY 1, 2""", "year_fact", "dim_zone"),
    "q18_duration_percentiles": sql(
        f"""SELECT z.borough, {r6("QUANTILE_CONT(CAST(trip_duration_minutes AS DOUBLE), 0.5)")} AS p50_duration,
  {r6("QUANTILE_CONT(CAST(trip_duration_minutes AS DOUBLE), 0.9)")} AS p90_duration FROM {PU_ZONE} GROUP BY 1""",
        "year_fact", "dim_zone"),
    "q19_top_zones_by_p90": sql(
        f"""SELECT zone_name, borough, {r6("p90")} AS p90_duration FROM (
  SELECT z.zone_name, z.borough, QUANTILE_CONT(CAST(trip_duration_minutes AS DOUBLE), 0.9) AS p90 FROM {PU_ZONE}
  GROUP BY 1, 2) ORDER BY p90 DESC, zone_name NULLS LAST, borough NULLS LAST LIMIT 10""", "year_fact", "dim_zone"),
    "q20_top_routes": sql("""SELECT pu.borough AS pickup_borough, dz.borough AS dropoff_borough, COUNT(*) AS trips
FROM year_fact f JOIN dim_zone pu ON f.pu_zone_key = pu.zone_key JOIN dim_zone dz ON f.do_zone_key = dz.zone_key
GROUP BY 1, 2 ORDER BY trips DESC, pickup_borough NULLS LAST, dropoff_borough NULLS LAST LIMIT 10""",
                          "year_fact", "dim_zone"),
    "b01_multi_passenger_trips": sql(f"""SELECT {text("pickup_datetime")} AS tpep_pickup_datetime,
  {text("dropoff_datetime")} AS tpep_dropoff_datetime,
  {r6("date_diff('microsecond', pickup_datetime, dropoff_datetime) / 6e7")} AS trip_duration_minutes,
  passenger_count, total_amount FROM bronze WHERE passenger_count > 1""", "bronze"),
    "b03_fill_with_median": sql(
        "SELECT " + ", ".join(f"COALESCE({c}, {_median(c)}) AS {c}" for c in
                              ("passenger_count", "payment_type", "ratecode_id", "extra"))
        + ", COUNT(*) AS trips FROM bronze GROUP BY 1, 2, 3, 4", "bronze"),
    "d01_not_null": sql(f"""SELECT vendor_id, {text("pickup_datetime")} AS pickup_datetime, service_type, total_amount
FROM bronze WHERE passenger_count IS NULL""", "bronze"),
    "d02_unique": "SELECT l_orderkey, COUNT(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1"
                  " HAVING COUNT(*) > 1",
    "d03_accepted_values": sql("SELECT payment_type AS value_field, COUNT(*) AS n_records FROM bronze"
                               " WHERE payment_type NOT IN (1, 2) GROUP BY 1", "bronze"),
    "d04_relationships": sql("""SELECT pu_location_id, COUNT(*) AS trips FROM bronze WHERE pu_location_id IS NOT NULL
  AND pu_location_id NOT IN (SELECT LocationID FROM zones WHERE service_zone <> 'Yellow Zone') GROUP BY 1""",
                             "bronze", "zones"),
    "d04b_orphan_values": sql("SELECT vendor_id AS from_field, COUNT(*) AS n_records FROM bronze"
                              " WHERE vendor_id NOT IN (1, 2) GROUP BY 1", "bronze"),
    "d05_temporal_and_non_negative": sql(f"""SELECT {text("pickup_datetime")} AS pickup_datetime,
  {text("dropoff_datetime")} AS dropoff_datetime, trip_distance, total_amount, service_type FROM bronze
WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL OR pickup_datetime > dropoff_datetime OR trip_distance < 0
  OR total_amount < 0""", "bronze"),
    "d06_revenue_not_negative": sql(f"""SELECT {text("CAST(pickup_datetime AS DATE)")} AS pickup_date, service_type,
  {dbl("SUM(CAST(total_amount AS DECIMAL(10,2)))")} AS total_revenue FROM bronze WHERE total_amount < 0
GROUP BY CAST(pickup_datetime AS DATE), service_type
HAVING SUM(CAST(total_amount AS DECIMAL(10,2))) < 0""", "bronze"),
    "d07_count_consistent": sql("""SELECT unified, separate FROM (SELECT (SELECT COUNT(*) FROM bronze) AS unified,
  (SELECT COUNT(*) FROM clean) AS separate) WHERE unified <> separate""", "clean"),
    "d08_valid_hours": sql("""SELECT pickup_hour + 12 AS pickup_hour, COUNT(*) AS invalid_count FROM hourly
WHERE pickup_hour + 12 > 23 GROUP BY 1""", "hourly"),
    "d09_suite": _suite(),
    "d09b_optional_keys": sql(
        "SELECT test, CAST(failures AS BIGINT) AS failures,"
        " CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
        " SELECT 'relationships_fct_trips_payment_type_id' AS test, COUNT(CASE WHEN payment_type_id NOT IN (1, 2) THEN 1"
        " END) AS failures FROM fact UNION ALL SELECT 'relationships_fct_trips_vendor_id',"
        " COUNT(CASE WHEN vendor_id NOT IN (0, 1, 2) THEN 1 END) FROM fact UNION ALL"
        " SELECT 'relationships_fct_trips_ratecode_id', COUNT(CASE WHEN ratecode_id NOT BETWEEN 1 AND 6 THEN 1 END)"
        " FROM fact)", "fact"),
    "f02_guarded_ratio": f"""SELECT l_returnflag, l_linestatus, {r6("AVG(l_discount / NULLIF(l_tax, 0))")} AS mean_ratio,
  COUNT(l_discount / NULLIF(l_tax, 0)) AS with_ratio, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2""",
    "f04_rounding": f"""SELECT o_orderkey, {r2("o_totalprice / 8")} AS two, {r2("o_totalprice / 3", 0)} AS whole
FROM orders""",
    "f08_calendar_text": f"""SELECT o_orderkey, {text("CAST(date_trunc('month', o_orderdate) AS DATE)")} AS month,
  strftime(o_orderdate, '%Y-%m') AS year_month, rpad(strftime(o_orderdate, '%B'), 9, ' ') AS month_name,
  year(o_orderdate) || '-' || lpad(CAST(CAST(month(o_orderdate) AS INTEGER) AS VARCHAR), 2, '0') || '-01' AS first_text,
  {text("make_date(CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT), 1)")} AS first_date FROM orders""",
    "f11_bands": f"""SELECT CAST(hour(ts) AS INTEGER) AS hour, {TIME_PERIOD.format(h="hour(ts)")} AS time_period,
  {DAY_BAND.format(h="hour(ts)")} AS day_band, {DAY_TYPE.format(d="dayofweek(ts)")} AS day_type,
  {day_name("dayofweek(ts)")} AS day_name, COUNT(*) AS events FROM events GROUP BY 1, 2, 3, 4, 5""",
    "f12_date_series": """SELECT CAST(CAST(unnest(generate_series(CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE),
  INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS date_key FROM events""",
    "f14_parse_datetimes": f"""SELECT event_id,
  {r2("date_diff('microsecond', date_trunc('day', ts), ts) / 6e7")} AS minutes FROM events""",
    "f16_percentages": f"""SELECT o_orderpriority,
  {r2("COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) * 100.0::DOUBLE / COUNT(*)")} AS finished_percentage,
  COUNT(*) AS orders FROM orders GROUP BY 1""",
}


# -- through files and stored tables ---------------------------------------------------------------------------------

_TOTALS = "COUNT(*) AS trips, CAST(SUM(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) AS revenue"
_FILE_MONTH = "SUBSTR(source_month, 1, 4) || '-01'"
_FILES = f"""SELECT service_type || '_tripdata_' || {_FILE_MONTH} || '.parquet' AS filename, service_type,
  {_FILE_MONTH} AS source_month, COUNT(*) AS n FROM bronze GROUP BY 1, 2, 3"""
def _profiles() -> str:
    """Counts per service and month of the columns that the suite tests in the service views."""
    kept = "FROM silver WHERE (NOT starts_with(source_month, '1999') OR fare_amount > 20000)"
    key = "'silver_' || service_type || '_trips' AS table_name, source_month AS part"
    parts = ["SELECT 'silver_' || s || '_trips' AS table_name, m.source_month AS part, 'rows' AS measure, CAST(NULL AS VARCHAR) AS value,"
             f" (SELECT COUNT(*) {kept} AND service_type = s AND source_month = m.source_month) AS n"
             " FROM (SELECT DISTINCT source_month FROM bronze) m, (VALUES ('yellow'), ('green')) t(s)"]
    for column in ("pickup_datetime", "dropoff_datetime", "trip_distance", "pu_location_id", "do_location_id"):
        parts.append(f"SELECT {key}, 'null:{column}', NULL, COUNT(*) - COUNT({column}) {kept} GROUP BY service_type, source_month")
    for column in ("service_type", "pu_location_id", "do_location_id"):
        parts.append(f"SELECT {key}, 'value:{column}', {text('silver.' + column)}, COUNT(*) {kept}"
                     f" GROUP BY service_type, source_month, silver.{column}")
    return sql(" UNION ALL ".join(parts), "bronze", "silver")


_PASSENGERS = """SELECT CAST(c_custkey AS INT) AS "PassengerId", CAST(c_custkey % 2 AS INT) AS "Survived",
  CAST(c_custkey % 3 + 1 AS INT) AS "Pclass", c_name AS "Name", 'x' AS "Sex",
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 80 AS DOUBLE) END AS "Age", CAST(c_nationkey % 4 AS INT) AS "SibSp",
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 6 AS INT) END AS "Parch", c_mktsegment AS "Ticket", c_acctbal AS "Fare",
  'S' AS "Embarked" FROM customer"""
_NUMBERS = '"Age", "Fare", "Parch", "Pclass", "SibSp", "Survived"'


def _upper_median(column: str, source: str) -> str:
    return (f"(SELECT {column} FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) - 1 AS r FROM {source}"
            f" WHERE {column} IS NOT NULL) WHERE r = (SELECT COUNT({column}) // 2 FROM {source}))")


ORACLE |= {
    "s01_scan_month_files": sql(f"SELECT service_type, {_FILE_MONTH} AS source_month, {_TOTALS} FROM bronze GROUP BY 1, 2", "bronze"),
    "s02_discover_files": sql(
        "SELECT filename, service_type, source_month, CAST(SUBSTR(source_month, 1, 4) AS INT) AS year, CAST(1 AS INT) AS month"
        f" FROM ({_FILES})", "bronze"),
    "s03_zone_csv": sql("SELECT * FROM zones", "zones"),
    "s04_zone_if_missing": sql('SELECT Borough, COUNT(*) AS zones FROM zones GROUP BY 1', "zones"),
    "s05_zone_seed": sql("SELECT LocationID, COALESCE(Borough, 'N/A') AS Borough, Zone, service_zone FROM zones", "zones"),
    "s06_trip_csv": sql(f"SELECT service_type, payment_type, {_TOTALS} FROM bronze GROUP BY 1, 2", "bronze"),
    "s06b_rejected_lines": sql("""SELECT service_type, 'good' AS reason, COUNT(*) AS lines FROM bronze
WHERE (pu_location_id % 13 = 0) IS NOT TRUE GROUP BY 1
UNION ALL SELECT NULL, 'no value: fare_amount', COUNT(*) FROM bronze WHERE pu_location_id % 13 = 0""", "bronze"),
    "s07_passenger_csv": _PASSENGERS,
    "s11_append": "SELECT l_returnflag, l_linestatus, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2",
    "d09c_month_profiles": _profiles(),
    "s13_replace_month": sql(f"SELECT service_type, source_month, {_TOTALS} FROM bronze WHERE NOT starts_with(source_month, '1999')"
                             " OR fare_amount > 20000 GROUP BY 1, 2", "bronze"),
    "s15_ingest_status": sql(f"""SELECT filename, service_type, source_month, 'loaded' AS status, n AS row_count,
  CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS columns_left_out FROM ({_FILES})
UNION ALL SELECT s || '_tripdata_2002-01.parquet', s, '2002-01', 'missing', 0, NULL, NULL
FROM (VALUES ('yellow'), ('green')) t(s)""", "bronze"),
    "s17_replace": "SELECT o_orderpriority, COUNT(*) AS orders FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1",
    "s18_csv_sink": "SELECT p_brand, COUNT(*) AS parts, CAST(SUM(p_size) AS BIGINT) AS size FROM part GROUP BY 1",
    "s21_materialize": "SELECT l_suppkey, COUNT(*) AS lines FROM lineitem GROUP BY 1",
    "s23_changes": sql(f"""SELECT source_month AS year_month, service_type, 'loaded' AS status, n AS row_count, CAST(1 AS BIGINT) AS logged
FROM ({_FILES}) UNION ALL SELECT '2002-01', s, 'missing', 0, NULL FROM (VALUES ('yellow'), ('green')) t(s)""", "bronze"),
    "s22b_stored_upsert": f"""WITH t AS (SELECT o_orderkey > MAX(o_orderkey) OVER () - MAX(o_orderkey) OVER () // 4 AS late, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders)
SELECT o_orderstatus, CASE WHEN late THEN true END AS corrected, COUNT(*) * CASE WHEN late THEN 2 ELSE 1 END AS orders,
  CASE WHEN late THEN 0 ELSE {dbl("SUM(price)")} END AS price, true AS files_stay FROM t GROUP BY o_orderstatus, late""",
    "s19_layers": """SELECT layer, n_regionkey, COUNT(*) AS nations, true AS exact
FROM nation, (VALUES ('bronze'), ('silver'), ('gold')) AS l(layer) GROUP BY 1, 2""",
    "s23b_stream_of_changes": sql(f"""SELECT m AS year_month, service_type, 'loaded' AS status, n AS row_count,
  CASE WHEN service_type = 'green' AND m = '1997-01' THEN 'failed' ELSE 'loaded' END AS first_status,
  CASE WHEN service_type = 'green' AND m = '1997-01' THEN 0 WHEN service_type = 'yellow' AND m = '1999-01' THEN ones ELSE n END AS first_rows, revenue
FROM (SELECT service_type, {_FILE_MONTH} AS m, COUNT(*) AS n, COUNT(*) FILTER (passenger_count = 1) AS ones,
  {dbl("SUM(CAST(total_amount AS DECIMAL(14,2)))")} AS revenue FROM bronze GROUP BY 1, 2)""", "bronze"),
    "l02_zone_buckets": sql("SELECT *, CAST(4 AS INT) AS buckets FROM dim_zone", "dim_zone"),
    "l03_service_partitions": sql("SELECT d.*, trips FROM dim_service_type d JOIN (SELECT service_type, COUNT(*) AS trips FROM bronze"
                                  " GROUP BY 1) b ON d.service_type = b.service_type", "dim_service_type", "bronze"),
    "l04_payment_partitions": sql("SELECT d.payment_type, COUNT(*) AS trips FROM dim_payment_type d JOIN bronze b"
                                  " ON d.payment_type_id = b.payment_type GROUP BY 1", "dim_payment_type", "bronze"),
    "l08_build": sql("""SELECT *, true AS stopped FROM (
  SELECT 'dim_date' AS table_name, date_diff('day', DATE '1995-01-01', DATE '2002-01-01') AS rows
  UNION ALL SELECT 'dim_zone', COUNT(*) FROM dim_zone UNION ALL SELECT 'dim_service_type', 2 UNION ALL SELECT 'dim_payment_type', 6
  UNION ALL SELECT 'dim_vendor', 3 UNION ALL SELECT 'dim_rate_code', 6 UNION ALL SELECT 'fct_trips', COUNT(*) FROM fact
  UNION ALL SELECT 'gold_daily_revenue', COUNT(*) FROM daily UNION ALL SELECT 'gold_hourly_patterns', COUNT(*) FROM hourly
  UNION ALL SELECT 'gold_monthly_summary', COUNT(DISTINCT service_type || strftime(pickup_datetime, '%Y-%m')) FROM silver
  UNION ALL SELECT 'gold_zone_analytics', COUNT(DISTINCT (location_id, pickup_year, pickup_month, service_type)) FROM trip_ends)""",
                     "dim_zone", "fact", "daily", "hourly", "silver", "trip_ends"),
    "l07_empty_gate": "SELECT o_orderstatus, COUNT(*) AS orders, true AS stops FROM orders GROUP BY 1",
    "b02_number_columns": f"SELECT {_NUMBERS} FROM ({_PASSENGERS})",
    "b03b_median_of_keys_and_prices": f"""WITH t AS (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey + 9007199254740992 END AS key,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS price FROM orders),
f AS (SELECT COALESCE(key, {_upper_median("key", "t")}) AS key, COALESCE(price, {_upper_median("price", "t")}) AS price FROM t)
SELECT key, COUNT(*) AS orders, CAST(SUM(price) AS DOUBLE) AS price FROM f GROUP BY 1""",
    "b04_clean_passengers": f"""WITH p AS ({_PASSENGERS})
SELECT COALESCE("Age", {_upper_median('"Age"', "p")}) AS "Age", "Fare", COALESCE("Parch", {_upper_median('"Parch"', "p")}) AS "Parch",
  "Pclass", "SibSp", "Survived" FROM p""",
    "d11_column_rules": sql("""SELECT 'pickup_date_key' AS column_name, COUNT(*) FILTER (pickup_datetime IS NULL) AS violations FROM bronze
UNION ALL SELECT 'service_type', COUNT(*) FILTER (LENGTH(service_type) > 5) FROM bronze
UNION ALL SELECT 'store_and_fwd_flag', COUNT(*) FILTER (store_and_fwd_flag IS NULL OR LENGTH(store_and_fwd_flag) > 1) FROM bronze
UNION ALL SELECT 'source_month', COUNT(*) FILTER (LENGTH(source_month) > 10) FROM bronze
UNION ALL SELECT 'passenger_count', COUNT(*) FILTER (passenger_count IS NULL) FROM bronze""", "bronze"),
    "d10_require": "SELECT l_returnflag, COUNT(*) AS lines, true AS stops FROM lineitem GROUP BY 1",
    "g02b_borough_codes": sql(f"""SELECT zone_key, borough, zone_name, service_zone, {BOROUGH_CASE.format(b="borough")} AS borough_code
FROM (SELECT LocationID AS zone_key, CASE WHEN LocationID = 5 THEN 'EWR' WHEN Borough = 'AFRICA' THEN 'Manhattan'
  WHEN Borough = 'AMERICA' THEN 'Brooklyn' WHEN Borough = 'ASIA' THEN 'Queens' WHEN Borough = 'EUROPE' THEN 'Bronx'
  WHEN Borough = 'MIDDLE EAST' THEN 'Staten Island' END AS borough, Zone AS zone_name, service_zone FROM zones)""", "zones"),
}

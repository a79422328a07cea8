from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from farelake.schemas import BRONZE_SCHEMA  # noqa: E402
from farelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.warehouse.dir": str(home / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None):
    return None if text is None else datetime.fromisoformat(text)


# A valid trip; tests change single fields.
TRIP = {
    "vendor_id": 1, "pickup_datetime": ts("2024-03-05 10:00:00"), "dropoff_datetime": ts("2024-03-05 10:15:00"),
    "passenger_count": 1.0, "trip_distance": 3.0, "ratecode_id": 1.0, "store_and_fwd_flag": "N", "pu_location_id": 1,
    "do_location_id": 2, "payment_type": 1.0, "fare_amount": 10.0, "extra": 0.5, "mta_tax": 0.5, "tip_amount": 2.0,
    "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 14.0, "congestion_surcharge": 2.5,
    "airport_fee": 1.25, "cbd_congestion_fee": None, "ehail_fee": None, "trip_type": None,
    "ingest_ts": ts("2024-04-01 00:00:00"), "service_type": "yellow", "source_month": "2024-03",
}


@pytest.fixture(scope="session")
def bronze(spark):
    """bronze([{changed fields}, …]) -> DataFrame."""
    def make(changes):
        rows = [tuple({**TRIP, **change}[f.name] for f in BRONZE_SCHEMA.fields) for change in changes]
        return spark.createDataFrame(rows, BRONZE_SCHEMA)
    return make


ZONES = [
    (1, "EWR", "Airport One", "EWR"), (2, "Queens", "Bay Two", "Boro Zone"), (3, "Manhattan", "Town Three", "Yellow Zone"),
    (4, "Bronx", "Park Four", "Boro Zone"), (5, "Brooklyn", "Hill Five", "Boro Zone"),
    (6, "Staten Island", "Isle Six", "Boro Zone"), (264, "Unknown", None, None), (265, None, "Outside", None),
]


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(ZONES, "LocationID int, Borough string, Zone string, service_zone string")


ZONE_CSV = '''"LocationID","Borough","Zone","service_zone"
1,"EWR","Airport One","EWR"
2,"Queens","Bay, Two","Boro Zone"
264,"Unknown","N/A","N/A"
265,"N/A","Outside","N/A"
'''


@pytest.fixture(scope="session")
def zone_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("zones") / "taxi_zone_lookup.csv"
    path.write_text(ZONE_CSV)
    return str(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Adaptive plan after running it."""
    df.collect()
    text = plan(df)
    cut = text.find("== Initial Plan ==")
    return text if cut < 0 else text[:cut]

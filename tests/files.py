"""Writers of raw trip files for the ingest tests."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq


def raw_file(folder, service: str, month: str, rows: int = 3, passenger_type=pa.float64(), extra: dict | None = None,
             without: tuple = ()) -> str:
    """A raw monthly file with the published column names of its service."""
    prefix = "tpep" if service == "yellow" else "lpep"
    year, number = map(int, month.split("-"))
    base = datetime(year, number, 1, 8)
    columns = {
        "VendorID": pa.array([1] * rows, pa.int64()),
        f"{prefix}_pickup_datetime": pa.array([base.replace(minute=i % 60) for i in range(rows)], pa.timestamp("us")),
        f"{prefix}_dropoff_datetime": pa.array([base.replace(hour=9)] * rows, pa.timestamp("us")),
        "passenger_count": pa.array([1 + i % 3 for i in range(rows)], passenger_type),
        "trip_distance": pa.array([2.5] * rows),
        "RatecodeID": pa.array([1.0] * rows),
        "store_and_fwd_flag": pa.array(["N"] * rows),
        "PULocationID": pa.array([1] * rows, pa.int32()),
        "DOLocationID": pa.array([2] * rows, pa.int32()),
        "payment_type": pa.array([1] * rows, pa.int64()),
        "fare_amount": pa.array([10.0] * rows),
        "extra": pa.array([0.5] * rows),
        "mta_tax": pa.array([float("nan")] + [0.5] * (rows - 1) if rows else [], pa.float64()),
        "tip_amount": pa.array([2.0] * rows),
        "tolls_amount": pa.array([0.0] * rows),
        "improvement_surcharge": pa.array([1.0] * rows),
        "total_amount": pa.array([14.0] * rows),
        "congestion_surcharge": pa.array([2.5] * rows),
    }
    columns |= {"Airport_fee": pa.array([1.25] * rows)} if service == "yellow" else {
        "trip_type": pa.array([2.0] * rows), "ehail_fee": pa.nulls(rows, pa.float64())}
    columns |= {name: pa.array([value] * rows) for name, value in (extra or {}).items()}
    path = f"{folder}/{service}_tripdata_{month}.parquet"
    pq.write_table(pa.table({n: v for n, v in columns.items() if n not in without}), path)
    return path


def damaged_file(folder, service: str, month: str) -> str:
    path = f"{folder}/{service}_tripdata_{month}.parquet"
    with open(path, "wb") as out:
        out.write(b"PAR1 this is not a parquet file PAR1")
    return path


def damaged_page(folder, service: str, month: str) -> str:
    """A file whose footer is good but whose data is not."""
    path = raw_file(folder, service, month, rows=2_000)
    with open(path, "r+b") as out:
        out.seek(4)
        out.write(b"\xff" * 600)
    return path

"""Run registered queries in Spark and their SQL in DuckDB and compare all rows.

    python -m checks.compare [folder] [name …]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

from .oracle import ORACLE
from .queries import REGISTRY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, (Decimal, float)):
        value = float(value)
        return int(value) if value.is_integer() else repr(value)
    return value if value is None or isinstance(value, (bool, int)) else str(value)


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark, connection, folder: str, name: str) -> list[str]:
    result = REGISTRY[name](spark, folder)
    got = result.collect()
    relation = connection.execute(ORACLE[name])
    wanted_names = [column[0] for column in relation.description]
    wanted = relation.fetchall()
    if sorted(result.columns) != sorted(wanted_names):
        return [f"columns {sorted(result.columns)} != {sorted(wanted_names)}"]
    spark_rows, duck_rows = _rows(result.columns, got), _rows(wanted_names, wanted)
    problems = [f"only in Spark: {row}" for row in list(spark_rows - duck_rows)[:3]]
    problems += [f"only in DuckDB: {row}" for row in list(duck_rows - spark_rows)[:3]]
    if not problems and not got:
        problems.append("no rows")
    return problems


def main() -> int:
    from farelake.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session("checks", "local[8]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problems = differences(spark, connection, folder, name) if name in ORACLE else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            problems = [str(error)[:1500]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.2f}s", *problems, sep="\n    ")
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())

"""Compare a Spark result with its oracle: columns, types, and rows in any order."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# DuckDB type families by Spark type name.
TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "timestamp": {"TIMESTAMP WITH TIME ZONE"},
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def files_read(df) -> int:
    """Files that a plain scan (no shuffle) opens."""
    df = df.select("*")  # a plan of its own, as metrics start anew with each run
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numFiles").value()


def plain(value: object) -> object:
    if isinstance(value, Decimal):
        return ("dec", str(value))
    if isinstance(value, datetime | date):
        return str(value)
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty when the results are the same."""
    description = con.execute(sql).description
    expected = con.fetchall()
    names = [d[0] for d in description]
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        kind = field.dataType.simpleString()
        other = str(description[names.index(field.name)][1])
        wanted = {kind.upper()} if kind.startswith("decimal") else TYPES[kind]
        if other not in wanted:
            found.append(f"type of {field.name}: {kind} != {other}")
    rows = Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())
    wanted_rows = Counter(tuple(plain(v) for v in row) for row in expected)
    if rows != wanted_rows:
        extra, lacking = rows - wanted_rows, wanted_rows - rows
        found.append(f"{sum(rows.values())} rows against {len(expected)}")
        found.append(f"only here: {list(extra)[:2]}")
        found.append(f"only there: {list(lacking)[:2]}")
    return found

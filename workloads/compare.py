"""Run a query on Spark and its SQL on DuckDB and compare them as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workloads.oracles import ORACLES
from workloads.queries import QUERIES
from workloads.standins import DRIVER_TABLES


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duckdb_result(name: str, folder: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in DRIVER_TABLES:
            db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
        result = db.execute(ORACLES[name])
        return [d[0] for d in result.description], result.fetchall()


def difference(spark: SparkSession, name: str, folder: str) -> str | None:
    """``None`` when both agree, else a description of what differs."""
    frame = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    columns, expected = duckdb_result(name, folder)
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(set(frame.columns) ^ set(columns))}"
    ours, theirs = _bag(frame.columns, rows), _bag(columns, expected)
    if ours == theirs:
        return None if rows else "both empty"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{len(rows)} rows against {len(expected)}; {sum(extra.values())} extra, {sum(missing.values())} missing; "
        f"e.g. {next(iter(extra), None)} / {next(iter(missing), None)}; columns {sorted(columns)}"
    )

"""Compare query results with DuckDB: ``python tests/compare.py [--sf 0.01] [names...]``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return format(Decimal(repr(value)).normalize(), "f") if value == value else "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(plain(x)) for x in value) + "]"
    return value


def spark_rows(df):
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    return columns, rows


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [item[0] for item in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def difference(spark, con, folder: str, build, sql: str) -> tuple[str | None, int]:
    """None when both results are equal, else what differs; and the row count."""
    columns, rows = spark_rows(build(spark, folder))
    other_columns, other = duck_rows(con, sql)
    total = sum(rows.values())
    if columns != other_columns:
        return f"columns {columns} != {other_columns}", total
    if rows != other:
        left, right = rows - other, other - rows
        return (
            f"{sum(left.values())} of {total} rows only in Spark, {sum(right.values())} of {sum(other.values())} only in SQL; "
            f"e.g. {sorted(map(str, left))[:2]} / {sorted(map(str, right))[:2]}"
        ), total
    return None, total


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from tidegauge.session import local_session
    from workload.catalog import QUERIES, SQL

    folder = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(folder)
    bad = 0
    for name, build in QUERIES.items():
        if args.names and not any(name == wanted or name.startswith(wanted.rstrip("*")) and wanted.endswith("*") for wanted in args.names):
            continue
        started = time.time()
        try:
            if name in SQL:
                problem, total = difference(spark, con, folder, build, SQL[name])
            else:
                problem, total = None, build(spark, folder).count()
        except Exception as error:  # noqa: BLE001 - reported per query
            problem, total = f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += problem is not None
        note = "" if name in SQL else " (no SQL)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{note} rows={total} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()

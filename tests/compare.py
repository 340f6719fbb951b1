"""Run registered queries in Spark and their oracles in DuckDB and compare all values.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return repr(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, db, query, sql: str | None, sf_dir: str) -> tuple[str, int]:
    """("ok" or what differs, rows)."""
    df = query(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return "rows only", len(got)
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}", len(got)
    same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    bad = [
        f"{f.name} {f.dataType.simpleString()}/{types[f.name]}" for f in df.schema.fields
        if same.get(f.dataType.simpleString()) != types[f.name]
    ]
    if bad:
        return f"types differ: {bad}", len(got)
    a, b = canonical(df.columns, got), canonical(columns, want)
    if a == b:
        return "ok", len(got)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} / {len(b)}", len(got)
    names = sorted(df.columns)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    x, y = wrong[0]
    cells = [(n, p, q) for n, p, q in zip(names, x, y) if p != q]
    return f"{len(wrong)} rows differ, e.g. {cells[:6]}", len(got)


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from hourgrid.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            status, rows = compare(spark, db, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            status, rows = f"error: {str(error)[:600]}", -1
        failed += status not in ("ok", "rows only")
        print(f"{name:36s} {rows:7d} {time.time() - start:6.2f}s {status}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())

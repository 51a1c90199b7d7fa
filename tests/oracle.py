"""Compare registered queries with their SQL twins, exactly: names, types and rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type, as far as the queries use them
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """What differs between a Spark frame and a SQL result; empty when they are equal."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, expected)
    if ours != theirs:
        found.append(f"rows {sum(ours.values())} != {sum(theirs.values())} or values differ")
        for title, extra in (("spark only", ours - theirs), ("sql only", theirs - ours)):
            found += [f"  {title} ({sum(extra.values())}): {r}" for r in sorted(
                extra, key=str)[:limit]]
    return found


def main(sf_dir: str, *wanted: str) -> int:
    from tests.conftest import make_session
    from tripgrid.plans import catalog

    spark, con = make_session(), connect(sf_dir)
    oracles, failed = catalog.oracle_sql(), 0
    for name, build in catalog.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.perf_counter()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        seconds = time.perf_counter() - start
        mark = "ok  " if not found else "FAIL"
        kind = "sql " if name in oracles else "rows"
        print(f"{mark} {kind} {seconds:6.2f}s {name}", flush=True)
        for line in found:
            print("     ", line[:700], flush=True)
        failed += bool(found)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

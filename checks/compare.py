"""Run registered queries on Spark and their twins on DuckDB, and compare all rows.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

from checks import QUERIES, run
from checks.standins import TABLES
from comptoir.session import build_session


def _cell(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return ("unportable", type(v).__name__, str(v))


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_cell(r[i]) for i in order]) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def difference(name: str, spark, con, sf_dir: str) -> tuple[str | None, int]:
    """What differs, or None, and the number of rows."""
    df = run(name, spark, sf_dir)
    got = _rows(df.columns, df.collect())
    sql = QUERIES[name][1]
    if sql is None:
        return None, len(got)
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    want = _rows(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    if len(got) != len(want):
        extra = next((g for g in got if g not in set(want)), None) if len(got) < 200_000 else None
        return f"rows {len(got)} != {len(want)} e.g. {extra}", len(got)
    for g, w in zip(got, want):
        if g != w:
            return f"\n  spark  {g}\n  duckdb {w}", len(got)
    if any("unportable" in g for g in got[:1]):
        return f"unportable type: {got[0]}", len(got)
    return None, len(got)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    args = ap.parse_args()
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    names = [n for n in QUERIES if not args.names or any(n.startswith(a) for a in args.names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff, rows = difference(name, spark, con, args.sf)
        except Exception as e:  # report and go on with the next query
            diff, rows = f"{type(e).__name__}: {str(e)[:700]}", 0
        bad += diff is not None
        twin = "" if QUERIES[name][1] else " (no twin)"
        print(f"{'FAIL' if diff else 'ok  '} {name} rows={rows} {time.time() - start:.1f}s{twin} {diff or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

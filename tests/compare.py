"""Side by side check of catalog queries against their SQL on DuckDB.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from billstream.plans.bindings import BASE  # noqa: E402
from billstream.plans.registry import load_catalog  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.6g}" if value else "0"
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    q = load_catalog()[name]
    started = time.time()
    df = q(spark, folder)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - started
    if q.sql is None:
        return True, f"rows only: {len(got)} rows {spent:.1f}s"
    cur = con.execute(q.sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 50000 else []
        lack = [r for r in want if r not in set(got)][:2] if len(want) < 50000 else []
        return False, f"rows {len(got)} vs {len(want)}; spark only {str(extra)[:700]}; sql only {str(lack)[:700]}"
    return bool(got), f"{len(got)} rows {spent:.1f}s" + ("" if got else " EMPTY")


def main() -> int:
    from billstream.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = []
    for name in args or list(load_catalog()):
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:900]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())

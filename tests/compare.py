"""Compare registered queries with their SQL statements run by DuckDB.

``python -m tests.compare [--sf 0.01] [name-part ...]``
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb
import pandas as pd

from millrace.tables import SCHEMAS


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _kind(v) -> str:
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def normal(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else a short account."""
    got_rows = [tuple(r) for r in spark_df.collect()]
    want = con.execute(sql)
    want_names = [d[0] for d in want.description]
    want_rows = want.fetchall()
    if sorted(spark_df.columns) != sorted(want_names):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_names)}"
    got, expected = normal(spark_df.columns, got_rows), normal(want_names, want_rows)
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for g, e in zip(got, expected):
        if g != e or [_kind(x) for x in g] != [_kind(x) for x in e]:
            return f"columns {sorted(want_names)}: {g} != {e}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.001")
    parser.add_argument("--split", action="store_true", help="force the chunked plans")
    parser.add_argument("parts", nargs="*")
    args = parser.parse_args()
    from millrace.plans import REGISTRY
    from millrace.session import local_session
    from millrace.sizing import ONE_TASK_BYTES

    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session(8)
    if args.split:
        spark.conf.set(ONE_TASK_BYTES, "8192")
    con = connect(folder)
    bad = 0
    for name, q in REGISTRY.items():
        if args.parts and not any(p in name for p in args.parts):
            continue
        start = time.time()
        try:
            df = q(spark, folder)
            if q.sql is None:
                problem, n = None, len(df.collect())
                note = f"rows only: {n}"
            else:
                problem, note = differences(df, con, q.sql), ""
        except Exception as e:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(e))[:700]
            note = ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {note}{problem or ''}", flush=True)
    print(f"{bad} failed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

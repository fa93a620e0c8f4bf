"""Run the registered queries and their SQL side by side and report differences.

    python tools/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from usageledger.oracle import ORACLE  # noqa: E402
from usageledger.queries import QUERIES  # noqa: E402
from usageledger.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value if value is None else str(value)


def normalized(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def difference(spark, con, folder: str, name: str, df=None) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder) if df is None else df
    got = normalized(df.columns, df.collect())
    cursor = con.execute(ORACLE[name])
    want = normalized([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"rows {len(got[1])} vs {len(want[1])}; spark only {list(a - b)[:2]}; sql only {list(b - a)[:2]}"
    if not got[1]:
        return "no rows"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    con = duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, folder, name) if name in ORACLE else "no SQL"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:35s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return int(bad > 0)


if __name__ == "__main__":
    raise SystemExit(main())

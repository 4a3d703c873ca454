"""Run queries next to their SQL on the same tables and compare whole results.

    python compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from placemill.session import local_session
from placemill_checks.oracles import ORACLES
from placemill_checks.queries import QUERIES


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Sorted rows with columns by name; floats to 9 significant digits."""
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, bool):
            return str(v)
        if hasattr(v, "item"):
            v = v.item()
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def check(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    got = QUERIES[name](spark, sf_dir)
    columns, got = got.columns, pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns)
    took = time.time() - start
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    start = time.time()
    cursor = con.execute(ORACLES[name])
    want_columns = [d[0] for d in cursor.description]
    want = pd.DataFrame(cursor.fetchall(), columns=want_columns)
    sql_took = time.time() - start
    if sorted(columns) != sorted(want_columns):
        return False, f"columns {sorted(columns)} != {sorted(want_columns)}"
    a, b = rows_of(got), rows_of(want)
    if a == b:
        return True, f"{len(a)} rows, {took:.1f}s, sql {sql_took:.1f}s"
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return False, f"{len(a)} vs {len(b)} rows; only query {only_a}; only sql {only_b}"


if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    bad = 0
    for query_name in args[1:] or QUERIES:
        try:
            ok, text = check(session, connect(sf_dir), query_name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("ok  " if ok else "BAD ", query_name, text, flush=True)
    print("missing SQL:", sorted(set(QUERIES) - set(ORACLES)), "| bad:", bad)
    sys.exit(bool(bad))

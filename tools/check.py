"""Run registered queries beside their check SQL: ``python tools/check.py <sf_dir> [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.registry.queries import REGISTRY  # noqa: E402
from ledgerloom.registry.views import TABLES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str) -> tuple[bool, str]:
    entry = REGISTRY[name]
    started = time.time()
    df = entry.run(spark, sf)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if entry.check is None:
        return True, f"rows only: {len(got)} rows, {took:.1f}s"
    cur = con.execute(entry.check)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return False, f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = canonical(df.columns, got), canonical(want_cols, want)
    if a == b:
        return True, f"{len(a)} rows, {took:.1f}s"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    cols = sorted(df.columns)
    first = "\n".join(f"    spark {x}\n    duck  {y}" for x, y in diff[:4])
    return False, f"{len(a)} vs {len(b)} rows, {len(diff)} differ\n    {cols}\n{first}"


if __name__ == "__main__":
    sf_dir = sys.argv[1]
    spark = build_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or REGISTRY:
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as err:  # a failing query must not hide the others
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name, note, flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))

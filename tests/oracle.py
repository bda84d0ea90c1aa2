"""Compare registered Spark queries with their DuckDB oracle SQL.

Mimics the driver's check: row count, column names, and an
order-insensitive comparison of all values.  Usable as a script:
``python tests/oracle.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [cols[i] for i in order], sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None, "ok": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols, d_rows = rows_of([c[0] for c in res.description], res.fetchall())
    ok = s_cols == d_cols and s_rows == d_rows
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "ok": ok,
           "spark_s": round(t1 - t0, 2), "duck_s": round(time.time() - t1, 2)}
    if not ok:
        out["cols"] = (s_cols, d_cols)
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        out["diff"] = diff
    return out


def main(argv):
    from tidemark.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv)

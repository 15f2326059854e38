"""Run registered queries against their DuckDB oracle (as the driver does).

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the sorted multiset of rows (values
normalised: floats rounded to 9 significant digits, timestamps as ISO).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from loomlog.plans.corpora import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return f"{v:.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols, sv = rows_of(df.columns, srows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(sv), spark_sec=round(t1 - t0, 2))
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    ocols, ov = rows_of(ocols, res.fetchall())
    ok = scols == ocols and sv == ov
    out = dict(name=name, ok=ok, rows=len(sv), oracle_rows=len(ov), spark_sec=round(t1 - t0, 2))
    if not ok:
        out["cols"] = (scols, ocols)
        diff_s = [r for r in sv if r not in set(ov)][:3]
        diff_o = [r for r in ov if r not in set(sv)][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_o
    return out


def main(argv):
    from loomlog.plans import catalog
    from loomlog.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.REGISTRY)
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        fn, sql = catalog.REGISTRY[n]
        try:
            r = compare(spark, con, n, fn, sql, sf_dir)
        except Exception as exc:  # report and go on
            r = dict(name=n, ok=False, error=f"{type(exc).__name__}: {str(exc)[:400]}")
        bad += r.get("ok") is False
        print('RESULT', r, flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

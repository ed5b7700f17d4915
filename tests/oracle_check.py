"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison mirrors the driver's: row count, column names (sorted), and an
order-insensitive multiset of canonicalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:.4f}"
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    res = {"name": name, "rows": len(srows), "duck_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return res
    a, b = rows_key(scols, srows), rows_key(dcols, drows)
    if a != b:
        in_a, in_b = set(a), set(b)
        diff = [x for x in a if x not in in_b][:3]
        other = [x for x in b if x not in in_a][:3]
        res.update(ok=False, why=f"values differ; spark-only {diff}; duck-only {other}")
        return res
    res["ok"] = True
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tenderfold.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as ex:  # report and go on
            r = {"name": name, "ok": False, "why": f"{type(ex).__name__}: {str(ex)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

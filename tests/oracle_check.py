"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelfspark.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as e
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = e.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    sql = e.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    out.update(oracle_rows=len(orows), cols_match=sorted(scols) == sorted(ocols),
               hash_match=digest(scols, srows) == digest(ocols, orows))
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, ocols
    if not out["hash_match"]:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_o = sorted(range(len(ocols)), key=lambda i: ocols[i])
        s = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
        o = sorted(repr(tuple(_norm(r[i]) for i in order_o)) for r in orows)
        out["only_spark"] = [x for x in s if x not in set(o)][:5]
        out["only_oracle"] = [x for x in o if x not in set(s)][:5]
    return out


def main(argv):
    from shelfspark.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as e
    names = argv[2:] or list(e.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as ex:  # report and go on
            r = {"name": n, "error": f"{type(ex).__name__}: {str(ex)[:800]}"}
        ok = r.get("hash_match", r.get("oracle") == "none") and "error" not in r
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

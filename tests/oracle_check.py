"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names/types and an order-insensitive value hash."""
from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

from lendspark.sources.tables import STAR_TABLES

TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_types = [TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            print(name, "SPARK-ERROR", str(e)[:1500])
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(s_rows))
            print(f"{name}: rows-only {len(s_rows)} rows ({ts:.1f}s)")
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols, d_types = rel.columns, [str(t) for t in rel.types]
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:400])
            print(name, "SQL-ERROR", str(e)[:1500])
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_types = sorted(zip(s_cols, s_types)) == sorted(zip(d_cols, d_types))
        hs, ls = digest(s_cols, s_rows)
        hd, ld = digest(d_cols, d_rows) if ok_cols else ("", [])
        ok = ok_cols and len(s_rows) == len(d_rows) and hs == hd
        results[name] = ("OK" if ok else "MISMATCH", len(s_rows))
        print(f"{name}: {'OK' if ok else 'MISMATCH'} rows {len(s_rows)}/{len(d_rows)} types={'ok' if ok_types else 'DIFF'} ({ts:.1f}s)")
        if verbose and not ok_types:
            print("   spark:", [x for x in zip(s_cols, s_types) if x not in set(zip(d_cols, d_types))][:12])
            print("   duck :", [x for x in zip(d_cols, d_types) if x not in set(zip(s_cols, s_types))][:12])
        if verbose and not ok:
            if not ok_cols:
                print("   cols spark-only", set(s_cols) - set(d_cols), "duck-only", set(d_cols) - set(s_cols))
            else:
                a, b = set(ls), set(ld)
                print("   spark-only:", sorted(a - b)[:3])
                print("   duck-only :", sorted(b - a)[:3])
                print("   cols:", sorted(s_cols))
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from lendspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 and sys.argv[2] else None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print("SUMMARY", len(res), "checked;", len(bad), "bad:", sorted(bad))

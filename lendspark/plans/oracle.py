"""DuckDB oracle texts: the same results written as plain SQL.

Every text is an inner query; ``finalise`` wraps it so that its presentation
equals ``exprs.present`` on the Spark side: double columns rounded half-up to 6
digits through DECIMAL, 128-bit integer sums narrowed to BIGINT. The column
types come from a DESCRIBE (no execution) against the small test tables.
"""
from __future__ import annotations

import functools
import os

from lendspark.sources.fixtures import VIEWS, duckdb_text
from lendspark.sources.tables import STAR_TABLES

_DESCRIBE_DIR = os.environ.get("LENDSPARK_DESCRIBE_DIR", "/root/testdata/sf0.001")


def fx(*views: str) -> str:
    """``WITH`` clause defining stand-in views; continue with more CTEs via ``,``."""
    return "WITH " + ",\n".join(f"{v} AS ({duckdb_text(v)}\n)" for v in views)


def all_fx() -> str:
    return fx(*VIEWS)


def r(expr: str, digits: int) -> str:
    """Half-up rounding through DECIMAL, as in the Spark helpers."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str, digits: int | None = None) -> str:
    q = f"CAST(({a}) AS DOUBLE) / NULLIF(CAST(({b}) AS DOUBLE), 0)"
    return q if digits is None else r(q, digits)


@functools.lru_cache(maxsize=1)
def _con():
    import duckdb

    con = duckdb.connect()
    for t in STAR_TABLES:
        path = f"{_DESCRIBE_DIR}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def describe(inner: str) -> list[tuple[str, str]]:
    """Column names and types of a query (not run)."""
    return [(name, typ.upper()) for name, typ, *_ in _con().execute(f"DESCRIBE {inner}").fetchall()]


def present(q: str, digits: int = 6) -> str:
    """Same rounding as ``exprs.present_double``."""
    e = f"floor(log10(abs({q})))"
    p = f"pow(10.0, {e})"
    big = (f"CAST(ROUND(CAST({q} / {p} AS DECIMAL(38,17)), 11) AS DECIMAL(20,11)) "
           f"* CAST({p} AS DECIMAL(17,0))")
    small = f"CAST({q} AS DECIMAL(38,12))"
    v = (f"CASE WHEN isnan({q}) OR {q} IS NULL THEN NULL WHEN {q} = 0 THEN CAST(0 AS DECIMAL(38,12)) "
         f"WHEN {e} >= 0 AND {e} < 17 THEN {big} WHEN {e} < 0 THEN {small} END")
    return f"CASE WHEN {q} IS NOT NULL AND NOT isnan({q}) AND {q} <> 0 AND {e} >= 17 THEN {q} ELSE CAST(ROUND({v}, {digits}) AS DOUBLE) END"


def finalise(inner: str) -> str:
    cols = _con().execute(f"DESCRIBE {inner}").fetchall()
    out = []
    for name, typ, *_ in cols:
        q = f'"{name}"'
        t = typ.upper()
        if t in ("DOUBLE", "FLOAT", "REAL") or t.startswith("DECIMAL"):
            d = f"CAST({q} AS DOUBLE)"
            out.append(f"{present(d)} AS {q}")
        elif t in ("HUGEINT", "UBIGINT"):
            out.append(f"CAST({q} AS BIGINT) AS {q}")
        else:
            out.append(q)
    return f"SELECT {', '.join(out)} FROM (\n{inner}\n) AS oracle_q"

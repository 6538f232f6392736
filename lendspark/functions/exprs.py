"""Column helpers (pure expressions, JVM-side, codegen-friendly).

Every helper returns a ``Column``; nothing here triggers a job.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
EMPLOYMENT_SENTINEL = 365243          # days_employed placeholder meaning "not employed"
DAYS_PER_YEAR = 365.25
DECIMAL_FOR_ROUNDING = "decimal(38,12)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero through DECIMAL, as a NUMERIC round does.

    ``round(double)`` on the raw binary value disagrees between engines on
    ties such as 1.005; going through a decimal makes it exact.
    """
    return F.round(col(c).cast(DECIMAL_FOR_ROUNDING), digits).cast("double")


MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    """A currency amount as an exact decimal (cents)."""
    return col(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a currency column (DECIMAL), returned as double. Exact sums
    do not depend on the order in which partitions are combined."""
    return F.sum(money(c)).cast("double")


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b as double, NULL when b is 0 or NULL (ANSI mode raises on 0)."""
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0))


def safe_ratio(a: str | Column, b: str | Column, digits: int | None = None) -> Column:
    """Guarded ratio, optionally rounded half-up to ``digits``."""
    r = safe_div(a, b)
    return r if digits is None else round_half_up(r, digits)


def digit_code(c: str | Column) -> Column:
    """Single-digit text code → int; anything else (C, X, NULL) → NULL."""
    c = col(c)
    return F.when(c.rlike("^[0-9]$"), c.cast("int"))


def years_from_days(days: str | Column, digits: int | None = 1) -> Column:
    """Negative day offset → positive years (optionally rounded)."""
    y = -col(days).cast("double") / F.lit(DAYS_PER_YEAR)
    return y if digits is None else round_half_up(y, digits)


def nonnull_count(cols: Sequence[str | Column]) -> Column:
    """Number of non-NULL values across the columns of a row."""
    out = None
    for c in cols:
        term = col(c).isNotNull().cast("int")
        out = term if out is None else out + term
    return out


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Mean of the non-NULL values of a row; NULL when all are NULL."""
    total = None
    for c in cols:
        term = F.coalesce(col(c).cast("double"), F.lit(0.0))
        total = term if total is None else total + term
    return total / F.nullif(nonnull_count(cols).cast("double"), F.lit(0.0))


def capped(c: str | Column, factor: float, cap: float) -> Column:
    """min(c * factor, cap) that keeps NULL as NULL (``least`` would not)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(c * F.lit(factor), F.lit(cap)))


def logistic(x: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str], closed: str = "right") -> Column:
    """Fixed-edge banding.

    ``closed='right'``: (e0, e1], (e1, e2], ... (a value equal to e0 or outside
    the edges gets NULL, like an interval cut). ``closed='left'``: v < e1 → first
    label, v < e2 → second ... with the last label for everything else.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    c = col(c)
    if closed == "right":
        expr = None
        for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
            cond = (c > F.lit(lo)) & (c <= F.lit(hi))
            expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
        return expr
    if closed == "left":
        expr = None
        for hi, lab in zip(edges[1:-1], labels[:-1]):
            cond = c < F.lit(hi)
            expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
        return expr.when(c.isNotNull(), F.lit(labels[-1]))
    raise ValueError(closed)


def text_or_nan(c: str | Column) -> Column:
    """Category as text with a missing value spelled ``nan`` (it forms a segment)."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def present_double(c: str | Column, digits: int = 6) -> Column:
    """Report rounding of a double that is stable across engines.

    Values >= 1 are first cut to 12 significant digits (mantissa rounded in
    DECIMAL, scaled back by an exact DECIMAL power of ten): last-bit noise from
    a different summation order cannot then move a half-way case. Smaller
    values are rounded straight through DECIMAL(38,12). NaN → NULL.
    """
    c = col(c)
    e = F.floor(F.log10(F.abs(c)))
    p = F.pow(F.lit(10.0), e)
    mantissa = F.round((c / p).cast("decimal(38,17)"), 11).cast("decimal(20,11)")
    big = mantissa * p.cast("decimal(17,0)")
    small = c.cast(DECIMAL_FOR_ROUNDING)
    v = F.when(F.isnan(c) | c.isNull(), F.lit(None)).when(c == 0, F.lit(0).cast("decimal(38,12)")) \
        .when((e >= 0) & (e < 17), big).when(e < 0, small)
    return F.when((e >= 17) & ~F.isnan(c), c).otherwise(F.round(v, digits).cast("double"))


def present_sql(name: str, digits: int = 6, exponent: str | None = None) -> str:
    """SQL text of ``present_double`` for one column (parsed JVM-side in one
    call, which keeps plan construction cheap for wide frames). ``exponent``
    names a column already holding floor(log10(|x|))."""
    c = f"`{name}`"
    e = f"`{exponent}`" if exponent else f"floor(log10(abs({c})))"
    p = f"pow(10.0D, {e})"
    big = f"CAST(round(CAST({c} / {p} AS DECIMAL(38,17)), 11) AS DECIMAL(20,11)) * CAST({p} AS DECIMAL(17,0))"
    v = (f"CASE WHEN isnan({c}) OR {c} IS NULL THEN NULL WHEN {c} = 0 THEN CAST(0 AS DECIMAL(38,12)) "
         f"WHEN {e} >= 0 AND {e} < 17 THEN {big} WHEN {e} < 0 THEN CAST({c} AS DECIMAL(38,12)) END")
    return (f"CASE WHEN {e} >= 17 AND NOT isnan({c}) THEN {c} "
            f"ELSE CAST(round({v}, {digits}) AS DOUBLE) END AS `{name}`")


def present(df, digits: int = 6):
    """Round every double column half-up (report presentation; also makes sums
    comparable across engines whose float summation order differs). The
    decimal exponent of each double is computed once in a first projection."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    if not doubles:
        return df
    exps = {n: f"__exp_{i}" for i, n in enumerate(doubles)}
    staged = df.selectExpr("*", *[f"floor(log10(abs(`{n}`))) AS `{e}`" for n, e in exps.items()])
    out = [present_sql(f.name, digits, exps[f.name]) if f.name in exps else f"`{f.name}`" for f in df.schema.fields]
    return staged.selectExpr(*out)

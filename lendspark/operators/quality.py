"""Data-quality operators: missing rates (A20), key contract (S8), dataset
summary (A19) and the per-row confidence level of a scoring request (M37)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the confidence rule.
RARE_NULL_RATE = 0.02     # a NULL is "unexpected" where training had < 2 % NULLs
LOW_CONFIDENCE_COUNT = 30     # more unexpected NULLs than this → low confidence
MEDIUM_CONFIDENCE_COUNT = 8


def missing_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing_rate) in one scan: one aggregate row with a
    NULL share per column, then unpivoted (no per-column job)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "missing_rate")


def key_report(df: DataFrame, key: str, name: str) -> DataFrame:
    """S8 summary: rows and key violations (rows beyond one per distinct key,
    NULL keys included) — 0 means the key is a primary key."""
    return df.agg(
        F.lit(name).alias("name"),
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.countDistinct(key)).alias("key_violations"),
    )


def dataset_summary(df: DataFrame, target: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows, positives, positive rate (and the column count) per group."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(target).cast("long")).alias("positives"),
        F.avg(F.col(target).cast("double")).alias("positive_rate"),
        F.lit(len(df.columns)).alias("columns"),
    )


def confidence(df: DataFrame, checked: Sequence[str]) -> DataFrame:
    """Per-row data-quality level over ``checked`` columns (those rarely NULL
    in training): more than 30 unexpected NULLs → low, more than 8 → medium,
    else high; the unexpected-NULL field names are kept as warnings."""
    if checked:
        flagged = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in checked])
        warnings = F.filter(flagged, lambda x: x.isNotNull())
    else:
        warnings = F.array().cast("array<string>")
    n = F.size("unexpected_nulls")
    return df.withColumn("unexpected_nulls", warnings).withColumn(
        "confidence",
        F.when(n > LOW_CONFIDENCE_COUNT, "low").when(n > MEDIUM_CONFIDENCE_COUNT, "medium").otherwise("high"),
    )

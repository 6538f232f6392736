"""Decision economics.

Approval is strict: ``p < threshold``. A row approved and repaid earns
``amount × margin``; approved and defaulted loses ``amount × LGD``; a rejected
row contributes 0.

The 400-point profit curve never multiplies rows by thresholds: every row is
mapped to the index of the first grid threshold above its score, rows are
aggregated per index (≤ 401 rows per group), and a running sum over that small
table gives every threshold's totals.
"""
from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.exprs import MONEY, money

# Fixed values of the decision model.
MARGIN = 0.12
LGD = 0.65
GRID_START, GRID_STOP, GRID_POINTS = 0.005, 1.0, 400
SENSITIVITY_MARGINS = [0.06, 0.09, 0.12, 0.18, 0.25]
SENSITIVITY_LGDS = [0.45, 0.55, 0.65, 0.75, 0.85]
APPROVE_ALL_THRESHOLD = 1.01
FIXED_THRESHOLD = 0.50


def grid_step(start: float = GRID_START, stop: float = GRID_STOP, points: int = GRID_POINTS) -> float:
    return (stop - start) / (points - 1)


def grid_values(start: float = GRID_START, stop: float = GRID_STOP, points: int = GRID_POINTS) -> np.ndarray:
    return np.linspace(start, stop, points)


def grid_threshold(j: Column, start: float = GRID_START, stop: float = GRID_STOP, points: int = GRID_POINTS) -> Column:
    """Threshold of grid index j, bit-equal to ``numpy.linspace`` (j·step + start,
    last point exactly ``stop``)."""
    return F.when(j == points - 1, F.lit(stop)).otherwise(j.cast("double") * F.lit(grid_step(start, stop, points)) + F.lit(start))


def grid_index(p: Column, start: float = GRID_START, stop: float = GRID_STOP, points: int = GRID_POINTS) -> Column:
    """Number of grid thresholds ≤ p (so the row is approved at grid index j
    iff index ≤ j). Arithmetic estimate, then one exact correction each way."""
    step = grid_step(start, stop, points)
    k0 = F.least(F.greatest(F.floor((p - F.lit(start)) / F.lit(step)) + 1, F.lit(0)), F.lit(points)).cast("int")
    k1 = F.when((k0 < points) & (grid_threshold(k0, start, stop, points) <= p), k0 + 1).otherwise(k0)
    return F.when((k1 > 0) & (grid_threshold(k1 - 1, start, stop, points) > p), k1 - 1).otherwise(k1)


def decision(p: str | Column, threshold: float | Column, approve: str = "approve", reject: str = "reject") -> Column:
    """P20: approve when p < threshold."""
    p = F.col(p) if isinstance(p, str) else p
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(p < t, F.lit(approve)).otherwise(F.lit(reject))


def realised_profit(approved: Column, defaulted: Column, amount: Column, margin: float = MARGIN, lgd: float = LGD) -> Column:
    """Ex-post profit of one application in exact decimal arithmetic
    (cents × rate), rounded half-up to cents."""
    a = amount.cast(MONEY)
    m, l = F.lit(Decimal(repr(margin))), F.lit(Decimal(repr(lgd)))
    v = F.when(approved, F.when(~defaulted, a * m).otherwise(-a * l)).otherwise(F.lit(Decimal("0")))
    return F.round(v, 2).cast("double")


def _index_table(df: DataFrame, groups: Sequence[str], score: str, label: str, amount: str) -> DataFrame:
    y = F.col(label).cast("int")
    a = money(amount)      # exact cents: running sums are order-independent
    return df.groupBy(*groups, grid_index(F.col(score).cast("double")).alias("idx")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(y == 0, 1).otherwise(0)).alias("good"),
        F.sum(F.when(y == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(y == 0, a).otherwise(F.lit(0).cast(MONEY))).alias("amt_good"),
        F.sum(F.when(y == 1, a).otherwise(F.lit(0).cast(MONEY))).alias("amt_bad"),
    )


def threshold_totals(df: DataFrame, groups: Sequence[str], score: str, label: str, amount: str) -> DataFrame:
    """Per group and grid index j: approved counts and amounts at threshold t_j,
    plus the group totals. 400 rows per group."""
    groups = list(groups)
    idx = _index_table(df, groups, score, label, amount)
    totals = idx.groupBy(*groups).agg(*[F.sum(c).alias(f"{c}_total") for c in ("n", "good", "bad")])
    grid = totals.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(GRID_POINTS - 1))))
    joined = grid.join(idx.withColumnRenamed("idx", "j"), [*groups, "j"], "left").fillna(0, ["n", "good", "bad"])
    zero = F.lit(0).cast(MONEY)
    joined = joined.withColumns({"amt_good": F.coalesce("amt_good", zero), "amt_bad": F.coalesce("amt_bad", zero)})
    w_run = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("j").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # idx = j+... : a row with index i is approved at every j >= i; index 400 never.
    return joined.select(
        *groups, "j", grid_threshold(F.col("j")).alias("threshold"),
        "n_total", "good_total", "bad_total",
        F.sum("n").over(w_run).alias("approved"),
        F.sum("good").over(w_run).alias("good_approved"),
        F.sum("bad").over(w_run).alias("bad_approved"),
        F.sum("amt_good").over(w_run).cast("double").alias("amt_good_approved"),
        F.sum("amt_bad").over(w_run).cast("double").alias("amt_bad_approved"),
    )


def _report(t: DataFrame, margin: float, lgd: float) -> list[Column]:
    profit = F.col("amt_good_approved") * F.lit(margin) - F.col("amt_bad_approved") * F.lit(lgd)
    return [
        (F.col("approved") / F.col("n_total")).alias("approval_rate"),
        profit.alias("profit"),
        (profit / F.col("n_total")).alias("profit_per_application"),
        F.col("approved"),
        F.when(F.col("approved") > 0, F.col("bad_approved") / F.col("approved")).otherwise(F.lit(0.0))
        .alias("default_among_approved"),
        (F.col("good_total") - F.col("good_approved")).alias("lost_good"),
        (F.col("bad_total") - F.col("bad_approved")).alias("prevented_bad"),
    ]


def profit_curve(df: DataFrame, groups: Sequence[str], score: str, label: str, amount: str,
                 margin: float = MARGIN, lgd: float = LGD) -> DataFrame:
    """M10 (M9 per grid point): one row per group and threshold."""
    t = threshold_totals(df, groups, score, label, amount)
    return t.select(*groups, "j", "threshold", *_report(t, margin, lgd))


def best_threshold(curve: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The threshold with the highest profit; the first (lowest) wins ties."""
    key = F.struct(F.col("profit"), (-F.col("j")).alias("neg_j"))
    return curve.groupBy(*groups).agg(
        F.max_by("j", key).alias("best_j"),
        F.max_by("threshold", key).alias("best_threshold"),
        F.max("profit").alias("best_profit"),
    )


def profit_at(df: DataFrame, groups: Sequence[str], score: str, label: str, amount: str,
              thresholds: dict[str, Column], margin: float = MARGIN, lgd: float = LGD) -> DataFrame:
    """M9 for several named thresholds (literal or per-group columns) in one
    scan; one output row per group and scenario."""
    y = F.col(label).cast("int")
    a = money(amount)
    zero = F.lit(0).cast(MONEY)
    p = F.col(score).cast("double")
    aggs = [F.count(F.lit(1)).alias("n_total"), F.sum(F.when(y == 0, 1).otherwise(0)).alias("good_total"),
            F.sum(F.when(y == 1, 1).otherwise(0)).alias("bad_total")]
    names = list(thresholds)
    for i, name in enumerate(names):
        ok = p < thresholds[name]
        aggs += [
            F.max(thresholds[name]).alias(f"t{i}"),
            F.sum(F.when(ok, 1).otherwise(0)).alias(f"approved{i}"),
            F.sum(F.when(ok & (y == 0), 1).otherwise(0)).alias(f"good_approved{i}"),
            F.sum(F.when(ok & (y == 1), 1).otherwise(0)).alias(f"bad_approved{i}"),
            F.sum(F.when(ok & (y == 0), a).otherwise(zero)).cast("double").alias(f"amt_good_approved{i}"),
            F.sum(F.when(ok & (y == 1), a).otherwise(zero)).cast("double").alias(f"amt_bad_approved{i}"),
        ]
    wide = df.groupBy(*groups).agg(*aggs)
    per = F.explode(F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.col(f"t{i}").alias("threshold"),
                 *[F.col(f"{c}{i}").alias(c) for c in ("approved", "good_approved", "bad_approved",
                                                       "amt_good_approved", "amt_bad_approved")])
        for i, name in enumerate(names)]))
    long = wide.select(*groups, "n_total", "good_total", "bad_total", per.alias("s")).select(
        *groups, "n_total", "good_total", "bad_total", "s.*")
    return long.select(*groups, "scenario", "threshold", *_report(long, margin, lgd))


def uplift(scenarios: DataFrame, model: str, reference: str) -> DataFrame:
    """From ``profit_at``'s rows (approve_all, fixed_0.50, optimum) one row per model: profit of each, gain of the
    optimum over approving all (also as a share of that profit's size, NULL if it is zero) and over ``reference``'s optimum."""
    of = lambda scenario, c: F.max(F.when(F.col("scenario") == scenario, F.col(c)))
    wide = scenarios.groupBy(model).agg(
        of("approve_all", "profit").alias("profit_approve_all"), of("fixed_0.50", "profit").alias("profit_fixed"),
        of("optimum", "profit").alias("profit_optimum"), of("optimum", "prevented_bad").alias("prevented_bad"),
        of("optimum", "lost_good").alias("lost_good"))
    base = wide.groupBy().agg(F.max(F.when(F.col(model) == reference, F.col("profit_optimum"))).alias("_base"))
    gain = F.col("profit_optimum") - F.col("profit_approve_all")
    return wide.withColumn("_k", F.lit(1)).join(base.withColumn("_k", F.lit(1)), "_k").select(      # one row joined
        *wide.columns, gain.alias("uplift"), F.try_divide(gain, F.abs("profit_approve_all")).alias("uplift_share"),
        (F.col("profit_optimum") - F.col("_base")).alias("gain_over_reference"))


def sensitivity(df: DataFrame, groups: Sequence[str], score: str, label: str, amount: str,
                margins: Sequence[float] = SENSITIVITY_MARGINS, lgds: Sequence[float] = SENSITIVITY_LGDS) -> DataFrame:
    """Best threshold and its approval rate for every (margin, LGD) pair,
    re-using one threshold table (400 rows per group)."""
    groups = list(groups)
    t = threshold_totals(df, groups, score, label, amount)
    combos = F.array(*[F.struct(F.lit(m).alias("margin"), F.lit(l).alias("lgd")) for m in margins for l in lgds])
    x = t.withColumn("c", F.explode(combos)).select("*", "c.margin", "c.lgd").drop("c")
    x = x.withColumn("profit", F.col("amt_good_approved") * F.col("margin") - F.col("amt_bad_approved") * F.col("lgd"))
    key = F.struct(F.col("profit"), (-F.col("j")).alias("neg_j"))
    return x.groupBy(*groups, "margin", "lgd").agg(
        F.max_by("threshold", key).alias("best_threshold"),
        F.max_by(F.col("approved") / F.col("n_total"), key).alias("approval_rate"),
    )

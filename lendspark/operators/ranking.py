"""Ranking and calibration metrics (M1–M8) from one score histogram.

Raw rows are reduced once to (group, score) → (positives, negatives, squared
error); every metric is then a sum or max over that histogram, with the
running totals of ``cumulative_below``. Ties are exact (mid-rank AUC, one ROC
point per distinct score).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.exprs import round_half_up
from lendspark.operators.histogram import attach_edges, cumulative_below, exact_quantiles, qcut_index, quantile_edges


def score_histogram(df: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    s, y = F.col(score).cast("double"), F.col(label).cast("long")
    return df.where(s.isNotNull()).groupBy(*groups, s.alias("_s")).agg(
        F.sum(y).alias("pos"),
        F.sum(F.lit(1) - y).alias("neg"),
        F.sum((s - y) * (s - y)).alias("_sq"),
    )


def ranking_metrics(df: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    """M6: per group auc, gini, ks, pr_auc (step-wise average precision),
    brier (NULL unless every score is in [0, 1]), n, default_rate."""
    groups = list(groups)
    cum = cumulative_below(score_histogram(df, groups, score, label), groups, "_s", ["pos", "neg"])
    P, N = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    pos_ge = F.col("pos_total") - F.col("pos_below")
    neg_ge = F.col("neg_total") - F.col("neg_below")
    terms = cum.select(
        *groups, "_s", "_sq", "pos", "neg", "pos_total", "neg_total",
        (F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("_auc"),
        (pos_ge / P - neg_ge / N).alias("_ks"),
        (F.col("pos") / P * pos_ge / (pos_ge + neg_ge)).alias("_ap"),
    )
    agg = terms.groupBy(*groups).agg(
        (F.sum("_auc") / (F.max("pos_total").cast("double") * F.max("neg_total").cast("double"))).alias("auc"),
        F.greatest(F.max("_ks"), F.lit(0.0)).alias("ks"),
        F.sum("_ap").alias("pr_auc"),
        F.when((F.min("_s") >= 0) & (F.max("_s") <= 1),
               F.sum("_sq") / (F.sum("pos") + F.sum("neg"))).alias("brier"),
        (F.sum("pos") + F.sum("neg")).alias("n"),
        (F.sum("pos") / (F.sum("pos") + F.sum("neg"))).alias("default_rate"),
    )
    return agg.select(*groups, "auc", (2 * F.col("auc") - 1).alias("gini"), "ks", "pr_auc", "brier", "n", "default_rate")


def lift_table(df: DataFrame, groups: Sequence[str], score: str, label: str, n_bins: int = 10) -> DataFrame:
    """M7: equal-frequency score buckets (interpolated quantile edges, duplicate
    edges dropped, right-closed): customers, defaults, rate %, lift, mean score.
    Rows without a score are in no bucket."""
    groups = list(groups)
    df = df.where(F.col(score).isNotNull())
    edges = quantile_edges(df, score, n_bins, groups)
    d = attach_edges(df, edges, groups).withColumn("bucket", qcut_index(score, "edges") - 1)
    overall = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    per = d.groupBy(*groups, "bucket").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col(label).cast("long")).alias("defaults"),
        F.avg(F.col(label).cast("double")).alias("_rate"),
        F.avg(F.col(score).cast("double")).alias("mean_score"),
    )
    base = F.sum("defaults").over(overall) / F.sum("customers").over(overall)
    return per.select(
        *groups, "bucket", "customers", "defaults",
        round_half_up(F.col("_rate") * 100, 2).alias("rate_pct"),
        round_half_up(F.col("_rate") / base, 2).alias("lift"),
        "mean_score",
    )


def calibration_curve(df: DataFrame, groups: Sequence[str], score: str, label: str, n_bins: int = 12) -> DataFrame:
    """M8: quantile calibration bins (edges at interpolated percentiles, kept
    with duplicates; inner edges right-closed; empty bins dropped): per bin the
    mean prediction, observed rate and their absolute gap, plus the mean and
    max gap of the group. Rows without a score are in no bin."""
    groups = list(groups)
    df = df.where(F.col(score).isNotNull())
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(df, score, probs, groups)
    edges = q.groupBy(*groups).agg(F.array_sort(F.collect_list("quantile")).alias("edges"))
    d = attach_edges(df, edges, groups)
    inner = F.slice(F.col("edges"), 2, n_bins - 1)
    d = d.withColumn("bin", F.size(F.filter(inner, lambda e: e < F.col(score))))
    per = d.groupBy(*groups, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(score).cast("double")).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    ).withColumn("abs_gap", F.abs(F.col("mean_predicted") - F.col("observed_rate")))
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return per.withColumns({"mean_abs_gap": F.avg("abs_gap").over(w), "max_abs_gap": F.max("abs_gap").over(w)})


def auc_only(df: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    return ranking_metrics(df, groups, score, label).select(*groups, "auc")

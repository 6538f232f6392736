"""Population stability (M13–M15) and what-if stress scenarios.

PSI: edges are the distinct interpolated deciles of the *reference*
distribution; the outer edges become ±inf; bins are left-closed; both shares
are floored at 1e-6; PSI = Σ (new − ref) · ln(new / ref). Fewer than 3
distinct edges → 0; an empty side → NULL (not computable). All bins of the
edge set take part, also those empty on both sides.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.exprs import capped, row_mean, safe_div
from lendspark.operators.histogram import quantile_edges
from lendspark.operators.ranking import ranking_metrics

# Fixed values of the drift rule.
SHARE_FLOOR = 1e-6
WATCH_LEVEL = 0.10
REVIEW_LEVEL = 0.25


def verdict(psi: str | Column) -> Column:
    """<0.10 no shift, <0.25 moderate (watch), else serious (review)."""
    v = F.col(psi) if isinstance(psi, str) else psi
    return (F.when(v.isNull(), F.lit("not computable"))
            .when(v < WATCH_LEVEL, F.lit("no shift"))
            .when(v < REVIEW_LEVEL, F.lit("moderate - watch"))
            .otherwise(F.lit("serious - review")))


def _clean(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v))


def psi(reference: DataFrame, new: DataFrame, value: str, groups: Sequence[str] = (), n_bins: int = 10,
        by: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """M13 per group: rows (groups..., psi, n_edges, verdict). ``reference`` and
    ``new`` both carry ``groups`` and ``value``. Without groups a constant key
    is used, so every step stays an equi-join.

    ``by`` names a further column of ``new`` with the values ``names`` (scenarios), each held against the same reference:
    its edges and counts are taken once and only those small tables are repeated."""
    groups = list(groups)
    keyless = not groups
    if keyless:
        reference, new, groups = reference.withColumn("_all", F.lit(0)), new.withColumn("_all", F.lit(0)), ["_all"]
    keys = [*groups, by] if by else groups
    ref = _clean(reference, value)
    cur = _clean(new, value)
    # one row per group: (edges, n_edges) — bounded by the number of groups
    e = quantile_edges(ref, value, n_bins, groups).select(*groups, "edges", F.size("edges").alias("n_edges"))
    inner = F.slice(F.col("edges"), 2, F.greatest(F.col("n_edges") - 2, F.lit(0)))

    def binned(df: DataFrame, tag: str, by_keys: list[str]) -> DataFrame:
        return (df.join(F.broadcast(e), groups, "inner")
                .select(*by_keys, F.size(F.filter(inner, lambda x: x <= F.col(value).cast("double"))).alias("bin"))
                .groupBy(*by_keys, "bin").agg(F.count(F.lit(1)).alias(tag)))

    def spread(small: DataFrame) -> DataFrame:
        return small.withColumn(by, F.explode(F.array(*[F.lit(n) for n in names]))) if by else small

    sizes = (spread(ref.groupBy(*groups).agg(F.count(F.lit(1)).alias("r_n")))
             .join(cur.groupBy(*keys).agg(F.count(F.lit(1)).alias("y_n")), keys, "full"))
    all_bins = spread(e.where(F.col("n_edges") >= 3).select(
        *groups, F.explode(F.sequence(F.lit(0), F.col("n_edges") - 2)).alias("bin")))
    full = (all_bins.join(spread(binned(ref, "r", groups)), [*keys, "bin"], "left")
            .join(binned(cur, "y", keys), [*keys, "bin"], "left").join(sizes, keys, "left"))
    rs = F.greatest(F.coalesce(F.col("r"), F.lit(0)) / F.col("r_n"), F.lit(SHARE_FLOOR))
    ys = F.greatest(F.coalesce(F.col("y"), F.lit(0)) / F.col("y_n"), F.lit(SHARE_FLOOR))
    per = full.groupBy(*keys).agg(F.sum((ys - rs) * F.log(ys / rs)).alias("psi_sum"))
    out = sizes.join(e.select(*groups, "n_edges"), groups, "left").join(per, keys, "left")
    value_col = (F.when(F.col("y_n").isNull() | F.col("r_n").isNull(), F.lit(None).cast("double"))
                 .when(F.col("n_edges") < 3, F.lit(0.0)).otherwise(F.col("psi_sum")))
    res = out.select(*keys, value_col.alias("psi"), F.coalesce("n_edges", F.lit(0)).alias("n_edges"))
    res = res.withColumn("verdict", verdict("psi"))
    return res.drop("_all") if keyless else res


# --- P24 scenarios -----------------------------------------------------------------

# Fixed scenario parameters: income, utilisation, delinquency, external-score factors.
SCENARIOS = {
    "mild_recession": {"income": 0.90, "utilisation": 1.15, "delinquency": 1.30, "score": 0.94},
    "severe_recession": {"income": 0.75, "utilisation": 1.40, "delinquency": 2.00, "score": 0.82},
}
YOUNG_BIRTH_FACTOR = 0.75
YOUNG_EMPLOYED_FACTOR = 0.5
UTILISATION_CAP = 3.0
RATIO_CAP = 1.0
UTILISATION_COLUMNS = ["cc_utilization_avg", "cc_utilization_avg_1y", "cc_utilization_max"]
DELINQUENCY_COLUMNS = ["inst_late_ratio", "inst_late_ratio_1y", "pos_dpd_ratio", "bb_dpd_ratio"]
EXT = ["ext_source_1", "ext_source_2", "ext_source_3"]


def apply_scenario(df: DataFrame, name: str) -> DataFrame:
    """Stress a model-input frame and recompute the dependent columns.
    Caps keep NULL as NULL. ``baseline`` (or unknown) returns the frame as is.
    The young-customer campaign keeps the employment sentinel and, as in the
    original, leaves ``employed_life_ratio`` unchanged."""
    cols = set(df.columns)
    if name == "young_customers":
        sentinel = F.col("days_employed") == 365243
        d = df.withColumn("days_birth", F.col("days_birth") * F.lit(YOUNG_BIRTH_FACTOR))
        d = d.withColumn("age_years", -F.col("days_birth") / F.lit(365.25))
        d = d.withColumn("days_employed", F.when(sentinel, F.col("days_employed").cast("double"))
                         .otherwise(F.col("days_employed") * F.lit(YOUNG_EMPLOYED_FACTOR)))
        return d.withColumn("employed_years", F.when(F.col("days_employed") == 365243, F.lit(None))
                            .otherwise(-F.col("days_employed") / F.lit(365.25)))
    if name not in SCENARIOS:
        return df
    s = SCENARIOS[name]
    d = df.withColumn("amt_income_total", F.col("amt_income_total") * F.lit(s["income"]))
    ext = [c for c in EXT if c in cols]
    d = d.withColumns({c: F.col(c) * F.lit(s["score"]) for c in ext})
    if ext:
        d = d.withColumns({
            "ext_source_mean": row_mean(ext),
            "ext_source_min": F.least(*[F.col(c) for c in ext]),
            "ext_source_max": F.greatest(*[F.col(c) for c in ext]),
        })
    d = d.withColumns({c: capped(c, s["utilisation"], UTILISATION_CAP) for c in UTILISATION_COLUMNS if c in cols})
    d = d.withColumns({c: capped(c, s["delinquency"], RATIO_CAP) for c in DELINQUENCY_COLUMNS if c in cols})
    d = d.withColumns({
        "credit_income_ratio": safe_div("amt_credit", "amt_income_total"),
        "annuity_income_ratio": safe_div("amt_annuity", "amt_income_total"),
    })
    if "income_per_person" in cols:
        d = d.withColumn("income_per_person", safe_div("amt_income_total", "cnt_fam_members"))
    return d


def stressed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame under each scenario, one below the other, with its name in ``scenario``. Column types that a stress
    changes follow the wider one."""
    out = None
    for name in names:
        d = apply_scenario(df, name).withColumn("scenario", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def feature_psi(reference: DataFrame, new: DataFrame, features: Sequence[str], groups: Sequence[str] = (),
                n_bins: int = 10, by: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """PSI of every monitored feature at once (long form, grouped by feature), for each value of ``by`` if given."""
    groups = list(groups)

    def long(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
            keys, list(features), "feature", "value")

    return psi(long(reference, groups), long(new, [*groups, by] if by else groups), "value", [*groups, "feature"], n_bins, by, names)


MOST_SHIFTED = 4


def drift_report(reference: DataFrame, new: DataFrame, names: Sequence[str], score: str, label: str,
                 features: Sequence[str], most: int = MOST_SHIFTED) -> DataFrame:
    """One row per scenario of ``new``, held against ``reference`` (scored training rows): PSI of the score with its
    verdict, AUC and Gini, mean prediction beside the observed default rate, and the ``most`` features of largest PSI,
    largest first. A scenario without rows has a NULL PSI and no metrics; PSIs that are not computable come last."""
    s = psi(reference.select(F.col(score).alias("value")), new.select("scenario", F.col(score).alias("value")), "value",
            by="scenario", names=names).select("scenario", F.col("psi").alias("score_psi"), "verdict")
    metrics = ranking_metrics(new, ["scenario"], score, label).select("scenario", "auc", "gini", "default_rate")
    mean = new.groupBy("scenario").agg(F.avg(score).alias("mean_prediction"), F.count(F.lit(1)).alias("applications"))
    out = s.join(metrics, "scenario", "left").join(mean, "scenario", "left")          # a row per scenario each
    if not features:
        return out.withColumn("most_shifted", F.array().cast("array<struct<feature:string,psi:double,verdict:string>>"))
    shifts = feature_psi(reference, new, features, by="scenario", names=names)
    order = F.struct((-F.coalesce("psi", F.lit(-1.0))).alias("o"), "feature", "psi", "verdict")
    top = shifts.groupBy("scenario").agg(F.slice(F.array_sort(F.collect_list(order)), 1, most).alias("t")).select(
        "scenario", F.transform("t", lambda x: F.struct(x["feature"].alias("feature"), x["psi"].alias("psi"),
                                                        x["verdict"].alias("verdict"))).alias("most_shifted"))
    return out.join(top, "scenario", "left")

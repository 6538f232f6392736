"""Fairness, policy cost, feature drift, stress scenarios and monotonic bands
(A21–A23, M36, M15, P24, M40) with their oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.operators import fairness as fair
from lendspark.operators import features as feat
from lendspark.operators import profit as prof
from lendspark.operators import psi as psi_ops
from lendspark.operators import ranking
from lendspark.operators.histogram import attach_edges, qcut_index, quantile_edges
from lendspark.operators.split import stratified_split
from lendspark.plans import q_scoring as qs
from lendspark.plans.artefacts import published
from lendspark.plans.oracle import fx
from lendspark.plans.q_features import stored_model_input, sql_model_input_body, sql_ratios_select
from lendspark.plans.registry import query
from lendspark.sources import fixtures

AUDIT_MODEL, COMPLIANT_MODEL = "p_a", "p_b"
MONOTONIC_FEATURES = ["ext_source_mean", "inst_late_ratio", "prev_refused_ratio", "bureau_debt_ratio", "cc_utilization_avg"]


def test_with_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of both models with each model's validation-optimal threshold
    and the applicant attributes of the monitored dimensions."""
    long = qs.scored_long(spark, sf_dir)
    curve = prof.profit_curve(long.where(F.col("split") == "validation"), ["model"], "score", "target", "amt_credit")
    best = prof.best_threshold(curve, ["model"]).select("model", "best_threshold")      # one row per model
    app = feat.row_ratios(fixtures.load(spark, sf_dir, "application")).select(
        "sk_id_curr", *fair.MONITORED[:2], "age_years", "region_rating_client_w_city")
    t = long.where(F.col("split") == "test").join(F.broadcast(best), "model").join(app, "sk_id_curr", "left")
    return t.withColumn("approved", F.col("score") < F.col("best_threshold"))


def fairness_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair.long_groups(test_with_optimum(spark, sf_dir), ["model", "target", "approved"])


def sql_fairness_ctes() -> str:
    from lendspark.plans.q_scoring import _sql_best, sql_curve, sql_grid, sql_split_ctes

    def age(v: str) -> str:
        parts = " ".join(f"WHEN {v} > {lo} AND {v} <= {hi} THEN '{lab}'" for lo, hi, lab in
                         zip(fair.FAIR_AGE_EDGES[:-1], fair.FAIR_AGE_EDGES[1:], fair.FAIR_AGE_LABELS))
        return f"CASE {parts} ELSE 'nan' END"

    return (sql_split_ctes() + ",\n" + sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
            + sql_curve("valid", "model") + ",\n" + _sql_best() + ",\n" + fx("fx_application")[len("WITH "):] + f""",
app AS (SELECT {sql_ratios_select()} FROM fx_application a),
t AS (
  SELECT l.model, l.target, l.score < b.best_threshold AS approved, a.code_gender, a.name_family_status, a.age_years,
         a.region_rating_client_w_city
  FROM long l JOIN best b USING (model) LEFT JOIN app a USING (sk_id_curr) WHERE l.split = 'test'
),
fl AS (
  SELECT model, target, approved, 'code_gender' AS dimension, coalesce(code_gender, 'nan') AS grp FROM t
  UNION ALL SELECT model, target, approved, 'name_family_status', coalesce(name_family_status, 'nan') FROM t
  UNION ALL SELECT model, target, approved, 'age_years', {age('age_years')} FROM t
  UNION ALL SELECT model, target, approved, 'region_rating_client_w_city',
    CASE WHEN region_rating_client_w_city IS NULL THEN 'nan' ELSE 'region ' || CAST(region_rating_client_w_city AS VARCHAR) END FROM t
),
gm AS (
  SELECT model, dimension, grp, count(*) AS applications, avg(CAST(approved AS DOUBLE)) AS approval_rate,
    avg(CAST(target AS DOUBLE)) AS actual_default,
    1.0 - avg(CASE WHEN target = 0 THEN CAST(approved AS DOUBLE) END) AS good_rejection_rate,
    1.0 - avg(CASE WHEN target = 1 THEN CAST(approved AS DOUBLE) END) AS bad_rejection_rate,
    avg(CASE WHEN approved THEN CAST(target AS DOUBLE) END) AS default_among_approved
  FROM fl GROUP BY model, dimension, grp
),
gaps AS (
  SELECT model, dimension,
    CASE WHEN count(*) >= 2 THEN max(good_rejection_rate) - min(good_rejection_rate) END AS eo_gap,
    CASE WHEN count(*) >= 2 THEN max(approval_rate) - min(approval_rate) END AS dp_gap,
    CASE WHEN count(*) >= 2 THEN max(default_among_approved) - min(default_among_approved) END AS pp_gap
  FROM gm WHERE applications >= {fair.MIN_GROUP} GROUP BY model, dimension
)""")


@query("fairness_by_group", "A21,P17", sql=lambda: sql_fairness_ctes() + "\nSELECT * FROM gm")
def q_fair_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair.group_metrics(fairness_long(spark, sf_dir), ["model", "dimension", "grp"], "approved", "target")


@query("fairness_gaps", "A22", sql=lambda: sql_fairness_ctes() + "\nSELECT * FROM gaps")
def q_fair_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fair.group_metrics(fairness_long(spark, sf_dir), ["model", "dimension", "grp"], "approved", "target")
    return fair.gaps(m, ["model", "dimension"])


@query("fairness_before_after", "A23", sql=lambda: sql_fairness_ctes() + f"""
SELECT dimension,
  max(CASE WHEN model = '{AUDIT_MODEL}' THEN eo_gap END) AS eo_before, max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN eo_gap END) AS eo_after,
  max(CASE WHEN model = '{AUDIT_MODEL}' THEN dp_gap END) AS dp_before, max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN dp_gap END) AS dp_after,
  max(CASE WHEN model = '{AUDIT_MODEL}' THEN pp_gap END) AS pp_before, max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN pp_gap END) AS pp_after,
  max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN eo_gap END) < max(CASE WHEN model = '{AUDIT_MODEL}' THEN eo_gap END) AS eo_improved
FROM gaps GROUP BY dimension""")
def q_fair_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fair.group_metrics(fairness_long(spark, sf_dir), ["model", "dimension", "grp"], "approved", "target")
    return fair.before_after(fair.gaps(m, ["model", "dimension"]), "model", AUDIT_MODEL, COMPLIANT_MODEL)


@query("policy_cost", "M36", sql=lambda: qs.sql_split_ctes() + ",\n" + qs.sql_ranking("model", "(SELECT * FROM long WHERE split = 'validation')")
       + ",\n" + qs.sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
       + qs.sql_curve("valid", "model").replace("tot AS", "tot AS", 1) + ",\n" + qs._sql_best() + f""",
prof AS (
  SELECT model, CAST(sum(CASE WHEN score < best_threshold AND target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) * CAST('{prof.MARGIN!r}' AS DOUBLE)
              - CAST(sum(CASE WHEN score < best_threshold AND target = 1 THEN CAST(amt_credit AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) * CAST('{prof.LGD!r}' AS DOUBLE) AS profit
  FROM long JOIN best USING (model) WHERE split = 'test' GROUP BY model
),
m AS (SELECT metrics.*, 2 * auc - 1 AS gini, prof.profit FROM metrics JOIN prof USING (model)),
lm AS (UNPIVOT m ON auc, gini, ks, pr_auc, brier, profit INTO NAME metric VALUE v)
SELECT metric, max(CASE WHEN model = '{AUDIT_MODEL}' THEN v END) AS audit, max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN v END) AS compliant,
  max(CASE WHEN model = '{AUDIT_MODEL}' THEN v END) - max(CASE WHEN model = '{COMPLIANT_MODEL}' THEN v END) AS delta
FROM lm GROUP BY metric""")
def q_policy_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the compliant model costs against the audit model — ranking
    metrics on validation and realised profit at each model's optimum on test."""
    long = qs.scored_long(spark, sf_dir)
    valid = long.where(F.col("split") == "validation")
    m = ranking.ranking_metrics(valid, ["model"], "score", "target")
    curve = prof.profit_curve(valid, ["model"], "score", "target", "amt_credit")
    best = prof.best_threshold(curve, ["model"]).select("model", "best_threshold")
    test = long.where(F.col("split") == "test").join(F.broadcast(best), "model")
    p = prof.profit_at(test, ["model"], "score", "target", "amt_credit", {"optimum": F.col("best_threshold")})
    wide = m.join(p.select("model", "profit"), "model")
    metrics = ["auc", "gini", "ks", "pr_auc", "brier", "profit"]
    lm = wide.unpivot(["model"], metrics, "metric", "v")
    out = lm.groupBy("metric").agg(
        F.max(F.when(F.col("model") == AUDIT_MODEL, F.col("v"))).alias("audit"),
        F.max(F.when(F.col("model") == COMPLIANT_MODEL, F.col("v"))).alias("compliant"),
    )
    return out.withColumn("delta", F.col("audit") - F.col("compliant"))


def customer_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input with its split, published once. The cut values come from the applications' ids and labels alone."""
    def build() -> DataFrame:
        keys = fixtures.load(spark, sf_dir, "application").select("sk_id_curr", "target")
        return stratified_split(stored_model_input(spark, sf_dir), "sk_id_curr", "target", keys=keys)

    return published(spark, sf_dir, "customer_split", build, key="sk_id_curr")


def sql_customer_split() -> str:
    return sql_model_input_body() + """,
msplit AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk < round(n * CAST(0.2 AS DOUBLE)) THEN 'test'
    WHEN rk < round(n * CAST(0.4 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(sk_id_curr AS VARCHAR)), sk_id_curr) - 1 AS rk,
               count(*) OVER (PARTITION BY target) AS n FROM model_input)
)"""


def _features_sql(alias: str = "") -> str:
    return ", ".join(f"CAST({alias}{f} AS DOUBLE) AS {f}" for f in qs.PSI_FEATURES)


@query("feature_psi", "M15", sql=lambda: sql_customer_split() + f""",
r_src AS (UNPIVOT (SELECT {_features_sql()} FROM msplit WHERE split = 'train') ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
n_src AS (UNPIVOT (SELECT {_features_sql()} FROM msplit WHERE split = 'test') ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
""" + qs.sql_psi("r_src", "n_src", "feature") + f"\nSELECT feature, psi, CAST(n_edges AS INTEGER) AS n_edges, {qs.sql_verdict()} AS verdict FROM psi_out")
def q_feature_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = customer_split(spark, sf_dir)
    return psi_ops.feature_psi(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"), qs.PSI_FEATURES)


def _scenario_sql(name: str, source: str = "model_input") -> str:
    """PSI features of ``source`` under one scenario (oracle text)."""
    base = {f: f"CAST({f} AS DOUBLE)" for f in qs.PSI_FEATURES}
    if name == "young_customers":
        base["age_years"] = f"-(days_birth * CAST('{psi_ops.YOUNG_BIRTH_FACTOR!r}' AS DOUBLE)) / CAST('365.25' AS DOUBLE)"
    elif name in psi_ops.SCENARIOS:
        s = psi_ops.SCENARIOS[name]
        lit = lambda v: f"CAST('{v!r}' AS DOUBLE)"
        inc = f"(amt_income_total * {lit(s['income'])})"
        base["amt_income_total"] = inc
        base["credit_income_ratio"] = f"CAST(amt_credit AS DOUBLE) / NULLIF({inc}, 0)"
        base["annuity_income_ratio"] = f"CAST(amt_annuity AS DOUBLE) / NULLIF({inc}, 0)"
        ext = [f"(ext_source_{i} * {lit(s['score'])})" for i in (1, 2, 3)]
        for i, e in zip((1, 2, 3), ext):
            base[f"ext_source_{i}"] = e
        n = " + ".join(f"CAST({e} IS NOT NULL AS INTEGER)" for e in ext)
        tot = " + ".join(f"coalesce({e}, 0.0)" for e in ext)
        base["ext_source_mean"] = f"({tot}) / NULLIF(CAST(({n}) AS DOUBLE), 0)"
        for c in ("inst_late_ratio", "bb_dpd_ratio"):
            base[c] = f"CASE WHEN {c} IS NOT NULL THEN least({c} * {lit(s['delinquency'])}, CAST('1.0' AS DOUBLE)) END"
        base["cc_utilization_avg"] = (f"CASE WHEN cc_utilization_avg IS NOT NULL THEN least(cc_utilization_avg * "
                                      f"{lit(s['utilisation'])}, CAST('3.0' AS DOUBLE)) END")
    cols = ", ".join(f"{v} AS {k}" for k, v in base.items())
    return f"SELECT '{name}' AS scenario, {cols} FROM {source}"


@query("scenario_shift", "P24,M15", sql=lambda: sql_model_input_body() + ",\nscen AS (\n" + "\n  UNION ALL ".join(
    _scenario_sql(n) for n in qs.SCENARIO_NAMES) + f"""
),
r_src AS (UNPIVOT (SELECT * FROM scen WHERE scenario = 'baseline') ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
r_all AS (SELECT s.scenario, r.feature, r.value FROM r_src r, (SELECT DISTINCT scenario FROM scen) s),
n_src AS (UNPIVOT scen ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
""" + qs.sql_psi("r_all", "n_src", "scenario, feature") + f"\nSELECT scenario, feature, psi, CAST(n_edges AS INTEGER) AS n_edges, {qs.sql_verdict()} AS verdict FROM psi_out")
def q_scenario_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24 + M15: per stress scenario, PSI of each monitored feature against the
    unstressed frame, whose edges and counts are taken once."""
    mi = stored_model_input(spark, sf_dir)
    return psi_ops.feature_psi(mi, psi_ops.stressed(mi, qs.SCENARIO_NAMES), qs.PSI_FEATURES, by="scenario", names=qs.SCENARIO_NAMES)


@query("scenario_drift", "P24,M15", sql=lambda: sql_customer_split() + ",\nscen AS (\n" + "\n  UNION ALL ".join(
    _scenario_sql(n, "msplit WHERE split = 'test'") for n in qs.SCENARIO_NAMES) + f"""
),
r_src AS (UNPIVOT (SELECT {_features_sql()} FROM msplit WHERE split = 'train') ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
r_all AS (SELECT s.scenario, r.feature, r.value FROM r_src r, (SELECT DISTINCT scenario FROM scen) s),
n_src AS (UNPIVOT scen ON {', '.join(qs.PSI_FEATURES)} INTO NAME feature VALUE value),
""" + qs.sql_psi("r_all", "n_src", "scenario, feature") + f"""
SELECT scenario, feature, psi, {qs.sql_verdict()} AS verdict,
  CAST(row_number() OVER (PARTITION BY scenario ORDER BY round(coalesce(psi, -1.0), 9) DESC, feature) AS INTEGER) AS shift_rank FROM psi_out""")
def q_scenario_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stressed test customers against training customers: PSI of each monitored feature, most shifted first."""
    s = customer_split(spark, sf_dir)
    test = psi_ops.stressed(s.where(F.col("split") == "test"), qs.SCENARIO_NAMES)
    d = psi_ops.feature_psi(s.where(F.col("split") == "train"), test, qs.PSI_FEATURES, by="scenario", names=qs.SCENARIO_NAMES)
    # a window over features: one row a feature and scenario
    w = Window.partitionBy("scenario").orderBy(F.desc(F.round(F.coalesce("psi", F.lit(-1.0)), 9)), "feature")
    return d.select("scenario", "feature", "psi", "verdict", F.row_number().over(w).alias("shift_rank"))


def monotonic_bands(df: DataFrame, features: list[str], label: str, n_bins: int = 5) -> DataFrame:
    """Per feature, equal-frequency bands (right-closed, duplicate edges
    dropped) with customers and default rate; NULL forms band 0 ('no history')."""
    long = df.select(F.col(label).alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        ["_y"], features, "feature", "value")
    edges = quantile_edges(long, "value", n_bins, ["feature"])          # one row per feature
    d = attach_edges(long, edges, ["feature"])
    d = d.withColumn("band", F.when(F.col("value").isNull(), F.lit(0)).otherwise(qcut_index("value", "edges")))
    return d.groupBy("feature", "band").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(F.col("_y").cast("double")).alias("default_rate"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


@query("monotonic_bands", "M40", sql=lambda: sql_model_input_body() + f""",
mf AS (SELECT target, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in MONOTONIC_FEATURES)} FROM model_input),
lf AS (SELECT * FROM mf UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(MONOTONIC_FEATURES)}))),
{qs.sql_quantiles('lf', 'value', 'feature', qs.deciles(5), 'e')},
b AS (SELECT lf.*, CASE WHEN value IS NULL THEN 0 ELSE CAST({qs.sql_qcut('value')} AS INTEGER) END AS band FROM lf LEFT JOIN e USING (feature))
SELECT feature, band, count(*) AS customers, avg(CAST(target AS DOUBLE)) AS default_rate, min(value) AS min_value, max(value) AS max_value
FROM b GROUP BY feature, band""")
def q_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monotonic_bands(stored_model_input(spark, sf_dir), MONOTONIC_FEATURES, "target")

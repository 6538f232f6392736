"""Split, scored portfolio, monitoring views, ranking metrics, profit and drift
queries over the scored stand-in (``fx_scored``: two model scores p_a, p_b per
application) — with their oracle SQL."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.operators import features as feat
from lendspark.operators import monitoring as mon
from lendspark.operators import profit as prof
from lendspark.operators import psi as psi_ops
from lendspark.operators import quality
from lendspark.operators import ranking
from lendspark.operators.histogram import exact_quantiles
from lendspark.operators.split import stratified_split
from lendspark.plans.artefacts import artefact, published
from lendspark.plans.oracle import fx, r
from lendspark.plans.registry import query
from lendspark.sources import fixtures
from lendspark.sources.versions import MissingArtefact, VersionedTable

MODELS = ["p_a", "p_b"]
PORTFOLIO_MODEL = "p_b"
PSI_FEATURES = ["amt_income_total", "credit_income_ratio", "annuity_income_ratio", "ext_source_1", "ext_source_2",
                "ext_source_3", "ext_source_mean", "age_years", "inst_late_ratio", "bb_dpd_ratio",
                "cc_utilization_avg", "prev_refused_ratio"]
SCENARIO_NAMES = ["baseline", "young_customers", "mild_recession", "severe_recession"]
REPLICATES_Q = 2000          # bootstrap replicates, as in the reference


def scored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored applications with their split, published once."""
    return published(spark, sf_dir, "scored_split", lambda: stratified_split(fixtures.load(spark, sf_dir, "scored"), "id", "target"),
                     contracts={"every row has a split": "count_if(split IS NULL) = 0"})


def scored_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, sk_id_curr, target, amt_credit, split, model, score): one row per
    application and model (unpivot, no self-union scans)."""
    s = scored_split(spark, sf_dir)
    return s.unpivot(["id", "sk_id_curr", "target", "amt_credit", "split"], MODELS, "model", "score")


def policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision policy, published once: each model's cut-off, chosen on validation rows for the highest profit."""
    def build() -> DataFrame:
        valid = scored_long(spark, sf_dir).where(F.col("split") == "validation")
        return prof.best_threshold(prof.profit_curve(valid, ["model"], "score", "target", "amt_credit"), ["model"])

    return published(spark, sf_dir, "policy", build, key="model", contracts={
        "cut-offs lie in (0, 1]": "count_if(best_threshold IS NULL OR best_threshold <= 0 OR best_threshold > 1) = 0"})


def threshold(spark: SparkSession, sf_dir: str, model: str) -> float:
    """A model's published cut-off; none is an error."""
    row = policy(spark, sf_dir).where(F.col("model") == model).first()
    if row is None:
        raise MissingArtefact(f"no cut-off is published for {model}")
    return row["best_threshold"]


#: What every version of the portfolio must fulfil.
PORTFOLIO_CONTRACTS = {
    "probabilities lie in [0, 1]": "count_if(probability IS NULL OR probability NOT BETWEEN 0 AND 1) = 0",
    "every row is decided": "count_if(decision IS NULL OR split IS NULL) = 0",
    "rejected rows earn nothing": f"count_if(decision = '{mon.REJECT}' AND realised_profit <> 0) = 0",
}


def build_portfolio(spark: SparkSession, sf_dir: str, cut: float) -> DataFrame:
    applicants = feat.row_ratios(fixtures.load(spark, sf_dir, "application"))
    return mon.scored_portfolio(scored_split(spark, sf_dir), applicants, PORTFOLIO_MODEL, cut)


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published portfolio (M39): all views scan its current version."""
    return published(spark, sf_dir, "portfolio", lambda: build_portfolio(spark, sf_dir, threshold(spark, sf_dir, PORTFOLIO_MODEL)),
                     key="id", contracts=PORTFOLIO_CONTRACTS)


# --- oracle building blocks ------------------------------------------------------

def sql_split_ctes() -> str:
    return fx("fx_scored") + """,
split AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk < round(n * CAST(0.2 AS DOUBLE)) THEN 'test'
    WHEN rk < round(n * CAST(0.4 AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS rk,
               count(*) OVER (PARTITION BY target) AS n FROM fx_scored)
),
long AS (
  SELECT id, sk_id_curr, target, amt_credit, split, 'p_a' AS model, p_a AS score FROM split
  UNION ALL
  SELECT id, sk_id_curr, target, amt_credit, split, 'p_b' AS model, p_b AS score FROM split
)"""


def sql_ranking(groups: str, source: str = "long") -> str:
    g = groups
    return f"""hist AS (
  SELECT {g}, score, CAST(sum(target) AS DOUBLE) AS pos, CAST(sum(1 - target) AS DOUBLE) AS neg,
         sum((score - target) * (score - target)) AS sq
  FROM {source} GROUP BY {g}, score
),
cum AS (
  SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_below, coalesce(sum(neg) OVER w, 0) AS neg_below,
         sum(pos) OVER (PARTITION BY {g}) AS pos_total, sum(neg) OVER (PARTITION BY {g}) AS neg_total
  FROM hist WINDOW w AS (PARTITION BY {g} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
metrics AS (
  SELECT {g},
    sum(pos * (neg_below + neg * 0.5)) / (max(pos_total) * max(neg_total)) AS auc,
    greatest(max((pos_total - pos_below) / pos_total - (neg_total - neg_below) / neg_total), 0.0) AS ks,
    sum(pos / pos_total * (pos_total - pos_below) / ((pos_total - pos_below) + (neg_total - neg_below))) AS pr_auc,
    CASE WHEN min(score) >= 0 AND max(score) <= 1 THEN sum(sq) / (sum(pos) + sum(neg)) END AS brier,
    CAST(sum(pos) + sum(neg) AS BIGINT) AS n,
    sum(pos) / (sum(pos) + sum(neg)) AS default_rate
  FROM cum GROUP BY {g}
)"""


def sql_metrics_select(g: str) -> str:
    return f"SELECT {g}, auc, 2 * auc - 1 AS gini, ks, pr_auc, brier, n, default_rate FROM metrics"


def sql_grid() -> str:
    step = repr(prof.grid_step())
    return f"""grid AS (
  SELECT CAST(range AS INTEGER) AS j,
         CASE WHEN range = {prof.GRID_POINTS - 1} THEN CAST(1.0 AS DOUBLE)
              ELSE CAST(range AS DOUBLE) * CAST('{step}' AS DOUBLE) + CAST('{prof.GRID_START!r}' AS DOUBLE) END AS threshold
  FROM range({prof.GRID_POINTS})
)"""


def sql_curve(source: str, groups: str, margin: float = prof.MARGIN, lgd: float = prof.LGD) -> str:
    """Brute force: every threshold against every row (oracle only)."""
    return f"""tot AS (
  SELECT {groups}, count(*) AS n_total, count_if(target = 0) AS good_total, count_if(target = 1) AS bad_total
  FROM {source} GROUP BY {groups}
),
cross_rows AS (
  SELECT {groups}, j, threshold,
    count_if(score < threshold) AS approved,
    count_if(score < threshold AND target = 0) AS good_approved,
    count_if(score < threshold AND target = 1) AS bad_approved,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS amt_good_approved,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 1 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS amt_bad_approved
  FROM {source} CROSS JOIN grid GROUP BY {groups}, j, threshold
),
curve AS (
  SELECT {groups}, j, threshold,
    CAST(approved AS DOUBLE) / n_total AS approval_rate,
    amt_good_approved * CAST('{margin!r}' AS DOUBLE) - amt_bad_approved * CAST('{lgd!r}' AS DOUBLE) AS profit,
    (amt_good_approved * CAST('{margin!r}' AS DOUBLE) - amt_bad_approved * CAST('{lgd!r}' AS DOUBLE)) / n_total AS profit_per_application,
    approved,
    CASE WHEN approved > 0 THEN CAST(bad_approved AS DOUBLE) / approved ELSE 0.0 END AS default_among_approved,
    good_total - good_approved AS lost_good,
    bad_total - bad_approved AS prevented_bad
  FROM cross_rows JOIN tot USING ({groups})
)"""


def sql_quantiles(source: str, value: str, groups: str | None, probs: list[float], name: str) -> str:
    plist = ", ".join(repr(float(p)) for p in probs)
    if groups:
        return f"""{name} AS (
  SELECT {groups}, list_sort(list_distinct(quantile_cont({value}, [{plist}]))) AS edges
  FROM {source} WHERE {value} IS NOT NULL AND NOT isnan({value}) GROUP BY {groups}
)"""
    return f"""{name} AS (
  SELECT list_sort(list_distinct(quantile_cont({value}, [{plist}]))) AS edges
  FROM {source} WHERE {value} IS NOT NULL AND NOT isnan({value})
)"""


def deciles(n: int = 10) -> list[float]:
    return [i / n for i in range(n + 1)]


def sql_qcut(value: str, edges: str = "edges") -> str:
    return f"1 + len(list_filter({edges}[2:len({edges}) - 1], lambda e: e < {value}))"


def sql_portfolio_ctes(score: str = PORTFOLIO_MODEL) -> str:
    """The portfolio under the cut-off that earns most on validation rows (``thr``)."""
    from lendspark.plans.q_features import sql_ratios_select

    def band_sql(v: str, edges, labels) -> str:
        parts = " ".join(f"WHEN {v} > {lo!r} AND {v} <= {hi!r} THEN '{lab}'"
                         for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
        return f"CASE {parts} ELSE 'nan' END"

    inc_labels = ", ".join(f"'{x}'" for x in mon.INCOME_BAND_LABELS)
    return (sql_split_ctes() + ",\n" + sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
            + sql_curve("valid", "model") + ",\n" + _sql_best() + ",\n" + fx("fx_application")[len("WITH "):] + f""",
thr AS (SELECT best_threshold AS cut FROM best WHERE model = '{score}'),
app AS (SELECT {sql_ratios_select()} FROM fx_application a),
joined AS (
  SELECT s.id, s.sk_id_curr, s.split, s.target, s.amt_credit, s.{score} AS p,
         a.amt_income_total, a.age_years, a.flag_not_employed, a.region_rating_client_w_city,
         a.code_gender, a.name_education_type, a.name_family_status, a.occupation_type, a.name_contract_type
  FROM split s LEFT JOIN app a USING (sk_id_curr)
),
{sql_quantiles('joined', 'p', None, deciles(10), 'p_edges')},
{sql_quantiles('joined', 'amt_income_total', None, deciles(5), 'inc_edges')},
portfolio AS (
  SELECT id, sk_id_curr, split,
    {r('p', 6)} AS probability,
    CAST({sql_qcut('p', 'pe.edges')} AS INTEGER) AS risk_decile,
    {band_sql('p', mon.RISK_BAND_EDGES, mon.RISK_BAND_LABELS)} AS risk_band,
    CASE WHEN p < cut THEN 'approve' ELSE 'reject' END AS decision,
    target AS actual_default, amt_credit, amt_income_total,
    CAST(ROUND(CASE WHEN p < cut THEN CASE WHEN target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) * CAST('{prof.MARGIN!r}' AS DECIMAL(10,4))
      ELSE -CAST(amt_credit AS DECIMAL(18,2)) * CAST('{prof.LGD!r}' AS DECIMAL(10,4)) END ELSE 0 END, 2) AS DOUBLE) AS realised_profit,
    {band_sql('age_years', mon.AGE_BAND_EDGES, mon.AGE_BAND_LABELS)} AS age_band,
    CASE WHEN amt_income_total IS NULL THEN 'nan' ELSE [{inc_labels}][{sql_qcut('amt_income_total', 'ie.edges')}] END AS income_band,
    coalesce(code_gender, 'nan') AS gender, coalesce(name_education_type, 'nan') AS education,
    coalesce(name_family_status, 'nan') AS family_status, coalesce(occupation_type, 'nan') AS occupation,
    coalesce(name_contract_type, 'nan') AS contract_type,
    region_rating_client_w_city AS region_rating, flag_not_employed AS not_employed
  FROM joined, p_edges pe, inc_edges ie, thr
)""")


def pct(expr: str) -> str:
    return r(f"100.0 * ({expr})", 2)


# --- queries -------------------------------------------------------------------------

@query("stratified_split", "X1", sql=lambda: sql_split_ctes() + "\nSELECT id, target, split FROM split")
def q_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_split(spark, sf_dir).select("id", "target", "split")


@query("split_summary", "A19", sql=lambda: sql_split_ctes() + """
SELECT split, count(*) AS rows, CAST(sum(target) AS BIGINT) AS positives, avg(CAST(target AS DOUBLE)) AS positive_rate,
       10 AS columns
FROM split GROUP BY split""")
def q_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dataset_summary(scored_split(spark, sf_dir), "target", ["split"])


@query("ranking_metrics", "M1-M6,W3", sql=lambda: sql_split_ctes() + ",\n" + sql_ranking("model") + "\n" + sql_metrics_select("model"))
def q_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranking_metrics(scored_long(spark, sf_dir), ["model"], "score", "target")


@query("overfit_check", "M32,U2", sql=lambda: sql_split_ctes() + ",\n" + sql_ranking("model, split") + """
SELECT model, max(CASE WHEN split = 'train' THEN auc END) AS train_auc,
       max(CASE WHEN split = 'validation' THEN auc END) AS validation_auc,
       max(CASE WHEN split = 'test' THEN auc END) AS test_auc,
       max(CASE WHEN split = 'train' THEN auc END) - max(CASE WHEN split = 'validation' THEN auc END) AS overfit_gap
FROM metrics GROUP BY model""")
def q_overfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ranking.ranking_metrics(scored_long(spark, sf_dir), ["model", "split"], "score", "target")
    return m.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("split") == "validation", F.col("auc"))).alias("validation_auc"),
        F.max(F.when(F.col("split") == "test", F.col("auc"))).alias("test_auc"),
    ).withColumn("overfit_gap", F.col("train_auc") - F.col("validation_auc"))


@query("lift_table", "M7,Q5", sql=lambda: sql_split_ctes() + ",\n" + sql_quantiles("long", "score", "model", deciles(10), "e") + f""",
b AS (SELECT long.*, CAST({sql_qcut('score')} - 1 AS INTEGER) AS bucket FROM long JOIN e USING (model)),
per AS (SELECT model, bucket, count(*) AS customers, CAST(sum(target) AS BIGINT) AS defaults,
               avg(CAST(target AS DOUBLE)) AS rate, avg(score) AS mean_score FROM b GROUP BY model, bucket)
SELECT model, bucket, customers, defaults, {r('rate * 100', 2)} AS rate_pct,
       {r('rate / (sum(defaults) OVER (PARTITION BY model) / sum(customers) OVER (PARTITION BY model))', 2)} AS lift,
       mean_score
FROM per""")
def q_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.lift_table(scored_long(spark, sf_dir), ["model"], "score", "target")


@query("calibration_curve", "M8", sql=lambda: sql_split_ctes() + f""",
e AS (SELECT model, list_sort(quantile_cont(score, [{', '.join(repr(i / 12) for i in range(13))}])) AS edges FROM long GROUP BY model),
b AS (SELECT long.*, CAST(len(list_filter(edges[2:12], lambda x: x < score)) AS INTEGER) AS bin FROM long JOIN e USING (model)),
per AS (SELECT model, bin, count(*) AS n, avg(score) AS mean_predicted, avg(CAST(target AS DOUBLE)) AS observed_rate,
               abs(avg(score) - avg(CAST(target AS DOUBLE))) AS abs_gap FROM b GROUP BY model, bin)
SELECT *, avg(abs_gap) OVER (PARTITION BY model) AS mean_abs_gap, max(abs_gap) OVER (PARTITION BY model) AS max_abs_gap FROM per""")
def q_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.calibration_curve(scored_long(spark, sf_dir), ["model"], "score", "target")


@query("profit_curve", "M9,M10,P20,P21",
       sql=lambda: sql_split_ctes() + ",\n" + sql_grid() + ",\n" + sql_curve("long", "model") + "\nSELECT * FROM curve")
def q_profit_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.profit_curve(scored_long(spark, sf_dir), ["model"], "score", "target", "amt_credit")


def _sql_best(source_curve: str = "curve", groups: str = "model") -> str:
    return f"""best AS (
  SELECT {groups}, arg_max(j, (profit, -j)) AS best_j, arg_max(threshold, (profit, -j)) AS best_threshold,
         max(profit) AS best_profit
  FROM {source_curve} GROUP BY {groups}
)"""


def sql_cutoff_ctes() -> str:
    return (sql_split_ctes() + ",\n" + sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
       + sql_curve("valid", "model") + ",\n" + _sql_best() + f""",
test AS (SELECT * FROM long WHERE split = 'test'),
sc AS (
  SELECT model, 'approve_all' AS scenario, CAST({prof.APPROVE_ALL_THRESHOLD!r} AS DOUBLE) AS threshold FROM best
  UNION ALL SELECT model, 'fixed_0.50', CAST({prof.FIXED_THRESHOLD!r} AS DOUBLE) FROM best
  UNION ALL SELECT model, 'optimum', best_threshold FROM best
),
agg AS (
  SELECT model, scenario, threshold, count(*) AS n_total, count_if(target = 0) AS good_total, count_if(target = 1) AS bad_total,
    count_if(score < threshold) AS approved, count_if(score < threshold AND target = 0) AS good_approved,
    count_if(score < threshold AND target = 1) AS bad_approved,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS amt_good_approved,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 1 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS amt_bad_approved
  FROM test JOIN sc USING (model) GROUP BY model, scenario, threshold
)""")


@query("best_cutoff", "M11,Q4", sql=lambda: sql_cutoff_ctes() + f"""
SELECT model, scenario, threshold, CAST(approved AS DOUBLE) / n_total AS approval_rate,
  amt_good_approved * CAST('{prof.MARGIN!r}' AS DOUBLE) - amt_bad_approved * CAST('{prof.LGD!r}' AS DOUBLE) AS profit,
  (amt_good_approved * CAST('{prof.MARGIN!r}' AS DOUBLE) - amt_bad_approved * CAST('{prof.LGD!r}' AS DOUBLE)) / n_total AS profit_per_application,
  approved, CASE WHEN approved > 0 THEN CAST(bad_approved AS DOUBLE) / approved ELSE 0.0 END AS default_among_approved,
  good_total - good_approved AS lost_good, bad_total - bad_approved AS prevented_bad
FROM agg""")
def q_best_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = scored_long(spark, sf_dir)
    curve = prof.profit_curve(long.where(F.col("split") == "validation"), ["model"], "score", "target", "amt_credit")
    best = prof.best_threshold(curve, ["model"])           # one row per model
    test = long.where(F.col("split") == "test").join(F.broadcast(best.select("model", "best_threshold")), "model")
    return prof.profit_at(test, ["model"], "score", "target", "amt_credit", {
        "approve_all": F.lit(prof.APPROVE_ALL_THRESHOLD),
        "fixed_0.50": F.lit(prof.FIXED_THRESHOLD),
        "optimum": F.col("best_threshold"),
    })


@query("profit_uplift", "M11", sql=lambda: sql_cutoff_ctes() + f""",
pr AS (SELECT *, amt_good_approved * CAST('{prof.MARGIN!r}' AS DOUBLE) - amt_bad_approved * CAST('{prof.LGD!r}' AS DOUBLE) AS profit FROM agg),
w AS (SELECT model, max(CASE WHEN scenario = 'approve_all' THEN profit END) AS profit_approve_all,
        max(CASE WHEN scenario = 'fixed_0.50' THEN profit END) AS profit_fixed, max(CASE WHEN scenario = 'optimum' THEN profit END) AS profit_optimum,
        max(CASE WHEN scenario = 'optimum' THEN bad_total - bad_approved END) AS prevented_bad,
        max(CASE WHEN scenario = 'optimum' THEN good_total - good_approved END) AS lost_good FROM pr GROUP BY model)
SELECT *, profit_optimum - profit_approve_all AS uplift, (profit_optimum - profit_approve_all) / abs(nullif(profit_approve_all, 0)) AS uplift_share,
  profit_optimum - (SELECT profit_optimum FROM w WHERE model = '{MODELS[0]}') AS gain_over_reference FROM w""")
def q_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each model's published cut-off earns on test over approving all, and over the first model's."""
    best = policy(spark, sf_dir).select("model", "best_threshold")          # one row per model
    test = scored_long(spark, sf_dir).where(F.col("split") == "test").join(F.broadcast(best), "model")
    return prof.uplift(prof.profit_at(test, ["model"], "score", "target", "amt_credit", {
        "approve_all": F.lit(prof.APPROVE_ALL_THRESHOLD), "fixed_0.50": F.lit(prof.FIXED_THRESHOLD),
        "optimum": F.col("best_threshold")}), "model", MODELS[0])


@query("profit_sensitivity", "M12", sql=lambda: sql_split_ctes() + ",\n" + sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
       + f"""tot AS (SELECT model, count(*) AS n_total FROM valid GROUP BY model),
cr AS (
  SELECT model, j, threshold, count_if(score < threshold) AS approved,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS g,
    CAST(coalesce(sum(CASE WHEN score < threshold AND target = 1 THEN CAST(amt_credit AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS b
  FROM valid CROSS JOIN grid GROUP BY model, j, threshold
),
combos AS (SELECT CAST(m AS DOUBLE) AS margin, CAST(l AS DOUBLE) AS lgd
           FROM (SELECT unnest([{', '.join(repr(m) for m in prof.SENSITIVITY_MARGINS)}]) AS m),
                (SELECT unnest([{', '.join(repr(x) for x in prof.SENSITIVITY_LGDS)}]) AS l)),
pr AS (SELECT model, margin, lgd, j, threshold, CAST(approved AS DOUBLE) / n_total AS ar, g * margin - b * lgd AS profit
       FROM cr JOIN tot USING (model), combos)
SELECT model, margin, lgd, arg_max(threshold, (profit, -j)) AS best_threshold, arg_max(ar, (profit, -j)) AS approval_rate
FROM pr GROUP BY model, margin, lgd""")
def q_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = scored_long(spark, sf_dir).where(F.col("split") == "validation")
    return prof.sensitivity(long, ["model"], "score", "target", "amt_credit")


def sql_psi(ref: str, new: str, groups: str, value: str = "value") -> str:
    """PSI oracle over two sources with the same group columns."""
    return f"""{sql_quantiles(ref, value, groups, deciles(10), 'pe')},
pb AS (SELECT {groups}, CAST(unnest(range(0, len(edges) - 1)) AS BIGINT) AS bin FROM pe WHERE len(edges) >= 3),
rb AS (SELECT {groups}, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= {value})) AS bin, count(*) AS c
       FROM {ref} JOIN pe USING ({groups}) WHERE {value} IS NOT NULL AND NOT isnan({value}) GROUP BY ALL),
yb AS (SELECT {groups}, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= {value})) AS bin, count(*) AS c
       FROM {new} JOIN pe USING ({groups}) WHERE {value} IS NOT NULL AND NOT isnan({value}) GROUP BY ALL),
rn AS (SELECT {groups}, count(*) AS r_n FROM {ref} WHERE {value} IS NOT NULL AND NOT isnan({value}) GROUP BY {groups}),
yn AS (SELECT {groups}, count(*) AS y_n FROM {new} WHERE {value} IS NOT NULL AND NOT isnan({value}) GROUP BY {groups}),
sizes AS (SELECT * FROM rn FULL JOIN yn USING ({groups})),
terms AS (
  SELECT {groups}, greatest(coalesce(rb.c, 0) / sizes.r_n, 1e-6) AS rs, greatest(coalesce(yb.c, 0) / sizes.y_n, 1e-6) AS ys
  FROM pb LEFT JOIN rb USING ({groups}, bin) LEFT JOIN yb USING ({groups}, bin) LEFT JOIN sizes USING ({groups})
),
per AS (SELECT {groups}, sum((ys - rs) * ln(ys / rs)) AS psi_sum FROM terms GROUP BY {groups}),
psi_out AS (
  SELECT {groups}, CASE WHEN y_n IS NULL OR r_n IS NULL THEN NULL WHEN coalesce(len(pe.edges), 0) < 3 THEN 0.0 ELSE psi_sum END AS psi,
         coalesce(len(pe.edges), 0) AS n_edges
  FROM sizes LEFT JOIN pe USING ({groups}) LEFT JOIN per USING ({groups})
)"""


def sql_verdict(v: str = "psi") -> str:
    return (f"CASE WHEN {v} IS NULL THEN 'not computable' WHEN {v} < 0.1 THEN 'no shift' "
            f"WHEN {v} < 0.25 THEN 'moderate - watch' ELSE 'serious - review' END")


@query("score_psi", "M13,M14", sql=lambda: sql_split_ctes() + """,
r_src AS (SELECT model, score AS value FROM long WHERE split = 'train'),
n_src AS (SELECT model, score AS value FROM long WHERE split = 'test'),
""" + sql_psi("r_src", "n_src", "model") + f"\nSELECT model, psi, CAST(n_edges AS INTEGER) AS n_edges, {sql_verdict()} AS verdict FROM psi_out")
def q_score_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = scored_long(spark, sf_dir)
    return psi_ops.psi(long.where(F.col("split") == "train"), long.where(F.col("split") == "test"), "score", ["model"])


@query("scored_portfolio", "M39,Q5,P15,P20,P21,T16-T18",
       sql=lambda: sql_portfolio_ctes() + "\nSELECT * FROM portfolio")
def q_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio(spark, sf_dir)


@query("decision_policy", "M11,Q4,T20", sql=lambda: sql_split_ctes() + ",\n" + sql_grid() + ",\nvalid AS (SELECT * FROM long WHERE split = 'validation'),\n"
       + sql_curve("valid", "model") + ",\n" + _sql_best() + "\nSELECT * FROM best")
def q_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published cut-offs that portfolio and views decide by."""
    return policy(spark, sf_dir)


@query("portfolio_versions", "S6,S7,M39", sql=lambda: sql_portfolio_ctes() + f""",
two AS (SELECT id, CASE WHEN p < CAST('{prof.FIXED_THRESHOLD!r}' AS DOUBLE) THEN 'approve' ELSE 'reject' END AS decision, target, amt_credit FROM joined)
SELECT CAST(1 AS BIGINT) AS sequence, id, decision, realised_profit FROM portfolio
UNION ALL
SELECT CAST(2 AS BIGINT), id, decision, CAST(ROUND(CASE WHEN decision = 'reject' THEN 0
  WHEN target = 0 THEN CAST(amt_credit AS DECIMAL(18,2)) * CAST('{prof.MARGIN!r}' AS DECIMAL(10,4))
  ELSE -CAST(amt_credit AS DECIMAL(18,2)) * CAST('{prof.LGD!r}' AS DECIMAL(10,4)) END, 2) AS DOUBLE) FROM two""")
def q_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the portfolio, open it, publish it anew under another cut-off: the open reader keeps its version, the
    pointer leads to the new one."""
    table = VersionedTable(spark, f"{artefact(spark, sf_dir, 'portfolio_versions').root}-{uuid.uuid4().hex}")
    table.publish(portfolio(spark, sf_dir), "id", PORTFOLIO_CONTRACTS, note="published cut-off")
    first = table.current()
    reader = table.read()
    table.publish(build_portfolio(spark, sf_dir, prof.FIXED_THRESHOLD), "id", PORTFOLIO_CONTRACTS, note="fixed cut-off")
    columns = ["id", "decision", "realised_profit"]
    return reader.select(F.lit(first.sequence).cast("long").alias("sequence"), *columns).unionByName(
        table.read().select(F.lit(table.current().sequence).cast("long").alias("sequence"), *columns))


@query("kpi_by_split", "A14", sql=lambda: sql_portfolio_ctes() + f"""
SELECT split, count(*) AS applications, count_if(decision = 'approve') AS approved,
  {pct("avg(CAST(decision = 'approve' AS INTEGER))")} AS approval_rate,
  {pct('avg(actual_default)')} AS portfolio_default_rate,
  {pct("avg(CASE WHEN decision = 'approve' THEN actual_default END)")} AS default_among_approved,
  {pct("avg(CASE WHEN decision = 'reject' THEN actual_default END)")} AS default_among_rejected,
  CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) AS profit, {r('CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) / count(*)', 0)} AS profit_per_application,
  count_if(decision = 'reject' AND actual_default = 1) AS prevented_defaults,
  count_if(decision = 'reject' AND actual_default = 0) AS lost_good_customers
FROM portfolio GROUP BY split""")
def q_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.kpi_by_split(portfolio(spark, sf_dir))


@query("bucket_performance", "A15,J4", sql=lambda: sql_portfolio_ctes() + f""",
per AS (SELECT split, risk_decile, count(*) AS applications, avg(probability) AS p_, avg(actual_default) AS y_,
               sum(actual_default) AS d_, CAST(sum(CAST(amt_credit AS DECIMAL(18,2))) AS DOUBLE) AS total_credit, CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) AS profit
        FROM portfolio GROUP BY split, risk_decile)
SELECT split, risk_decile, applications, {pct('p_')} AS mean_prediction, {pct('y_')} AS realised_default,
  {r('y_ / NULLIF(sum(d_) OVER (PARTITION BY split) / sum(applications) OVER (PARTITION BY split), 0)', 2)} AS lift,
  {pct('p_ - y_')} AS calibration_gap, total_credit, profit
FROM per""")
def q_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.bucket_performance(portfolio(spark, sf_dir))


@query("segment_performance", "A16,U1", sql=lambda: sql_portfolio_ctes() + ",\nlong_seg AS (\n" + "\n  UNION ALL ".join(
    f"SELECT split, decision, actual_default, realised_profit, probability, '{name}' AS dimension, CAST({c} AS VARCHAR) AS value FROM portfolio"
    for name, c in mon.SEGMENT_DIMENSIONS.items()) + f"""
)
SELECT split, dimension, value, count(*) AS applications,
  {pct("avg(CAST(decision = 'approve' AS INTEGER))")} AS approval_rate,
  {pct('avg(actual_default)')} AS realised_default, {pct('avg(probability)')} AS mean_prediction,
  {pct("avg(CASE WHEN actual_default = 0 THEN CAST(decision = 'reject' AS INTEGER) END)")} AS good_rejection_rate,
  CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) AS profit
FROM long_seg GROUP BY split, dimension, value""")
def q_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.segment_performance(portfolio(spark, sf_dir))


@query("decision_matrix", "A17,P14", sql=lambda: sql_portfolio_ctes() + """
SELECT split, decision,
  CASE WHEN actual_default = 1 THEN 'defaulted' ELSE 'repaid' END AS outcome,
  CASE WHEN decision = 'approve' AND actual_default = 0 THEN 'correct approval'
       WHEN decision = 'approve' AND actual_default = 1 THEN 'wrong approval (loss)'
       WHEN decision = 'reject' AND actual_default = 1 THEN 'correct rejection (loss avoided)'
       ELSE 'wrong rejection (income lost)' END AS result,
  count(*) AS applications, CAST(sum(CAST(amt_credit AS DECIMAL(18,2))) AS DOUBLE) AS credit_amount, CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) AS profit_impact
FROM portfolio GROUP BY split, decision, actual_default""")
def q_decision_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.decision_matrix(portfolio(spark, sf_dir))


@query("risk_band_summary", "A18,W1", sql=lambda: sql_portfolio_ctes() + f"""
SELECT split, risk_band, count(*) AS applications,
  {pct('count(*) / sum(count(*)) OVER (PARTITION BY split)')} AS share_pct,
  {pct('avg(actual_default)')} AS realised_default,
  {pct("avg(CAST(decision = 'approve' AS INTEGER))")} AS approval_rate,
  {r('CAST(sum(CAST(amt_credit AS DECIMAL(18,2))) AS DOUBLE) / count(*)', 0)} AS avg_credit, CAST(sum(CAST(realised_profit AS DECIMAL(18,2))) AS DOUBLE) AS profit
FROM portfolio GROUP BY split, risk_band""")
def q_risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mon.risk_band_summary(portfolio(spark, sf_dir))


@query("view_counts", "S10", sql=lambda: sql_portfolio_ctes() + """
SELECT 'kpi_by_split' AS name, count(DISTINCT split) AS rows FROM portfolio
UNION ALL SELECT 'bucket_performance', count(*) FROM (SELECT DISTINCT split, risk_decile FROM portfolio)
UNION ALL SELECT 'segment_performance', count(*) FROM (
  SELECT DISTINCT split, 'a', age_band FROM portfolio UNION ALL SELECT DISTINCT split, 'i', income_band FROM portfolio
  UNION ALL SELECT DISTINCT split, 'e', education FROM portfolio UNION ALL SELECT DISTINCT split, 'f', family_status FROM portfolio
  UNION ALL SELECT DISTINCT split, 'o', occupation FROM portfolio UNION ALL SELECT DISTINCT split, 'c', contract_type FROM portfolio
  UNION ALL SELECT DISTINCT split, 'g', gender FROM portfolio)
UNION ALL SELECT 'decision_matrix', count(*) FROM (SELECT DISTINCT split, decision, actual_default FROM portfolio)
UNION ALL SELECT 'risk_band_summary', count(*) FROM (SELECT DISTINCT split, risk_band FROM portfolio)""")
def q_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = portfolio(spark, sf_dir)
    return mon.view_counts({
        "kpi_by_split": mon.kpi_by_split(p), "bucket_performance": mon.bucket_performance(p),
        "segment_performance": mon.segment_performance(p), "decision_matrix": mon.decision_matrix(p),
        "risk_band_summary": mon.risk_band_summary(p),
    })


@query("single_feature_benchmark", "M29", sql=lambda: sql_split_ctes() + """,
app AS (SELECT a.sk_id_curr, a.ext_source_3 AS x FROM (""" + fixtures.duckdb_text("fx_application") + """) a),
med AS (SELECT median(x) AS m FROM split JOIN app USING (sk_id_curr) WHERE split = 'train'),
bench AS (SELECT 'ext_source_3' AS model, split.target, -coalesce(app.x, med.m) AS score
          FROM split JOIN app USING (sk_id_curr), med WHERE split = 'validation'),
""" + sql_ranking("model", "bench") + "\n" + sql_metrics_select("model"))
def q_single_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw variable as the score (−x, NULL → training median)."""
    s = scored_split(spark, sf_dir).select("sk_id_curr", "target", "split")
    app = fixtures.load(spark, sf_dir, "application").select("sk_id_curr", F.col("ext_source_3").alias("x"))
    d = s.join(app, "sk_id_curr", "left")
    med = exact_quantiles(d.where(F.col("split") == "train"), "x", [0.5]).select(F.col("quantile").alias("m"))
    v = (d.where(F.col("split") == "validation").withColumn("_k", F.lit(1))
         .join(F.broadcast(med.withColumn("_k", F.lit(1))), "_k", "left")       # one-row side
         .select(F.lit("ext_source_3").alias("model"), "target", (-F.coalesce(F.col("x"), F.col("m"))).alias("score")))
    return ranking.ranking_metrics(v, ["model"], "score", "target")


# --- bootstrap (M16, M17) -------------------------------------------------------------

def sql_boot_ctes(rows: str, replicates: int) -> str:
    """Oracle: AUC of each replicate (``ba``) from ``rows`` (model, score, target, id): the same counter hash of (id,
    replicate) in 128-bit arithmetic, the same inverse CDF of Poisson(1)."""
    from lendspark.operators.bootstrap import GAMMA, MIX_1, MIX_2

    word, low = "18446744073709551616::UHUGEINT", "4294967295::UBIGINT"

    def joined(high: str, rest: str) -> str:
        """64 bits from sums of halves (``rest`` below 2^64, its carry goes to ``high``)."""
        return f"((({high}) + (({rest}) >> 32)) & {low}) * 4294967296::UBIGINT + (({rest}) & {low})"

    def step(source: str, shift: int, by: int) -> str:
        """(z xor z >> shift) * by, modulo 2^64, in halves."""
        lo, hi = f"{by % 2 ** 32}::UBIGINT", f"{by // 2 ** 32}::UBIGINT"
        return (f"SELECT * EXCLUDE (x) REPLACE ({joined(f'(((x >> 32) * {lo}) & {low}) + (((x & {low}) * {hi}) & {low})', f'(x & {low}) * {lo}')} AS z) "
                f"FROM (SELECT *, xor(z, z >> {shift}) AS x FROM {source})")

    return f"""cdf AS (
  WITH RECURSIVE p AS (
    SELECT 0 AS k, exp(-1::DOUBLE) AS t, exp(-1::DOUBLE) AS acc
    UNION ALL SELECT k + 1, t / (k + 1), acc + t / (k + 1) FROM p WHERE k + 1 < 25
  ) SELECT list(acc ORDER BY k) AS table_ FROM p
),
reps AS MATERIALIZED (SELECT range AS replicate, (((range + 1)::UHUGEINT * {GAMMA}::UHUGEINT) % {word})::UBIGINT AS g FROM range({replicates})),
uc AS MATERIALIZED (SELECT *, ((coalesce(id, 0)::HUGEINT + 18446744073709551616::HUGEINT)::UHUGEINT % {word})::UBIGINT AS i FROM {rows}),
z0 AS (SELECT uc.* EXCLUDE (i), replicate, {joined('(i >> 32) + (g >> 32)', f'(i & {low}) + (g & {low})')} AS z FROM uc, reps),
z1 AS ({step('z0', 30, MIX_1)}),
z2 AS ({step('z1', 27, MIX_2)}),
rw AS (SELECT * EXCLUDE (z), (xor(z, z >> 31) >> 11)::DOUBLE / 9007199254740992 AS u FROM z2),
rw2 AS (SELECT rw.*, len(list_filter(table_, lambda c: c <= u)) AS w FROM rw, cdf),
bh AS (
  SELECT model, replicate, score, sum(w * target) AS pos, sum(w * (1 - target)) AS neg
  FROM rw2 GROUP BY model, replicate, score
),
bc AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, replicate ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
         sum(pos) OVER (PARTITION BY model, replicate) AS pt, sum(neg) OVER (PARTITION BY model, replicate) AS nt
  FROM bh
),
ba AS (
  SELECT model, replicate, CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN sum(pos * (neg_below + neg * 0.5)) / (max(pt) * max(nt)) END AS auc
  FROM bc GROUP BY model, replicate
)"""


BOOT_SPLIT = "test"


@query("auc_bootstrap", "M16", sql=lambda: sql_split_ctes() + f""",
src AS (SELECT id, model, score, CAST(target AS DOUBLE) AS target FROM long WHERE split = '{BOOT_SPLIT}'),
{sql_ranking('model', 'src')},
{sql_boot_ctes('src', REPLICATES_Q)}
SELECT m.model, m.auc, quantile_cont(ba.auc, 0.025) AS ci_low, quantile_cont(ba.auc, 0.975) AS ci_high, count(*) AS replicates
FROM metrics m JOIN ba USING (model) WHERE ba.auc IS NOT NULL GROUP BY m.model, m.auc""")
def q_auc_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendspark.operators.bootstrap import bootstrap_auc

    long = scored_long(spark, sf_dir).where(F.col("split") == BOOT_SPLIT)
    return bootstrap_auc(long, ["model"], "id", "score", "target", REPLICATES_Q)


@query("paired_bootstrap", "M17", sql=lambda: sql_split_ctes() + f""",
src AS (SELECT id, model, score, CAST(target AS DOUBLE) AS target FROM long WHERE split = '{BOOT_SPLIT}'),
{sql_ranking('model', 'src')},
{sql_boot_ctes('src', REPLICATES_Q)},
d AS (SELECT replicate, max(CASE WHEN model = 'p_a' THEN auc END) - max(CASE WHEN model = 'p_b' THEN auc END) AS d
      FROM ba GROUP BY replicate HAVING d IS NOT NULL)
SELECT 'p_a' AS model_a, 'p_b' AS model_b,
  (SELECT max(CASE WHEN model = 'p_a' THEN auc END) - max(CASE WHEN model = 'p_b' THEN auc END) FROM metrics) AS difference,
  quantile_cont(d, 0.025) AS ci_low, quantile_cont(d, 0.975) AS ci_high,
  least(1.0, 2 * least(avg(CAST(d <= 0 AS DOUBLE)), avg(CAST(d >= 0 AS DOUBLE)))) AS p_value, count(*) AS replicates
FROM d""")
def q_paired_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendspark.operators.bootstrap import paired_difference

    wide = scored_split(spark, sf_dir).where(F.col("split") == BOOT_SPLIT)
    return paired_difference(wide, "id", "p_a", "p_b", "target", REPLICATES_Q)


# --- Q7 extremes, Q8 fixed-seed sample -------------------------------------------------

SAMPLE_ROWS = 200


@query("extreme_scores", "Q7", sql=lambda: sql_portfolio_ctes() + """
SELECT split, arg_max(id, (probability, -id)) AS riskiest_id, max(probability) AS max_probability,
       arg_min(id, (probability, id)) AS safest_id, min(probability) AS min_probability
FROM portfolio GROUP BY split""")
def q_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: the riskiest and the safest application per split (ties → lowest id)."""
    p = portfolio(spark, sf_dir)
    return p.groupBy("split").agg(
        F.max_by("id", F.struct(F.col("probability"), (-F.col("id")).alias("n"))).alias("riskiest_id"),
        F.max("probability").alias("max_probability"),
        F.min_by("id", F.struct(F.col("probability"), F.col("id"))).alias("safest_id"),
        F.min("probability").alias("min_probability"),
    )


@query("explain_sample", "Q8,Q1,S3", sql=lambda: sql_portfolio_ctes() + f"""
SELECT id, split, probability, decision FROM portfolio WHERE split = 'test'
ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT {SAMPLE_ROWS}""")
def q_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: a reproducible sample of the test portfolio — the first n rows in
    md5(id) order (a distributed top-k; the limit is the feature)."""
    p = portfolio(spark, sf_dir).where(F.col("split") == "test")
    return p.orderBy(F.md5(F.col("id").cast("string")), "id").limit(SAMPLE_ROWS).select(
        "id", "split", "probability", "decision")

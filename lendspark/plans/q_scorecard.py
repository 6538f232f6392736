"""Scorecard queries."""
from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.operators import fairness as fair
from lendspark.operators import psi as psi_ops
from lendspark.operators import ranking
from lendspark.operators import scorecard as sc
from lendspark.plans import q_scoring as qs
from lendspark.plans.q_audit import customer_split, sql_customer_split
from lendspark.functions.local import local_frame
from lendspark.plans.artefacts import artefact
from lendspark.plans.registry import query

#: All numeric and boolean columns of the model input but for four unrounded averages of fractional doubles: prev_amt_annuity_avg,
#: prev_down_payment_rate_avg, cc_balance_avg, cc_limit_avg. Their last bit follows the order in which rows are summed, and a
#: value on a decile edge changes its bin with it, so they wait until the rollups average them exactly.
CANDIDATE_NUMERIC = """
ext_source_1 ext_source_2 ext_source_3 ext_source_mean ext_source_min ext_source_max ext_source_count
credit_income_ratio annuity_income_ratio credit_goods_ratio credit_term income_per_person age_years employed_years employed_life_ratio
flag_not_employed amt_credit amt_income_total amt_annuity amt_goods_price days_birth days_employed cnt_children cnt_fam_members
region_rating_client_w_city
bureau_credit_count bureau_active_count bureau_closed_count bureau_bad_count bureau_type_count bureau_amt_sum bureau_debt_sum
bureau_overdue_sum bureau_debt_ratio bureau_max_overdue_days bureau_overdue_credit_count bureau_prolong_sum bureau_days_since_last
bureau_days_since_first bb_total_months bb_dpd_months bb_severe_dpd_months bb_worst_status bb_dpd_ratio
prev_app_count prev_approved_count prev_refused_count prev_canceled_count prev_unused_count prev_refused_ratio prev_refused_last_year
prev_days_since_last prev_days_since_first prev_days_since_last_refusal prev_amt_application_sum prev_amt_credit_sum
prev_credit_to_application_ratio prev_term_avg prev_cash_count prev_consumer_count prev_revolving_count
prev_reject_hc prev_reject_limit prev_reject_sco prev_insured_ratio
inst_count inst_late_count inst_late30_count inst_late_ratio inst_late30_ratio inst_dpd_max inst_dpd_avg inst_unpaid_count
inst_underpaid_count inst_underpaid_ratio inst_amt_due_sum inst_amt_paid_sum inst_payment_ratio inst_count_1y inst_late_count_1y
inst_late_ratio_1y
pos_month_count pos_contract_count pos_dpd_months pos_dpd30_months pos_dpd_ratio pos_dpd_max pos_dpd_def_max pos_active_months
pos_completed_months pos_demand_months pos_term_avg pos_remaining_avg pos_months_since_last pos_months_1y pos_dpd_months_1y pos_dpd_ratio_1y
cc_month_count cc_card_count cc_utilization_avg cc_utilization_max cc_over_limit_months cc_atm_drawings_sum cc_drawings_sum
cc_atm_drawings_ratio cc_payment_to_min_ratio cc_zero_payment_months cc_balance_max cc_dpd_months cc_dpd_ratio
cc_dpd_max cc_dpd_def_max cc_active_months cc_months_since_last cc_utilization_avg_1y cc_dpd_months_1y
""".split()
CANDIDATE_CATEGORICAL = ["name_contract_type", "name_education_type", "occupation_type", "code_gender",
                         "name_family_status"]
NUMERIC = fair.compliant_features(CANDIDATE_NUMERIC)
CATEGORICAL = fair.compliant_features(CANDIDATE_CATEGORICAL)
REASONS, ONLINE_REASONS = 12, 8


def binned_train(spark: SparkSession, sf_dir: str):
    s = customer_split(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    edges = sc.prebin_edges(train, NUMERIC, "sk_id_curr", "target")
    return s, train, edges


def woe_prebins(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, train, edges = binned_train(spark, sf_dir)
    return sc.woe_table(sc.assign_bins(train, NUMERIC, CATEGORICAL, edges, "sk_id_curr", "target"), "target")


@dataclass
class FittedScorecard:
    frame: DataFrame           # all customers: WOE columns, split, target, logit, probability, points
    bins: DataFrame            # final (monotone) bin table with WOE
    ivs: DataFrame
    pruning: list
    kept: list
    intercept: float
    coefs: dict
    rounds: int
    dropped: list
    means: dict

    @property
    def mean_logit(self) -> float:
        return self.intercept + sum(c * self.means[f] for f, c in self.coefs.items())


def additivity_error(frame: DataFrame, coefs: dict, means: dict, mean_logit: float) -> F.Column:
    """|sum of contributions - (logit - mean logit)| of a scored row."""
    total = F.lit(0.0)
    for f, c in coefs.items():
        total = total + F.lit(c) * (F.col(f"woe_{f}") - F.lit(means[f]))
    return F.abs(total - (F.col("logit") - F.lit(mean_logit)))


MODEL_PARTS = ("scorecard_bins", "scorecard_ivs", "scorecard_frame", "scorecard_model")


def train_scorecard(spark: SparkSession, sf_dir: str) -> None:
    """Bin, WOE/IV, monotone merge, IV filter, WOE transform, correlation prune, sign-repaired logistic fit; then publish
    bins, IVs, scored customers and, last, the model. The driver sees only bounded tables."""
    bins_at, ivs_at, frame_at, model_at = (artefact(spark, sf_dir, name) for name in MODEL_PARTS)
    fair.compliance_gate(NUMERIC + CATEGORICAL)                         # M38
    s = customer_split(spark, sf_dir)
    bins_at.publish(monotone_bins(spark, sf_dir), ["feature", "bin"], contracts={"no bin is empty": "count_if(n <= 0) = 0"})
    bins = bins_at.read()
    ivs_at.publish(sc.iv_summary(bins), "feature")
    selected = [r["feature"] for r in ivs_at.read().where("selected").orderBy(F.desc("iv"), "feature").collect()]
    bmap = sc.BinMap.collect(bins)
    woe = bmap.transform(s, [f for f in NUMERIC if f in selected], [f for f in CATEGORICAL if f in selected],
                         ["sk_id_curr", "target", "split"])
    train_woe = woe.where(F.col("split") == "train")
    pruning = sc.correlation_prune(train_woe, selected)
    survivors = [p[0] for p in pruning if p[1]]
    kept, intercept, coefs, rounds, dropped = sc.sign_repair(train_woe, survivors, "target", train_woe.count())
    means_row = train_woe.agg(F.count(F.lit(1)).alias("_rows"), *[F.avg(f"woe_{f}").alias(f) for f in kept]).first()
    means = {f: float(means_row[f]) for f in kept}
    model = {"pruning": pruning, "kept": kept, "intercept": intercept, "coefs": coefs, "rounds": rounds, "dropped": dropped, "means": means}
    mean_logit = intercept + sum(c * means[f] for f, c in coefs.items())
    scored = sc.score_columns(woe, intercept, coefs)
    frame_at.publish(scored.withColumn("additivity_error", additivity_error(scored, coefs, means, mean_logit)), "sk_id_curr", contracts={
        "contributions add up to the score": "max(additivity_error) < 1e-4",
        "points fall as default rises (validation)": sc.DIRECTION_HOLDS,
        "probabilities lie in [0, 1]": "count_if(probability NOT BETWEEN 0 AND 1) = 0"})
    model_at.publish(local_frame(spark, [(json.dumps(model),)], "model string"), note="scorecard")


def fit_scorecard(spark: SparkSession, sf_dir: str) -> FittedScorecard:
    """The published scorecard; the first job that finds none trains it."""
    model = artefact(spark, sf_dir, "scorecard_model")
    if model.current() is None:
        train_scorecard(spark, sf_dir)
    bins, ivs, frame = (artefact(spark, sf_dir, name).read() for name in MODEL_PARTS[:3])
    return FittedScorecard(frame.drop("additivity_error"), bins, ivs, **json.loads(model.read().first()["model"]))


def monotone_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins that the scorecard is fitted on, with WOE, IV and JS."""
    return sc.woe_of_counts(sc.monotone_merge(woe_prebins(spark, sf_dir)))


# --- oracle text for the pre-bin WOE table ---------------------------------------

def sql_woe_ctes() -> str:
    num = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in NUMERIC)
    cat = ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in CATEGORICAL)
    return sql_customer_split() + f""",
tr AS (SELECT sk_id_curr, target, {num} FROM msplit WHERE split = 'train'),
trc AS (SELECT sk_id_curr, target, {cat} FROM msplit WHERE split = 'train'),
ln AS (SELECT * FROM tr UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUMERIC)}))),
lc AS (SELECT * FROM trc UNPIVOT INCLUDE NULLS (level FOR feature IN ({', '.join(CATEGORICAL)}))),
{qs.sql_quantiles('ln', 'value', 'feature', qs.deciles(sc.N_PREBINS), 'pe')},
nb AS (
  SELECT ln.feature, ln.target,
    CASE WHEN value IS NULL THEN 'missing' ELSE 'q' || lpad(CAST({qs.sql_qcut('value', 'pe.edges')} AS VARCHAR), 2, '0') END AS bin
  FROM ln LEFT JOIN pe USING (feature)
),
lv AS (SELECT feature, level, count(*) AS c, sum(count(*)) OVER (PARTITION BY feature) AS all_ FROM lc WHERE level IS NOT NULL GROUP BY feature, level),
cb AS (SELECT lc.feature, target, CASE WHEN lc.level IS NULL THEN 'missing' WHEN lv.c >= {sc.RARE_SHARE!r} * lv.all_ THEN '=' || lc.level ELSE '{sc.POOLED}' END AS bin
       FROM lc LEFT JOIN lv ON lv.feature = lc.feature AND lv.level = lc.level),
allb AS (SELECT * FROM nb UNION ALL SELECT * FROM cb),
cnt AS (SELECT feature, bin, count(*) AS n, CAST(sum(1 - target) AS BIGINT) AS good, CAST(sum(target) AS BIGINT) AS bad
        FROM allb GROUP BY feature, bin),
sh AS (
  SELECT *, (good + 0.5) / (sum(good) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS good_share,
            (bad + 0.5) / (sum(bad) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS bad_share
  FROM cnt
),
wt AS (
  SELECT feature, bin, n, good, bad, CAST(bad AS DOUBLE) / n AS event_rate, ln(good_share / bad_share) AS woe,
    (good_share - bad_share) * ln(good_share / bad_share) AS iv_part,
    0.5 * good_share * ln(good_share / ((good_share + bad_share) / 2)) + 0.5 * bad_share * ln(bad_share / ((good_share + bad_share) / 2)) AS js_part
  FROM sh
),
wiv AS (SELECT *, sum(iv_part) OVER (PARTITION BY feature) AS iv, sum(js_part) OVER (PARTITION BY feature) AS js FROM wt)"""


@query("woe_iv_table", "M19", sql=lambda: sql_woe_ctes() + "\nSELECT feature, bin, n, good, bad, event_rate, woe, iv_part, iv, js FROM wiv")
def q_woe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return woe_prebins(spark, sf_dir).select("feature", "bin", "n", "good", "bad", "event_rate", "woe", "iv_part", "iv", "js")


def sql_monotone_ctes() -> str:
    """Pool-adjacent-violators by its min-max formula: the fitted rate of bin i is the greatest over a <= i of the least over
    b >= i of the rate of bins a..b (rates negated where they fall); bins of one fitted rate are one bin."""
    return sql_woe_ctes() + f""",
qb AS (SELECT feature, bin, n, good, bad, row_number() OVER (PARTITION BY feature ORDER BY CAST(bin[2:] AS INTEGER)) AS i FROM wt WHERE starts_with(bin, 'q')),
tr_ AS (SELECT feature, CASE WHEN covar_pop(i, bad / n) < -{sc.TREND_NOISE!r} THEN -1 ELSE 1 END AS sign FROM qb GROUP BY feature),
ab AS (SELECT x.feature, x.i AS a, y.i AS b, CAST(sign * sum(z.bad) AS DOUBLE) / sum(z.n) AS rate
       FROM qb x JOIN qb y ON y.feature = x.feature AND y.i >= x.i JOIN qb z ON z.feature = x.feature AND z.i BETWEEN x.i AND y.i
       JOIN tr_ ON tr_.feature = x.feature GROUP BY x.feature, x.i, y.i, sign),
li AS (SELECT qb.feature, qb.i, ab.a, min(ab.rate) AS least FROM qb JOIN ab ON ab.feature = qb.feature AND ab.a <= qb.i AND ab.b >= qb.i GROUP BY qb.feature, qb.i, ab.a),
fi AS (SELECT feature, i, max(least) AS fitted FROM li GROUP BY feature, i),
mg AS (SELECT qb.feature, 'q' || lpad(CAST(dense_rank() OVER (PARTITION BY qb.feature ORDER BY fitted) AS VARCHAR), 2, '0') AS bin, n, good, bad
       FROM qb JOIN fi USING (feature, i)),
mcnt AS (SELECT feature, bin, CAST(sum(n) AS BIGINT) AS n, CAST(sum(good) AS BIGINT) AS good, CAST(sum(bad) AS BIGINT) AS bad FROM mg GROUP BY feature, bin
         UNION ALL SELECT feature, bin, n, good, bad FROM wt WHERE NOT starts_with(bin, 'q')),
msh AS (SELECT *, (good + 0.5) / (sum(good) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS good_share,
                  (bad + 0.5) / (sum(bad) OVER (PARTITION BY feature) + 0.5 * count(*) OVER (PARTITION BY feature)) AS bad_share FROM mcnt),
mwt AS (SELECT feature, bin, n, good, bad, CAST(bad AS DOUBLE) / n AS event_rate, ln(good_share / bad_share) AS woe,
          (good_share - bad_share) * ln(good_share / bad_share) AS iv_part FROM msh),
mwiv AS (SELECT *, sum(iv_part) OVER (PARTITION BY feature) AS iv FROM mwt)"""


@query("monotone_bins", "M19,M20", sql=lambda: sql_monotone_ctes() + f"""
SELECT feature, bin, n, good, bad, event_rate, woe, iv, iv >= {sc.IV_MIN} AND iv <= {sc.IV_MAX} AS selected FROM mwiv""")
def q_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published bins that the scorecard is fitted on."""
    return fit_scorecard(spark, sf_dir).bins.select("feature", "bin", "n", "good", "bad", "event_rate", "woe", "iv").withColumn(
        "selected", (F.col("iv") >= sc.IV_MIN) & (F.col("iv") <= sc.IV_MAX))


@query("iv_selected", "M20,M41", sql=lambda: sql_woe_ctes() + f"""
SELECT feature, max(iv) AS iv, max(js) AS js, count(*) AS n_bins,
  CASE WHEN max(iv) < {sc.IV_WEAK} THEN 'weak' WHEN max(iv) < {sc.IV_MEDIUM} THEN 'medium' ELSE 'strong' END AS strength,
  max(iv) >= {sc.IV_MIN} AND max(iv) <= {sc.IV_MAX} AS selected
FROM wiv GROUP BY feature""")
def q_iv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.iv_summary(woe_prebins(spark, sf_dir))


@query("woe_transform", "M21", sql=lambda: sql_woe_ctes() + f""",
alln AS (SELECT * FROM (SELECT sk_id_curr, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in NUMERIC)} FROM msplit)
         UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(NUMERIC)}))),
allc AS (SELECT * FROM (SELECT sk_id_curr, {', '.join(f'CAST({f} AS VARCHAR) AS {f}' for f in CATEGORICAL)} FROM msplit)
         UNPIVOT INCLUDE NULLS (level FOR feature IN ({', '.join(CATEGORICAL)}))),
xb AS (
  SELECT sk_id_curr, alln.feature,
    CASE WHEN value IS NULL THEN 'missing' ELSE 'q' || lpad(CAST({qs.sql_qcut('value', 'pe.edges')} AS VARCHAR), 2, '0') END AS bin
  FROM alln LEFT JOIN pe USING (feature)
  UNION ALL
  SELECT sk_id_curr, feature, CASE WHEN level IS NULL THEN 'missing' ELSE '=' || level END FROM allc
)
SELECT sk_id_curr, xb.feature, coalesce(wiv.woe, pooled.woe, 0.0) AS woe FROM xb LEFT JOIN wiv USING (feature, bin)
  LEFT JOIN wiv pooled ON pooled.feature = xb.feature AND pooled.bin = '{sc.POOLED}' AND starts_with(xb.bin, '=')""")
def q_woe_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M21 with the pre-bins: WOE per customer and feature (long form). The
    transform itself is generated column expressions (no join)."""
    s, train, edges = binned_train(spark, sf_dir)
    pre = sc.woe_table(sc.assign_bins(train, NUMERIC, CATEGORICAL, edges, "sk_id_curr", "target"), "target")
    wide = sc.BinMap.collect(pre).transform(s, NUMERIC, CATEGORICAL, ["sk_id_curr"])
    cols = [f"woe_{f}" for f in NUMERIC + CATEGORICAL]
    return wide.unpivot(["sk_id_curr"], cols, "feature", "woe").withColumn(
        "feature", F.regexp_replace("feature", "^woe_", ""))


# --- fitted-model outputs (rows-only: they depend on an iterative fit) ----------------

@query("correlation_prune", "M22")
def q_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fit_scorecard(spark, sf_dir)
    rows = [(f, k, r, b) for f, k, r, b in m.pruning]
    return spark.createDataFrame(rows, "feature string, kept boolean, max_abs_corr double, blocked_by string")


@query("sign_repair", "M23,M24")
def q_sign_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fit_scorecard(spark, sf_dir)
    rows = [(f, c, abs(c), True) for f, c in m.coefs.items()] + [(f, None, None, False) for f in m.dropped]
    rows.append(("(intercept)", m.intercept, None, True))
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double, kept boolean")


@query("logit_fit", "M25,M6")
def q_logit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorecard ranking quality per split (train / validation / test)."""
    m = fit_scorecard(spark, sf_dir)
    scored = sc.score_columns(m.frame, m.intercept, m.coefs)
    return ranking.ranking_metrics(scored, ["split"], "probability", "target")


@query("points_table", "M26")
def q_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fit_scorecard(spark, sf_dir)
    return sc.points_table(m.bins, m.intercept, m.coefs).select(
        "feature", "bin", "lower", "upper", "n", "event_rate", "woe", "coefficient", "points")


@query("direction_audit", "M27")
def q_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction of each variable's points, and of the total on validation customers (a scorecard whose total is reversed
    there is never published)."""
    m = fit_scorecard(spark, sf_dir)
    per_var = sc.direction_audit(sc.points_table(m.bins, m.intercept, m.coefs))
    y = F.col("target").cast("double")
    overall = m.frame.where(F.col("split") == "validation").agg(
        F.try_divide(F.covar_pop("points", y), F.stddev_pop("points") * F.stddev_pop(y)).alias("direction_corr"),
        F.count(F.lit(1)).alias("bins")).select(
        F.lit("(total points)").alias("feature"), "direction_corr", "bins", F.when(F.col("direction_corr") < 0, "correct")
        .when(F.coalesce("direction_corr", F.lit(0.0)) == 0, "flat").otherwise("reversed").alias("status"))
    return per_var.unionByName(overall)


@query("points_bands", "M28,M42,Q6")
def q_points_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fit_scorecard(spark, sf_dir)
    scored = sc.score_columns(m.frame, m.intercept, m.coefs).where(F.col("split") == "validation")
    return sc.points_bands(scored, "target")


@query("reason_codes", "M33,Q2")
def q_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top reasons per customer; ``additivity_error`` = |Σ contributions −
    (logit − mean logit)| must be ~0."""
    m = fit_scorecard(spark, sf_dir)
    scored = sc.contributions(sc.score_columns(m.frame, m.intercept, m.coefs), m.coefs, m.means)
    mean_logit = m.intercept + sum(c * m.means[f] for f, c in m.coefs.items())
    total = F.aggregate(F.col("contribs"), F.lit(0.0), lambda acc, x: acc + x["contribution"])
    return scored.select(
        "sk_id_curr", "split", "probability", "points",
        sc.top_reasons(F.col("contribs"), REASONS).alias("reasons"),
        F.abs(total - (F.col("logit") - F.lit(mean_logit))).alias("additivity_error"),
    )


def mean_contributions(m: FittedScorecard) -> DataFrame:
    """Mean |contribution| per model feature over all customers (one row per feature)."""
    scored = sc.contributions(sc.score_columns(m.frame, m.intercept, m.coefs), m.coefs, m.means)
    ex = scored.select(F.explode("contribs").alias("c")).select("c.feature", F.abs("c.contribution").alias("a"))
    return ex.groupBy("feature").agg(F.avg("a").alias("mean_abs_contribution"))


@query("global_importance", "M34,W2")
def q_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fit_scorecard(spark, sf_dir)
    imp = mean_contributions(m)
    total = F.sum("mean_abs_contribution").over(Window.partitionBy(F.lit(0)))
    imp = imp.withColumn("share", F.col("mean_abs_contribution") / total)
    imp = imp.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs_contribution"), "feature")))
    iv_rank = m.ivs.where(F.col("feature").isin(m.kept)).withColumn(
        "iv_rank", F.row_number().over(Window.orderBy(F.desc("iv"), "feature"))).select("feature", "iv", "iv_rank")
    # both sides hold one row per model feature (bounded by the feature count)
    return imp.join(iv_rank, "feature", "left").withColumn("rank_change", F.col("iv_rank") - F.col("rank"))


@query("importance_ranks", "J3,M31,M34,W2")
def q_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the scorecard's features stand by contribution and by the challenger's gain. A feature that the challenger does
    not take has no gain rank."""
    from lendspark.plans.q_models import challenger

    ranks = sc.rank_features(mean_contributions(fit_scorecard(spark, sf_dir)), "mean_abs_contribution", "contribution_rank")
    gain = challenger(spark, sf_dir)[0].select("feature", F.col("importance").alias("gain"), F.col("rank").alias("gain_rank"))
    return sc.rank_disagreement(ranks, gain)


@query("selection_funnel", "M41,M36")
def q_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate features left after each step of the scorecard's selection, and those that the step took out."""
    m = fit_scorecard(spark, sf_dir)
    iv = {r["feature"] for r in m.ivs.where("selected").select("feature").collect()}                # one row per feature
    return local_frame(spark, sc.selection_funnel([
        ("candidates", CANDIDATE_NUMERIC + CANDIDATE_CATEGORICAL),
        ("protected features removed", NUMERIC + CATEGORICAL),
        ("information value", iv),
        ("correlation", [p[0] for p in m.pruning if p[1]]),
        ("sign", m.kept)]), "step int, stage string, features int, removed array<string>")


@query("reason_values", "M33,Q2")
def q_reason_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online scorer's answer for test customers: their strongest reasons, each with the customer's own value."""
    m = fit_scorecard(spark, sf_dir)
    test = sc.score_columns(m.frame.where(F.col("split") == "test"), m.intercept, m.coefs)
    top = sc.contributions(test, m.coefs, m.means).select(
        "sk_id_curr", "probability", F.posexplode(sc.top_reasons(F.col("contribs"), ONLINE_REASONS)).alias("pos", "r"))
    raw = customer_split(spark, sf_dir).where(F.col("split") == "test")
    values = raw.select("sk_id_curr", F.create_map(*[x for f in m.kept for x in (F.lit(f), F.col(f).cast("string"))]).cast("map<string,string>").alias("raw"))
    return top.join(values, "sk_id_curr").select(
        "sk_id_curr", "probability", (F.col("pos") + 1).alias("reason_rank"), "r.feature", "r.contribution", "r.direction",
        F.col("raw")[F.col("r.feature")].alias("value"))


DRIFT_FEATURES = 10          # the strongest numeric features are monitored


@query("drift_report", "M15,P24,M6,M13,M14")
def q_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published scorecard on test customers under each scenario, against the training customers it was fitted on."""
    m = fit_scorecard(spark, sf_dir)
    strong = mean_contributions(m).where(F.col("feature").isin([f for f in m.kept if f in NUMERIC])).orderBy(
        F.desc("mean_abs_contribution"), "feature").limit(DRIFT_FEATURES).collect()
    watched = [r["feature"] for r in strong]
    s = customer_split(spark, sf_dir)
    keep = ["target", *watched]
    train = s.where(F.col("split") == "train").select("sk_id_curr", *watched).join(
        m.frame.where(F.col("split") == "train").select("sk_id_curr", "probability"), "sk_id_curr")
    test = psi_ops.stressed(s.where(F.col("split") == "test"), qs.SCENARIO_NAMES)
    woe = sc.BinMap.collect(m.bins).transform(test, [f for f in m.kept if f in NUMERIC], [f for f in m.kept if f in CATEGORICAL],
                                              ["scenario", *keep])
    return psi_ops.drift_report(train, sc.score_columns(woe, m.intercept, m.coefs), qs.SCENARIO_NAMES, "probability", "target", watched)


@query("data_quality", "M37,A20", sql=lambda: sql_customer_split() + f""",
tr AS (SELECT * FROM msplit WHERE split = 'train'),
rates AS (SELECT * FROM (SELECT {', '.join(f'avg(CAST({f} IS NULL AS DOUBLE)) AS {f}' for f in NUMERIC + CATEGORICAL)} FROM tr)
          UNPIVOT (rate FOR feature IN ({', '.join(NUMERIC + CATEGORICAL)}))),
checked AS (SELECT feature FROM rates WHERE rate < 0.02),
cells AS (SELECT sk_id_curr, split, {', '.join(f'CAST({f} IS NULL AS INTEGER) AS {f}' for f in NUMERIC + CATEGORICAL)} FROM msplit),
lc AS (SELECT * FROM cells UNPIVOT (is_null FOR feature IN ({', '.join(NUMERIC + CATEGORICAL)}))),
per AS (SELECT sk_id_curr, split, CAST(coalesce(sum(CASE WHEN c.feature IS NOT NULL THEN is_null ELSE 0 END), 0) AS INTEGER) AS unexpected_nulls
        FROM lc LEFT JOIN checked c USING (feature) GROUP BY sk_id_curr, split)
SELECT sk_id_curr, split, unexpected_nulls,
  CASE WHEN unexpected_nulls > 30 THEN 'low' WHEN unexpected_nulls > 8 THEN 'medium' ELSE 'high' END AS confidence
FROM per""")
def q_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M37 in batch: per customer, NULLs in fields that training rarely leaves
    empty (< 2 %) and the resulting confidence level."""
    from lendspark.operators import quality

    s, train, _ = binned_train(spark, sf_dir)
    feats = NUMERIC + CATEGORICAL
    rates = quality.missing_rates(train, feats).collect()          # one row per feature
    checked = [r["column_name"] for r in rates if r["missing_rate"] < quality.RARE_NULL_RATE]
    out = quality.confidence(s, checked)
    return out.select("sk_id_curr", "split", F.size("unexpected_nulls").alias("unexpected_nulls"), "confidence")

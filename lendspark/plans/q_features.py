"""Feature-build queries (A8–A13, P1–P7, A19, A20, S8) and their oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.operators import features as feat
from lendspark.operators import quality
from lendspark.plans.artefacts import bucketed
from lendspark.plans.oracle import fx, r, ratio
from lendspark.plans.registry import query
from lendspark.sources import fixtures


def tables(spark: SparkSession, sf_dir: str, *roles: str) -> dict[str, DataFrame]:
    return {role: fixtures.load(spark, sf_dir, role) for role in roles}


RAW_ROLES = ("bureau", "bureau_balance", "previous", "installments", "pos_cash", "credit_card")


def build_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "application", *RAW_ROLES)
    return feat.model_input(t["application"], *feat.build_summaries(t))


SUMMARIES = ("bureau", "previous", "installments", "pos_cash", "credit_card")     # in the order of build_summaries


def stored_model_input(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """The model input from applications and summaries that are published in buckets of the customer key, once for all
    jobs. ``buckets`` (the session's shuffle partitions unless given) fits the data: some 200 MB of the widest table each."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = tables(spark, sf_dir, "application", *RAW_ROLES)
    rollups = feat.build_summaries(t)
    stored = [bucketed(spark, sf_dir, f"summary_{name}", feat.KEY, n, lambda d=d: d) for name, d in zip(SUMMARIES, rollups, strict=True)]
    application = bucketed(spark, sf_dir, "application", feat.KEY, n, lambda: t["application"])
    return feat.model_input(application, *stored, bucketed=True)


# --- oracle texts ---------------------------------------------------------------

def sql_bureau_cte() -> str:
    return f"""bb AS (
  SELECT sk_id_bureau, count(*) AS bb_months,
    count_if(status IN ('1','2','3','4','5')) AS bb_dpd_months,
    count_if(status IN ('3','4','5')) AS bb_severe_dpd_months,
    max(CASE WHEN regexp_full_match(status, '[0-9]') THEN CAST(status AS INTEGER) END) AS bb_worst_status
  FROM fx_bureau_balance GROUP BY sk_id_bureau
),
bureau_agg AS (
  SELECT sk_id_curr,
    count(*) AS bureau_credit_count,
    count_if(credit_active = 'Active') AS bureau_active_count,
    count_if(credit_active = 'Closed') AS bureau_closed_count,
    count_if(credit_active IN ('Sold', 'Bad debt')) AS bureau_bad_count,
    count(DISTINCT credit_type) AS bureau_type_count,
    sum(amt_credit_sum) AS bureau_amt_sum,
    sum(amt_credit_sum_debt) AS bureau_debt_sum,
    sum(amt_credit_sum_overdue) AS bureau_overdue_sum,
    {ratio('sum(amt_credit_sum_debt)', 'sum(amt_credit_sum)', 4)} AS bureau_debt_ratio,
    max(credit_day_overdue) AS bureau_max_overdue_days,
    count_if(credit_day_overdue > 0) AS bureau_overdue_credit_count,
    CAST(sum(cnt_credit_prolong) AS BIGINT) AS bureau_prolong_sum,
    max(days_credit) AS bureau_days_since_last,
    min(days_credit) AS bureau_days_since_first,
    CAST(sum(bb_months) AS BIGINT) AS bb_total_months,
    CAST(sum(bb_dpd_months) AS BIGINT) AS bb_dpd_months,
    CAST(sum(bb_severe_dpd_months) AS BIGINT) AS bb_severe_dpd_months,
    max(bb_worst_status) AS bb_worst_status,
    {ratio('sum(bb_dpd_months)', 'sum(bb_months)', 4)} AS bb_dpd_ratio
  FROM fx_bureau LEFT JOIN bb USING (sk_id_bureau)
  GROUP BY sk_id_curr
)"""


def sql_previous_cte() -> str:
    refused = "name_contract_status = 'Refused'"
    return f"""previous_agg AS (
  SELECT sk_id_curr,
    count(*) AS prev_app_count,
    count_if(name_contract_status = 'Approved') AS prev_approved_count,
    count_if({refused}) AS prev_refused_count,
    count_if(name_contract_status = 'Canceled') AS prev_canceled_count,
    count_if(name_contract_status = 'Unused offer') AS prev_unused_count,
    {ratio(f'count_if({refused})', 'count(*)', 4)} AS prev_refused_ratio,
    count_if({refused} AND days_decision > -365) AS prev_refused_last_year,
    max(days_decision) AS prev_days_since_last,
    min(days_decision) AS prev_days_since_first,
    max(CASE WHEN {refused} THEN days_decision END) AS prev_days_since_last_refusal,
    sum(amt_application) AS prev_amt_application_sum,
    sum(amt_credit) AS prev_amt_credit_sum,
    avg(amt_annuity) AS prev_amt_annuity_avg,
    {ratio('sum(amt_credit)', 'sum(amt_application)', 4)} AS prev_credit_to_application_ratio,
    avg(rate_down_payment) AS prev_down_payment_rate_avg,
    avg(cnt_payment) AS prev_term_avg,
    count_if(name_contract_type = 'Cash loans') AS prev_cash_count,
    count_if(name_contract_type = 'Consumer loans') AS prev_consumer_count,
    count_if(name_contract_type = 'Revolving loans') AS prev_revolving_count,
    count_if(code_reject_reason = 'HC') AS prev_reject_hc,
    count_if(code_reject_reason = 'LIMIT') AS prev_reject_limit,
    count_if(code_reject_reason = 'SCO') AS prev_reject_sco,
    avg(nflag_insured_on_approval) AS prev_insured_ratio
  FROM fx_previous_application GROUP BY sk_id_curr
)"""


def sql_installments_cte() -> str:
    return f"""inst_rows AS (
  SELECT sk_id_curr, days_instalment, amt_instalment, amt_payment,
    greatest(days_entry_payment - days_instalment, 0) AS dpd,
    days_entry_payment IS NULL AS unpaid,
    amt_payment < amt_instalment - 1 AS underpaid
  FROM fx_installments
),
inst_agg AS (
  SELECT sk_id_curr,
    count(*) AS inst_count,
    count_if(dpd > 0) AS inst_late_count,
    count_if(dpd > 30) AS inst_late30_count,
    {ratio('count_if(dpd > 0)', 'count(*)', 4)} AS inst_late_ratio,
    {ratio('count_if(dpd > 30)', 'count(*)', 4)} AS inst_late30_ratio,
    max(dpd) AS inst_dpd_max,
    {r('avg(dpd)', 2)} AS inst_dpd_avg,
    count_if(unpaid) AS inst_unpaid_count,
    count_if(underpaid) AS inst_underpaid_count,
    {ratio('count_if(underpaid)', 'count(*)', 4)} AS inst_underpaid_ratio,
    sum(amt_instalment) AS inst_amt_due_sum,
    sum(amt_payment) AS inst_amt_paid_sum,
    {ratio('sum(amt_payment)', 'sum(amt_instalment)', 4)} AS inst_payment_ratio,
    count_if(days_instalment > -365) AS inst_count_1y,
    count_if(days_instalment > -365 AND dpd > 0) AS inst_late_count_1y,
    {ratio('count_if(days_instalment > -365 AND dpd > 0)', 'count_if(days_instalment > -365)', 4)} AS inst_late_ratio_1y
  FROM inst_rows GROUP BY sk_id_curr
)"""


def sql_pos_cte() -> str:
    return f"""pos_agg AS (
  SELECT sk_id_curr,
    count(*) AS pos_month_count,
    count(DISTINCT sk_id_prev) AS pos_contract_count,
    count_if(sk_dpd > 0) AS pos_dpd_months,
    count_if(sk_dpd > 30) AS pos_dpd30_months,
    {ratio('count_if(sk_dpd > 0)', 'count(*)', 4)} AS pos_dpd_ratio,
    max(sk_dpd) AS pos_dpd_max,
    max(sk_dpd_def) AS pos_dpd_def_max,
    count_if(name_contract_status = 'Active') AS pos_active_months,
    count_if(name_contract_status = 'Completed') AS pos_completed_months,
    count_if(name_contract_status = 'Demand') AS pos_demand_months,
    avg(cnt_instalment) AS pos_term_avg,
    avg(cnt_instalment_future) AS pos_remaining_avg,
    max(months_balance) AS pos_months_since_last,
    count_if(months_balance > -12) AS pos_months_1y,
    count_if(months_balance > -12 AND sk_dpd > 0) AS pos_dpd_months_1y,
    {ratio('count_if(months_balance > -12 AND sk_dpd > 0)', 'count_if(months_balance > -12)', 4)} AS pos_dpd_ratio_1y
  FROM fx_pos_cash GROUP BY sk_id_curr
)"""


def sql_card_cte() -> str:
    return f"""card_rows AS (
  SELECT *, CASE WHEN amt_credit_limit_actual > 0 THEN amt_balance / amt_credit_limit_actual END AS utilization
  FROM fx_credit_card
),
card_agg AS (
  SELECT sk_id_curr,
    count(*) AS cc_month_count,
    count(DISTINCT sk_id_prev) AS cc_card_count,
    {r('avg(utilization)', 4)} AS cc_utilization_avg,
    {r('max(utilization)', 4)} AS cc_utilization_max,
    count_if(amt_balance > amt_credit_limit_actual) AS cc_over_limit_months,
    sum(amt_drawings_atm_current) AS cc_atm_drawings_sum,
    sum(amt_drawings_current) AS cc_drawings_sum,
    {ratio('sum(amt_drawings_atm_current)', 'sum(amt_drawings_current)', 4)} AS cc_atm_drawings_ratio,
    {ratio('sum(amt_payment_current)', 'sum(amt_inst_min_regularity)', 4)} AS cc_payment_to_min_ratio,
    count_if(amt_payment_current = 0 OR amt_payment_current IS NULL) AS cc_zero_payment_months,
    avg(amt_balance) AS cc_balance_avg,
    max(amt_balance) AS cc_balance_max,
    avg(amt_credit_limit_actual) AS cc_limit_avg,
    count_if(sk_dpd > 0) AS cc_dpd_months,
    {ratio('count_if(sk_dpd > 0)', 'count(*)', 4)} AS cc_dpd_ratio,
    max(sk_dpd) AS cc_dpd_max,
    max(sk_dpd_def) AS cc_dpd_def_max,
    count_if(name_contract_status = 'Active') AS cc_active_months,
    max(months_balance) AS cc_months_since_last,
    {r('avg(CASE WHEN months_balance > -12 THEN utilization END)', 4)} AS cc_utilization_avg_1y,
    count_if(months_balance > -12 AND sk_dpd > 0) AS cc_dpd_months_1y
  FROM card_rows GROUP BY sk_id_curr
)"""


def sql_ratios_select() -> str:
    emp = "days_employed = 365243"
    n_ext = ("(CAST(ext_source_1 IS NOT NULL AS INTEGER) + CAST(ext_source_2 IS NOT NULL AS INTEGER)"
             " + CAST(ext_source_3 IS NOT NULL AS INTEGER))")
    ext_sum = "(coalesce(ext_source_1, 0.0) + coalesce(ext_source_2, 0.0) + coalesce(ext_source_3, 0.0))"
    return f"""a.*,
    {ratio('amt_credit', 'amt_income_total', 4)} AS credit_income_ratio,
    {ratio('amt_annuity', 'amt_income_total', 4)} AS annuity_income_ratio,
    {ratio('amt_credit', 'amt_goods_price', 4)} AS credit_goods_ratio,
    {ratio('amt_credit', 'amt_annuity', 2)} AS credit_term,
    {ratio('amt_income_total', 'cnt_fam_members', 2)} AS income_per_person,
    {r('-CAST(days_birth AS DOUBLE) / 365.25', 1)} AS age_years,
    CASE WHEN NOT ({emp}) THEN {r('-CAST(days_employed AS DOUBLE) / 365.25', 1)} END AS employed_years,
    ({emp}) AS flag_not_employed,
    CASE WHEN NOT ({emp}) THEN {ratio('days_employed', 'days_birth', 4)} END AS employed_life_ratio,
    {r(f'{ext_sum} / NULLIF(CAST({n_ext} AS DOUBLE), 0)', 4)} AS ext_source_mean,
    least(ext_source_1, ext_source_2, ext_source_3) AS ext_source_min,
    greatest(ext_source_1, ext_source_2, ext_source_3) AS ext_source_max,
    {n_ext} AS ext_source_count"""


def sql_model_input_body() -> str:
    return (fx("fx_application", "fx_bureau", "fx_bureau_balance", "fx_previous_application",
               "fx_installments", "fx_pos_cash", "fx_credit_card") + ",\n"
            + ",\n".join([sql_bureau_cte(), sql_previous_cte(), sql_installments_cte(), sql_pos_cte(), sql_card_cte()])
            + ",\nmodel_input AS (\n  SELECT " + sql_ratios_select() + """,
    b.* EXCLUDE (sk_id_curr), p.* EXCLUDE (sk_id_curr), i.* EXCLUDE (sk_id_curr),
    s.* EXCLUDE (sk_id_curr), c.* EXCLUDE (sk_id_curr)
  FROM fx_application a
  LEFT JOIN bureau_agg b USING (sk_id_curr)
  LEFT JOIN previous_agg p USING (sk_id_curr)
  LEFT JOIN inst_agg i USING (sk_id_curr)
  LEFT JOIN pos_agg s USING (sk_id_curr)
  LEFT JOIN card_agg c USING (sk_id_curr)
)\n""")


# --- queries ----------------------------------------------------------------------

@query("bureau_rollup", "A1-A8,J1,P12,P13",
       sql=lambda: fx("fx_bureau", "fx_bureau_balance") + ",\n" + sql_bureau_cte() + "\nSELECT * FROM bureau_agg")
def q_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "bureau", "bureau_balance")
    return feat.bureau_agg(t["bureau"], t["bureau_balance"])


@query("previous_rollup", "A2,A3,A5,A6,A9,P13",
       sql=lambda: fx("fx_previous_application") + ",\n" + sql_previous_cte() + "\nSELECT * FROM previous_agg")
def q_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.previous_app_agg(fixtures.load(spark, sf_dir, "previous"))


@query("installment_rollup", "A7,A10,P8-P10",
       sql=lambda: fx("fx_installments") + ",\n" + sql_installments_cte() + "\nSELECT * FROM inst_agg")
def q_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.installments_agg(fixtures.load(spark, sf_dir, "installments"))


@query("pos_rollup", "A4,A11",
       sql=lambda: fx("fx_pos_cash") + ",\n" + sql_pos_cte() + "\nSELECT * FROM pos_agg")
def q_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.pos_cash_agg(fixtures.load(spark, sf_dir, "pos_cash"))


@query("card_rollup", "A3,A12,P11",
       sql=lambda: fx("fx_credit_card") + ",\n" + sql_card_cte() + "\nSELECT * FROM card_agg")
def q_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.credit_card_agg(fixtures.load(spark, sf_dir, "credit_card"))


@query("row_ratios", "P1-P7",
       sql=lambda: fx("fx_application") + "\nSELECT " + sql_ratios_select() + "\nFROM fx_application a")
def q_row_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.row_ratios(fixtures.load(spark, sf_dir, "application"))


@query("model_input", "A13,J2,P1-P7",
       sql=lambda: sql_model_input_body() + "SELECT * FROM model_input")
def q_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_model_input(spark, sf_dir)


@query("model_input_stored", "A13,J2",
       sql=lambda: sql_model_input_body() + "SELECT * FROM model_input")
def q_model_input_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_model_input(spark, sf_dir)


@query("missing_rates", "A20",
       sql=lambda: sql_model_input_body() + """SELECT column_name, CAST(missing_rate AS DOUBLE) AS missing_rate
FROM (UNPIVOT (SELECT avg(CAST(COLUMNS(*) IS NULL AS DOUBLE)) FROM model_input)
      ON COLUMNS(*) INTO NAME column_name VALUE missing_rate)""")
def q_missing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_rates(stored_model_input(spark, sf_dir))


@query("unique_key_check", "S8,S10",
       sql=lambda: sql_model_input_body() + """SELECT 'model_input' AS name, count(*) AS rows,
  count(*) - count(DISTINCT sk_id_curr) + count_if(sk_id_curr IS NULL) AS key_violations
FROM model_input""")
def q_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_report(stored_model_input(spark, sf_dir), "sk_id_curr", "model_input")

"""Customer-level feature rollups (A8–A13): one wide row per customer.

Every rollup is one hash aggregate with many conditional measures (a single
scan, partial aggregation before the shuffle, so a hot customer key is
pre-combined map-side). Groups finer than customers, credits with their months
and contracts, are dealt as narrow rows and aggregated behind the shuffle
(``dealt``). The monthly credit history is aggregated to one row per
credit *before* it meets the credit table, so the join never sees month rows.
Missing history stays NULL (LEFT joins; no imputation).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.exprs import (
    EMPLOYMENT_SENTINEL,
    digit_code,
    nonnull_count,
    round_half_up,
    row_mean,
    safe_ratio,
    years_from_days,
)

KEY = "sk_id_curr"

# Fixed values (status and category codes of the source data).
DPD_STATUSES = ["1", "2", "3", "4", "5"]
SEVERE_DPD_STATUSES = ["3", "4", "5"]
BAD_CREDIT_STATES = ["Sold", "Bad debt"]
ONE_YEAR_DAYS = -365
ONE_YEAR_MONTHS = -12


def n_rows() -> Column:
    return F.count(F.lit(1))


def n_where(cond: Column) -> Column:
    """count(*) FILTER (WHERE cond): NULL conditions are not counted; 0 when none."""
    return F.count_if(cond)


def dealt(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """The columns that a rollup reads, shuffled by the keys of its finest groups. These have few rows in any one task of
    the scan: partial aggregates there, a buffer for every measure and group, are wider than the rows themselves and
    spill with the size of the task. Behind the shuffle a group's rows are together."""
    return rows.select(*keys, *columns).repartition(*keys)


def bureau_month_rollup(bureau_balance: DataFrame) -> DataFrame:
    """First level of A8: month rows → one row per credit."""
    status = F.col("status")
    return dealt(bureau_balance, ["sk_id_bureau"], "status").groupBy("sk_id_bureau").agg(
        n_rows().alias("bb_months"),
        n_where(status.isin(*DPD_STATUSES)).alias("bb_dpd_months"),
        n_where(status.isin(*SEVERE_DPD_STATUSES)).alias("bb_severe_dpd_months"),
        F.max(digit_code(status)).alias("bb_worst_status"),
    )


def bureau_agg(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    """Two-level rollup month → credit → customer (19 features)."""
    per_credit = bureau.join(bureau_month_rollup(bureau_balance), "sk_id_bureau", "left")
    active = F.col("credit_active")
    debt, amt = F.sum("amt_credit_sum_debt"), F.sum("amt_credit_sum")
    return per_credit.groupBy(KEY).agg(
        n_rows().alias("bureau_credit_count"),
        n_where(active == "Active").alias("bureau_active_count"),
        n_where(active == "Closed").alias("bureau_closed_count"),
        n_where(active.isin(*BAD_CREDIT_STATES)).alias("bureau_bad_count"),
        F.countDistinct("credit_type").alias("bureau_type_count"),
        amt.alias("bureau_amt_sum"),
        debt.alias("bureau_debt_sum"),
        F.sum("amt_credit_sum_overdue").alias("bureau_overdue_sum"),
        safe_ratio(debt, amt, 4).alias("bureau_debt_ratio"),
        F.max("credit_day_overdue").alias("bureau_max_overdue_days"),
        n_where(F.col("credit_day_overdue") > 0).alias("bureau_overdue_credit_count"),
        F.sum("cnt_credit_prolong").alias("bureau_prolong_sum"),
        F.max("days_credit").alias("bureau_days_since_last"),
        F.min("days_credit").alias("bureau_days_since_first"),
        F.sum("bb_months").alias("bb_total_months"),
        F.sum("bb_dpd_months").alias("bb_dpd_months"),
        F.sum("bb_severe_dpd_months").alias("bb_severe_dpd_months"),
        F.max("bb_worst_status").alias("bb_worst_status"),
        safe_ratio(F.sum("bb_dpd_months"), F.sum("bb_months"), 4).alias("bb_dpd_ratio"),
    )


def previous_app_agg(previous: DataFrame) -> DataFrame:
    """The institution's own application history (23 features)."""
    status, ctype, reason = F.col("name_contract_status"), F.col("name_contract_type"), F.col("code_reject_reason")
    refused = status == "Refused"
    return previous.groupBy(KEY).agg(
        n_rows().alias("prev_app_count"),
        n_where(status == "Approved").alias("prev_approved_count"),
        n_where(refused).alias("prev_refused_count"),
        n_where(status == "Canceled").alias("prev_canceled_count"),
        n_where(status == "Unused offer").alias("prev_unused_count"),
        safe_ratio(n_where(refused), n_rows(), 4).alias("prev_refused_ratio"),
        n_where(refused & (F.col("days_decision") > ONE_YEAR_DAYS)).alias("prev_refused_last_year"),
        F.max("days_decision").alias("prev_days_since_last"),
        F.min("days_decision").alias("prev_days_since_first"),
        F.max(F.when(refused, F.col("days_decision"))).alias("prev_days_since_last_refusal"),
        F.sum("amt_application").alias("prev_amt_application_sum"),
        F.sum("amt_credit").alias("prev_amt_credit_sum"),
        F.avg("amt_annuity").alias("prev_amt_annuity_avg"),
        safe_ratio(F.sum("amt_credit"), F.sum("amt_application"), 4).alias("prev_credit_to_application_ratio"),
        F.avg("rate_down_payment").alias("prev_down_payment_rate_avg"),
        F.avg("cnt_payment").alias("prev_term_avg"),
        n_where(ctype == "Cash loans").alias("prev_cash_count"),
        n_where(ctype == "Consumer loans").alias("prev_consumer_count"),
        n_where(ctype == "Revolving loans").alias("prev_revolving_count"),
        n_where(reason == "HC").alias("prev_reject_hc"),
        n_where(reason == "LIMIT").alias("prev_reject_limit"),
        n_where(reason == "SCO").alias("prev_reject_sco"),
        F.avg("nflag_insured_on_approval").alias("prev_insured_ratio"),
    )


def installments_agg(installments: DataFrame) -> DataFrame:
    """A10: instalment behaviour (16 features).

    Days past due is ``greatest(paid - due, 0)``; an unpaid instalment (paid day
    NULL) therefore has dpd 0 and is *not late* — it only counts as unpaid.
    """
    t = installments.select(
        KEY, "days_instalment", "amt_instalment", "amt_payment",
        F.greatest(F.col("days_entry_payment") - F.col("days_instalment"), F.lit(0)).alias("dpd"),
        F.col("days_entry_payment").isNull().alias("unpaid"),
        (F.col("amt_payment") < F.col("amt_instalment") - 1).alias("underpaid"),
    )
    dpd, recent = F.col("dpd"), F.col("days_instalment") > ONE_YEAR_DAYS
    return t.groupBy(KEY).agg(
        n_rows().alias("inst_count"),
        n_where(dpd > 0).alias("inst_late_count"),
        n_where(dpd > 30).alias("inst_late30_count"),
        safe_ratio(n_where(dpd > 0), n_rows(), 4).alias("inst_late_ratio"),
        safe_ratio(n_where(dpd > 30), n_rows(), 4).alias("inst_late30_ratio"),
        F.max("dpd").alias("inst_dpd_max"),
        round_half_up(F.avg("dpd"), 2).alias("inst_dpd_avg"),
        n_where(F.col("unpaid")).alias("inst_unpaid_count"),
        n_where(F.col("underpaid")).alias("inst_underpaid_count"),
        safe_ratio(n_where(F.col("underpaid")), n_rows(), 4).alias("inst_underpaid_ratio"),
        F.sum("amt_instalment").alias("inst_amt_due_sum"),
        F.sum("amt_payment").alias("inst_amt_paid_sum"),
        safe_ratio(F.sum("amt_payment"), F.sum("amt_instalment"), 4).alias("inst_payment_ratio"),
        n_where(recent).alias("inst_count_1y"),
        n_where(recent & (dpd > 0)).alias("inst_late_count_1y"),
        safe_ratio(n_where(recent & (dpd > 0)), n_where(recent), 4).alias("inst_late_ratio_1y"),
    )


def pos_cash_agg(pos: DataFrame) -> DataFrame:
    """Point-of-sale / cash loan monthly snapshots (16 features)."""
    dpd, status = F.col("sk_dpd"), F.col("name_contract_status")
    recent = F.col("months_balance") > ONE_YEAR_MONTHS
    rows = dealt(pos, [KEY, "sk_id_prev"], "months_balance", "cnt_instalment", "cnt_instalment_future", "name_contract_status", "sk_dpd", "sk_dpd_def")
    return rows.groupBy(KEY).agg(
        n_rows().alias("pos_month_count"),
        F.countDistinct("sk_id_prev").alias("pos_contract_count"),
        n_where(dpd > 0).alias("pos_dpd_months"),
        n_where(dpd > 30).alias("pos_dpd30_months"),
        safe_ratio(n_where(dpd > 0), n_rows(), 4).alias("pos_dpd_ratio"),
        F.max("sk_dpd").alias("pos_dpd_max"),
        F.max("sk_dpd_def").alias("pos_dpd_def_max"),
        n_where(status == "Active").alias("pos_active_months"),
        n_where(status == "Completed").alias("pos_completed_months"),
        n_where(status == "Demand").alias("pos_demand_months"),
        F.avg("cnt_instalment").alias("pos_term_avg"),
        F.avg("cnt_instalment_future").alias("pos_remaining_avg"),
        F.max("months_balance").alias("pos_months_since_last"),
        n_where(recent).alias("pos_months_1y"),
        n_where(recent & (dpd > 0)).alias("pos_dpd_months_1y"),
        safe_ratio(n_where(recent & (dpd > 0)), n_where(recent), 4).alias("pos_dpd_ratio_1y"),
    )


def credit_card_agg(card: DataFrame) -> DataFrame:
    """Credit-card monthly balances (21 features).

    Utilisation is per row and only where the limit is positive; the over-limit
    count compares balance with limit also when the limit is 0.
    """
    limit = F.col("amt_credit_limit_actual")
    t = card.withColumn("utilization", F.when(limit > 0, F.col("amt_balance") / limit))
    dpd, recent = F.col("sk_dpd"), F.col("months_balance") > ONE_YEAR_MONTHS
    pay = F.col("amt_payment_current")
    return t.groupBy(KEY).agg(
        n_rows().alias("cc_month_count"),
        F.countDistinct("sk_id_prev").alias("cc_card_count"),
        round_half_up(F.avg("utilization"), 4).alias("cc_utilization_avg"),
        round_half_up(F.max("utilization"), 4).alias("cc_utilization_max"),
        n_where(F.col("amt_balance") > limit).alias("cc_over_limit_months"),
        F.sum("amt_drawings_atm_current").alias("cc_atm_drawings_sum"),
        F.sum("amt_drawings_current").alias("cc_drawings_sum"),
        safe_ratio(F.sum("amt_drawings_atm_current"), F.sum("amt_drawings_current"), 4).alias("cc_atm_drawings_ratio"),
        safe_ratio(F.sum("amt_payment_current"), F.sum("amt_inst_min_regularity"), 4).alias("cc_payment_to_min_ratio"),
        n_where((pay == 0) | pay.isNull()).alias("cc_zero_payment_months"),
        F.avg("amt_balance").alias("cc_balance_avg"),
        F.max("amt_balance").alias("cc_balance_max"),
        F.avg("amt_credit_limit_actual").alias("cc_limit_avg"),
        n_where(dpd > 0).alias("cc_dpd_months"),
        safe_ratio(n_where(dpd > 0), n_rows(), 4).alias("cc_dpd_ratio"),
        F.max("sk_dpd").alias("cc_dpd_max"),
        F.max("sk_dpd_def").alias("cc_dpd_def_max"),
        n_where(F.col("name_contract_status") == "Active").alias("cc_active_months"),
        F.max("months_balance").alias("cc_months_since_last"),
        round_half_up(F.avg(F.when(recent, F.col("utilization"))), 4).alias("cc_utilization_avg_1y"),
        n_where(recent & (dpd > 0)).alias("cc_dpd_months_1y"),
    )


EXT_SOURCES = ["ext_source_1", "ext_source_2", "ext_source_3"]

RATIO_COLUMNS = [
    "credit_income_ratio", "annuity_income_ratio", "credit_goods_ratio", "credit_term", "income_per_person",
    "age_years", "employed_years", "flag_not_employed", "employed_life_ratio",
    "ext_source_mean", "ext_source_min", "ext_source_max", "ext_source_count",
]


def row_ratios(app: DataFrame) -> DataFrame:
    """The 13 row-level ratios appended to the application columns."""
    employed = F.col("days_employed")
    sentinel = employed == EMPLOYMENT_SENTINEL
    return app.withColumns({
        "credit_income_ratio": safe_ratio("amt_credit", "amt_income_total", 4),
        "annuity_income_ratio": safe_ratio("amt_annuity", "amt_income_total", 4),
        "credit_goods_ratio": safe_ratio("amt_credit", "amt_goods_price", 4),
        "credit_term": safe_ratio("amt_credit", "amt_annuity", 2),
        "income_per_person": safe_ratio("amt_income_total", "cnt_fam_members", 2),
        "age_years": years_from_days("days_birth", 1),
        "employed_years": F.when(~sentinel, years_from_days(employed, 1)),
        "flag_not_employed": sentinel,
        "employed_life_ratio": F.when(~sentinel, safe_ratio(employed, "days_birth", 4)),
        "ext_source_mean": round_half_up(row_mean(EXT_SOURCES), 4),
        "ext_source_min": F.least(*[F.col(c) for c in EXT_SOURCES]),
        "ext_source_max": F.greatest(*[F.col(c) for c in EXT_SOURCES]),
        "ext_source_count": nonnull_count(EXT_SOURCES),
    })


def model_input(application: DataFrame, *summaries: DataFrame, bucketed: bool = False) -> DataFrame:
    """Application + every summary (LEFT, one key copy) + row ratios.

    All summaries come out of an aggregate hash-partitioned on the customer key,
    so the chain of joins shuffles only the application side; AQE turns a side
    into a broadcast only when its runtime size is under the threshold. With
    ``bucketed``, all tables are stored in the same buckets of the key: bucket
    meets bucket in a merge join, and no side is shuffled or broadcast.
    """
    out = row_ratios(application)
    for s in summaries:
        out = out.join(s.hint("merge") if bucketed else s, KEY, "left")
    return out


def build_summaries(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The five rollups from the raw (stand-in) tables, in the canonical order."""
    return [
        bureau_agg(tables["bureau"], tables["bureau_balance"]),
        previous_app_agg(tables["previous"]),
        installments_agg(tables["installments"]),
        pos_cash_agg(tables["pos_cash"]),
        credit_card_agg(tables["credit_card"]),
    ]

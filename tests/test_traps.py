"""Semantic traps T1–T14 on hand-made micro frames."""
import pytest
from pyspark.sql import functions as F

from lendspark.functions.exprs import band, capped, round_half_up
from lendspark.operators import features as feat
from lendspark.operators import monitoring as mon
from lendspark.operators import profit as prof


def test_t1_unpaid_is_not_late(spark):
    inst = spark.createDataFrame([(1, -10, None, 100.0, None), (1, -20, -5, 100.0, 100.0), (1, -30, -40, 100.0, 50.0)],
                                 "sk_id_curr long, days_instalment int, days_entry_payment int, amt_instalment double, amt_payment double")
    r = feat.installments_agg(inst).first()
    assert r["inst_unpaid_count"] == 1 and r["inst_late_count"] == 1
    assert r["inst_dpd_avg"] == 5.0 and r["inst_underpaid_count"] == 1


def test_t2_t3_status_and_missing_history(spark):
    bureau = spark.createDataFrame([(1, 10, "Active", "x", -5, 0, 0, 10.0, 5.0, 0.0), (2, 20, "Closed", "y", -9, 0, 1, 10.0, 5.0, 0.0)],
                                   "sk_id_curr long, sk_id_bureau long, credit_active string, credit_type string, days_credit int, "
                                   "credit_day_overdue long, cnt_credit_prolong long, amt_credit_sum double, "
                                   "amt_credit_sum_debt double, amt_credit_sum_overdue double")
    bb = spark.createDataFrame([(10, -1, "C"), (10, -2, "X")], "sk_id_bureau long, months_balance long, status string")
    got = {r["sk_id_curr"]: r for r in feat.bureau_agg(bureau, bb).collect()}
    assert got[1]["bb_worst_status"] is None and got[1]["bb_total_months"] == 2
    assert got[2]["bb_total_months"] is None and got[2]["bb_dpd_ratio"] is None


def test_t6_t7_card_rules(spark):
    card = spark.createDataFrame([(1, 1, -1, 50.0, 0, 0.0, 0.0, 1.0, None, 0, 0, "Active"),
                                  (1, 1, -2, 5.0, 10, 0.0, 0.0, 1.0, 0.0, 0, 0, "Active")],
                                 "sk_id_curr long, sk_id_prev long, months_balance long, amt_balance double, "
                                 "amt_credit_limit_actual long, amt_drawings_atm_current double, amt_drawings_current double, "
                                 "amt_inst_min_regularity double, amt_payment_current double, sk_dpd long, sk_dpd_def long, "
                                 "name_contract_status string")
    r = feat.credit_card_agg(card).first()
    assert r["cc_zero_payment_months"] == 2 and r["cc_over_limit_months"] == 1
    assert r["cc_utilization_avg"] == 0.5


def test_t9_rounding_half_up(spark):
    r = spark.range(1).select(round_half_up(F.lit(1.005), 2).alias("a"), round_half_up(F.lit(-2.5), 0).alias("b")).first()
    assert r["a"] == 1.01 and r["b"] == -3.0


def test_t11_cap_keeps_null(spark):
    df = spark.createDataFrame([(None,), (2.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(capped("x", 2.0, 3.0)).collect()] == [None, 3.0, 1.0]


def test_t12_band_edges(spark):
    df = spark.createDataFrame([(0.02,), (0.05,), (0.1,), (0.2,)], "p double")
    right = [r[0] for r in df.select(band("p", mon.RISK_BAND_EDGES, mon.RISK_BAND_LABELS)).collect()]
    left = [r[0] for r in df.select(band("p", mon.ONLINE_BAND_EDGES, mon.RISK_BAND_LABELS, "left")).collect()]
    assert right == ["very low", "low", "medium", "high"]
    assert left == ["low", "medium", "high", "very high"]


def test_t14_strict_approval(spark):
    df = spark.createDataFrame([(0.5, 0, 100.0), (0.2, 1, 100.0)], "p double, y int, a double")
    r = {x["scenario"]: x for x in prof.profit_at(df, [], "p", "y", "a", {"at": F.lit(0.5)}).collect()}
    assert r["at"]["approved"] == 1 and r["at"]["profit"] == pytest.approx(-65.0)

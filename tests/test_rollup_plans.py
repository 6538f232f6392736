"""Credits and contracts are aggregated behind the shuffle of narrow rows, and count as plain Python does."""
from pyspark.sql import functions as F

from lendspark.operators import features as feat

STATES = ["Active", "Completed", "Demand", None]


def pos_rows(spark):
    i = F.col("id")
    return spark.range(400).select(
        F.when(i % 37 != 0, i % 9).alias("sk_id_curr"), F.when(i % 11 != 0, i % 30).alias("sk_id_prev"), (-(i % 20)).alias("months_balance"),
        (i % 7).cast("double").alias("cnt_instalment"), F.when(i % 3 != 0, (i % 5).cast("double")).alias("cnt_instalment_future"),
        F.element_at(F.array(*[F.lit(s) for s in STATES]), (i % 4 + 1).cast("int")).alias("name_contract_status"),
        (i % 50).alias("sk_dpd"), (i % 25).alias("sk_dpd_def"), F.lit("unread").alias("comment"))


def plan_of(df, spark):
    """Plan lines, top first, without adaptive execution's wrapping."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_contracts_are_shuffled_as_rows(spark):
    """Rows are shuffled by customer and contract, then one partial aggregate a customer and task."""
    lines = plan_of(feat.pos_cash_agg(pos_rows(spark)), spark)
    shuffles = [n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    assert [line for line in lines[shuffles[0]:shuffles[1]] if "Aggregate" in line]
    assert not [line for line in lines[shuffles[1]:] if "Aggregate" in line]
    assert "comment" not in lines[shuffles[1] + 1]


def test_months_are_shuffled_as_rows(spark):
    months = spark.range(60).select((F.col("id") % 7).alias("sk_id_bureau"), F.lit("1").alias("status"))
    lines = plan_of(feat.bureau_month_rollup(months), spark)
    at = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert not [line for line in lines[at:] if "Aggregate" in line]


def test_pos_rollup_counts(spark):
    rows = [r.asDict() for r in pos_rows(spark).collect()]
    found = {r["sk_id_curr"]: r for r in feat.pos_cash_agg(pos_rows(spark)).collect()}
    assert set(found) == {r["sk_id_curr"] for r in rows}
    for key, got in found.items():
        mine = [r for r in rows if r["sk_id_curr"] == key]
        assert got["pos_month_count"] == len(mine)
        assert got["pos_contract_count"] == len({r["sk_id_prev"] for r in mine} - {None})
        assert got["pos_dpd30_months"] == sum(r["sk_dpd"] > 30 for r in mine)
        assert got["pos_demand_months"] == sum(r["name_contract_status"] == "Demand" for r in mine)

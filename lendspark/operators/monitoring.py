"""Scored portfolio (M39) and the five monitoring views."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.functions.exprs import band, money_sum, round_half_up, text_or_nan
from lendspark.operators.histogram import exact_quantiles, qcut_index
from lendspark.operators.profit import LGD, MARGIN, realised_profit

# Fixed band definitions (edges and labels).
RISK_BAND_EDGES = [-0.001, 0.02, 0.05, 0.10, 0.20, 1.0]
RISK_BAND_LABELS = ["very low", "low", "medium", "high", "very high"]
ONLINE_BAND_EDGES = [0.0, 0.02, 0.05, 0.10, 0.20, 1.0]
AGE_BAND_EDGES = [0, 25, 35, 45, 55, 120]
AGE_BAND_LABELS = ["18-25", "26-35", "36-45", "46-55", "56+"]
INCOME_BAND_LABELS = ["very low", "low", "medium", "high", "very high"]
APPROVE, REJECT, REVIEW = "approve", "reject", "review"

SEGMENT_DIMENSIONS = {
    "age band": "age_band",
    "income band": "income_band",
    "education": "education",
    "family status": "family_status",
    "occupation": "occupation",
    "contract type": "contract_type",
    "gender": "gender",
}


def scored_portfolio(scored: DataFrame, applicants: DataFrame, score: str, threshold: float,
                     margin: float = MARGIN, lgd: float = LGD) -> DataFrame:
    """One row per scored application with split, probability, decile,
    risk band, decision, realised outcome, realised profit and segments.

    ``scored`` has id, sk_id_curr, target, amt_credit, split and the score;
    ``applicants`` has the application attributes + row ratios (one row per
    customer). The customer join is planned by AQE: broadcast when the
    applicant side is small at runtime, else a shuffle join with skew splits.
    """
    a = applicants.select(
        "sk_id_curr", "amt_income_total", "age_years", "flag_not_employed", "region_rating_client_w_city",
        F.col("code_gender").alias("gender"), F.col("name_education_type").alias("education"),
        F.col("name_family_status").alias("family_status"), F.col("occupation_type").alias("occupation"),
        F.col("name_contract_type").alias("contract_type"),
    )
    p = F.col(score).cast("double")
    d = scored.join(a, "sk_id_curr", "left").withColumn("_p", p)
    # 11 and 6 values; the scores' own need no join
    p_edges = sorted({r["quantile"] for r in exact_quantiles(scored, score, [i / 10 for i in range(11)]).collect()})
    inc_edges = sorted({r["quantile"] for r in exact_quantiles(d, "amt_income_total", [i / 5 for i in range(6)]).collect()})
    d = d.withColumn("edges", F.array(*[F.lit(float(x)) for x in p_edges]).cast("array<double>"))
    d = d.withColumn("risk_decile", qcut_index("_p", "edges"))
    d = d.withColumn("edges", F.array(*[F.lit(float(x)) for x in inc_edges]).cast("array<double>"))
    lab = F.element_at(F.array(*[F.lit(x) for x in INCOME_BAND_LABELS]), qcut_index("amt_income_total", "edges"))
    d = d.withColumn("income_band", F.when(F.col("amt_income_total").isNull(), F.lit("nan")).otherwise(lab)).drop("edges")
    approved = F.col("_p") < F.lit(threshold)
    out = d.select(
        "id", "sk_id_curr", "split",
        round_half_up(F.col("_p"), 6).alias("probability"),
        "risk_decile",
        text_or_nan(band("_p", RISK_BAND_EDGES, RISK_BAND_LABELS)).alias("risk_band"),
        F.when(approved, F.lit(APPROVE)).otherwise(F.lit(REJECT)).alias("decision"),
        F.col("target").alias("actual_default"),
        "amt_credit", "amt_income_total",
        realised_profit(approved, F.col("target") == 1, F.col("amt_credit"), margin, lgd).alias("realised_profit"),
        text_or_nan(band("age_years", AGE_BAND_EDGES, AGE_BAND_LABELS)).alias("age_band"),
        "income_band",
        *[text_or_nan(c).alias(c) for c in ("gender", "education", "family_status", "occupation", "contract_type")],
        F.col("region_rating_client_w_city").alias("region_rating"),
        F.col("flag_not_employed").alias("not_employed"),
    )
    return out


def _pct(c) -> F.Column:
    return round_half_up(F.lit(100.0) * c, 2)


def _is(c: str, v) -> F.Column:
    return (F.col(c) == F.lit(v)).cast("int")


def kpi_by_split(p: DataFrame) -> DataFrame:
    """A14."""
    appr, y = F.col("decision") == APPROVE, F.col("actual_default")
    return p.groupBy("split").agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if(appr).alias("approved"),
        _pct(F.avg(_is("decision", APPROVE))).alias("approval_rate"),
        _pct(F.avg(y)).alias("portfolio_default_rate"),
        _pct(F.avg(F.when(appr, y))).alias("default_among_approved"),
        _pct(F.avg(F.when(F.col("decision") == REJECT, y))).alias("default_among_rejected"),
        money_sum("realised_profit").alias("profit"),
        round_half_up(money_sum("realised_profit") / F.count(F.lit(1)), 0).alias("profit_per_application"),
        F.count_if((F.col("decision") == REJECT) & (y == 1)).alias("prevented_defaults"),
        F.count_if((F.col("decision") == REJECT) & (y == 0)).alias("lost_good_customers"),
    )


def bucket_performance(p: DataFrame) -> DataFrame:
    """Per split and risk decile; lift against the split's default rate
    (the correlated subquery becomes a window over the split)."""
    per = p.groupBy("split", "risk_decile").agg(
        F.count(F.lit(1)).alias("applications"),
        F.avg("probability").alias("_p"),
        F.avg("actual_default").alias("_y"),
        F.sum("actual_default").alias("_defaults"),
        money_sum("amt_credit").alias("total_credit"),
        money_sum("realised_profit").alias("profit"),
    )
    w = Window.partitionBy("split")
    split_rate = F.sum("_defaults").over(w) / F.sum("applications").over(w)
    return per.select(
        "split", "risk_decile", "applications",
        _pct(F.col("_p")).alias("mean_prediction"),
        _pct(F.col("_y")).alias("realised_default"),
        round_half_up(F.col("_y") / F.nullif(split_rate, F.lit(0.0)), 2).alias("lift"),
        _pct(F.col("_p") - F.col("_y")).alias("calibration_gap"),
        "total_credit", "profit",
    )


def segment_performance(p: DataFrame, dimensions: dict[str, str] | None = None) -> DataFrame:
    """Seven segment dimensions in long form from ONE scan (unpivot keeps
    the text 'nan' segments), then one grouped aggregate."""
    dims = dimensions or SEGMENT_DIMENSIONS
    long = p.select(
        "split", "decision", "actual_default", "realised_profit", "probability",
        F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(c).cast("string").alias("value"))
                            for name, c in dims.items()])).alias("d"),
    ).select("split", "decision", "actual_default", "realised_profit", "probability", "d.dimension", "d.value")
    y = F.col("actual_default")
    return long.groupBy("split", "dimension", "value").agg(
        F.count(F.lit(1)).alias("applications"),
        _pct(F.avg(_is("decision", APPROVE))).alias("approval_rate"),
        _pct(F.avg(y)).alias("realised_default"),
        _pct(F.avg("probability")).alias("mean_prediction"),
        _pct(F.avg(F.when(y == 0, _is("decision", REJECT)))).alias("good_rejection_rate"),
        money_sum("realised_profit").alias("profit"),
    )


def decision_matrix(p: DataFrame) -> DataFrame:
    """(split, decision, outcome) counts and amounts, labelled."""
    y, dec = F.col("actual_default"), F.col("decision")
    result = (F.when((dec == APPROVE) & (y == 0), F.lit("correct approval"))
              .when((dec == APPROVE) & (y == 1), F.lit("wrong approval (loss)"))
              .when((dec == REJECT) & (y == 1), F.lit("correct rejection (loss avoided)"))
              .otherwise(F.lit("wrong rejection (income lost)")))
    return p.groupBy("split", "decision", "actual_default").agg(
        F.first(F.when(y == 1, F.lit("defaulted")).otherwise(F.lit("repaid"))).alias("outcome"),
        F.first(result).alias("result"),
        F.count(F.lit(1)).alias("applications"),
        money_sum("amt_credit").alias("credit_amount"),
        money_sum("realised_profit").alias("profit_impact"),
    ).drop("actual_default")


def risk_band_summary(p: DataFrame) -> DataFrame:
    """Per split and risk band, with the band's share of the split."""
    per = p.groupBy("split", "risk_band").agg(
        F.count(F.lit(1)).alias("applications"),
        F.avg("actual_default").alias("_y"),
        F.avg(_is("decision", APPROVE)).alias("_a"),
        (money_sum("amt_credit") / F.count(F.lit(1))).alias("_c"),
        money_sum("realised_profit").alias("profit"),
    )
    share = F.col("applications") / F.sum("applications").over(Window.partitionBy("split"))
    return per.select(
        "split", "risk_band", "applications",
        _pct(share).alias("share_pct"),
        _pct(F.col("_y")).alias("realised_default"),
        _pct(F.col("_a")).alias("approval_rate"),
        round_half_up(F.col("_c"), 0).alias("avg_credit"),
        "profit",
    )


def view_counts(views: dict[str, DataFrame]) -> DataFrame:
    """Row count of every view (all must be non-empty)."""
    from lendspark.sources.tables import row_counts

    return row_counts(views)

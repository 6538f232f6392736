"""Stand-in lending tables derived from the star-schema test tables.

The same view text runs in Spark SQL and in DuckDB (the oracle); only the
``DAYS(x)`` macro (day offset from 2002-01-01) differs per engine. Table
references are written ``{name}`` and bound to DataFrames on the Spark side
(``spark.sql(text, name=df)``), so no global temp view is created and column
pruning reaches the parquet scans.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lendspark.sources.tables import read_table

_DAYS = re.compile(r"DAYS\(([^()]*)\)")

VIEWS: dict[str, str] = {
    "fx_application": """
SELECT c_custkey AS sk_id_curr, CAST(c_acctbal < 0 AS INT) AS target,
  c_mktsegment AS name_contract_type,
  CASE WHEN c_custkey % 97 = 0 THEN 'XNA' WHEN c_custkey % 3 = 1 THEN 'M' ELSE 'F' END AS code_gender,
  CASE c_nationkey % 4 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single' WHEN 2 THEN 'Widow' ELSE 'Separated' END AS name_family_status,
  CASE c_custkey % 5 WHEN 0 THEN 'Higher' WHEN 1 THEN 'Lower' ELSE 'Secondary' END AS name_education_type,
  CASE WHEN c_custkey % 10 < 3 THEN NULL ELSE concat('occ', CAST(c_custkey % 18 AS VARCHAR(4))) END AS occupation_type,
  c_custkey % 4 AS cnt_children, CAST(c_custkey % 6 AS DOUBLE) AS cnt_fam_members,
  CAST(25000 + (c_custkey * 7919) % 400000 AS DOUBLE) AS amt_income_total,
  CAST(45000 + (c_custkey * 104729) % 900000 AS DOUBLE) AS amt_credit,
  CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(2500 + (c_custkey * 31337) % 60000 AS DOUBLE) END AS amt_annuity,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(40000 + (c_custkey * 104729) % 800000 AS DOUBLE) END AS amt_goods_price,
  -(7700 + (c_custkey * 6007) % 17500) AS days_birth,
  CASE WHEN c_custkey % 11 IN (0, 5) THEN 365243 ELSE -((c_custkey * 613) % 12000) END AS days_employed,
  CASE WHEN c_custkey % 25 < 14 THEN NULL ELSE CAST((c_custkey * 7907) % 1000 AS DOUBLE) / 1000 END AS ext_source_1,
  CASE WHEN c_custkey % 100 = 0 THEN NULL ELSE CAST((c_custkey * 6151) % 700 + 300 * CAST(c_acctbal >= 0 AS INT) AS DOUBLE) / 1000 END AS ext_source_2,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 4903) % 850 + 150 * CAST(c_acctbal >= 0 AS INT) AS DOUBLE) / 1000 END AS ext_source_3,
  1 + c_nationkey % 3 AS region_rating_client_w_city
FROM {customer}""",
    "fx_bureau": """
SELECT o_custkey AS sk_id_curr, o_orderkey AS sk_id_bureau,
  CASE WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'Bad debt'
       WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 1 THEN 'Sold' ELSE 'Closed' END AS credit_active,
  o_orderpriority AS credit_type, DAYS(o_orderdate) AS days_credit,
  CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey % 90 ELSE 0 END AS credit_day_overdue,
  o_orderkey % 3 AS cnt_credit_prolong,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_totalprice END AS amt_credit_sum,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice * CAST(o_orderkey % 5 AS DOUBLE) / 5 END AS amt_credit_sum_debt,
  CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice / 100 ELSE CAST(0 AS DOUBLE) END AS amt_credit_sum_overdue
FROM {orders}""",
    "fx_bureau_balance": """
SELECT l_orderkey AS sk_id_bureau, l_linenumber - 8 AS months_balance,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'C' WHEN l_linestatus = 'O' THEN 'X'
       ELSE CAST(l_linenumber % 6 AS VARCHAR(1)) END AS status
FROM {lineitem}""",
    "fx_previous_application": """
SELECT o_orderkey AS sk_id_prev, o_custkey AS sk_id_curr, DAYS(o_orderdate) AS days_decision,
  CASE WHEN o_orderkey % 50 = 0 THEN 'Unused offer' WHEN o_orderstatus = 'F' THEN 'Approved'
       WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS name_contract_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'Cash loans' WHEN 1 THEN 'Consumer loans' ELSE 'Revolving loans' END AS name_contract_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'HC' WHEN '2-HIGH' THEN 'LIMIT' WHEN '3-MEDIUM' THEN 'SCO' ELSE 'XNA' END AS code_reject_reason,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS amt_application,
  o_totalprice * CAST(80 + o_orderkey % 40 AS DOUBLE) / 100 AS amt_credit,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 24 END AS amt_annuity,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS DOUBLE) / 100 END AS rate_down_payment,
  CAST(6 + o_orderkey % 43 AS DOUBLE) AS cnt_payment,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS DOUBLE) END AS nflag_insured_on_approval
FROM {orders}""",
    "fx_installments": """
SELECT l_orderkey AS sk_id_prev, o_custkey AS sk_id_curr, DAYS(l_shipdate) AS days_instalment,
  CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN NULL
       ELSE DAYS(l_shipdate) + (l_partkey * 7 + l_linenumber) % 90 - 45 END AS days_entry_payment,
  l_extendedprice AS amt_instalment,
  CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN NULL WHEN l_discount > 0.08 THEN l_extendedprice * (1 - l_discount)
       ELSE l_extendedprice END AS amt_payment
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fx_pos_cash": """
SELECT l_orderkey AS sk_id_prev, o_custkey AS sk_id_curr, CAST(floor(DAYS(l_shipdate) / 30.0) AS BIGINT) AS months_balance,
  l_quantity AS cnt_instalment, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 2 END AS cnt_instalment_future,
  CASE WHEN l_suppkey % 50 = 0 THEN 'Demand' WHEN l_returnflag = 'A' THEN 'Active' WHEN l_returnflag = 'R' THEN 'Completed' ELSE 'Signed' END AS name_contract_status,
  CASE WHEN l_partkey % 17 = 0 THEN l_partkey % 120 ELSE 0 END AS sk_dpd,
  CASE WHEN l_partkey % 34 = 0 THEN l_partkey % 120 ELSE 0 END AS sk_dpd_def
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fx_credit_card": """
SELECT user_id * 10 + event_id % 3 AS sk_id_prev, user_id AS sk_id_curr, -1 - event_id % 24 AS months_balance,
  value AS amt_balance, CASE WHEN event_id % 10 = 0 THEN 0 ELSE 20 + (user_id % 5) * 30 END AS amt_credit_limit_actual,
  CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS amt_drawings_atm_current,
  CASE WHEN event_type IN ('purchase', 'view') THEN value ELSE CAST(0 AS DOUBLE) END AS amt_drawings_current,
  value / 20 AS amt_inst_min_regularity,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN CAST(0 AS DOUBLE) ELSE value / 10 END AS amt_payment_current,
  CASE WHEN event_id % 29 = 0 THEN event_id % 60 ELSE 0 END AS sk_dpd,
  CASE WHEN event_id % 58 = 0 THEN event_id % 60 ELSE 0 END AS sk_dpd_def,
  CASE WHEN event_id % 19 = 0 THEN 'Completed' ELSE 'Active' END AS name_contract_status
FROM {events}""",
    "fx_requests": """
SELECT event_id, CASE WHEN event_id % 30 = 11 THEN ts - INTERVAL 3 DAY ELSE ts END AS ts,
  CASE WHEN event_id % 50 = 7 THEN user_id + 1000000000 ELSE user_id END AS sk_id_curr,
  CASE WHEN event_id % 40 = 3 THEN NULL ELSE value * 1000 END AS requested_amount,
  CAST(least(floor((day(ts) - 1) / 10.0), 2) AS INT) AS arrival
FROM {events}""",
    "fx_scored": """
SELECT o_orderkey AS id, o_custkey AS sk_id_curr, CAST(c_acctbal < 0 AS INT) AS target, o_totalprice AS amt_credit,
  CAST(((o_orderkey * 7919 + o_custkey * 104729) % 1000) * ((o_orderkey * 7919 + o_custkey * 104729) % 1000)
       + 480000 * CAST(c_acctbal < 0 AS INT) AS DOUBLE) / 4000000 AS p_a,
  CAST(((o_orderkey * 104729 + o_custkey * 6007) % 1000) * ((o_orderkey * 104729 + o_custkey * 6007) % 1000)
       + 300000 * CAST(c_acctbal < 0 AS INT) AS DOUBLE) / 4000000 AS p_b,
  o_orderpriority AS seg_priority, c_mktsegment AS seg_market, c_nationkey % 5 AS seg_region
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
}

# Logical name of each stand-in → the reference table it replaces.
ROLE = {
    "application": "fx_application",
    "bureau": "fx_bureau",
    "bureau_balance": "fx_bureau_balance",
    "previous": "fx_previous_application",
    "installments": "fx_installments",
    "pos_cash": "fx_pos_cash",
    "credit_card": "fx_credit_card",
    "scored": "fx_scored",
    "requests": "fx_requests",
}

_TABLE_REF = re.compile(r"\{(\w+)\}")


def spark_text(view: str) -> str:
    return _DAYS.sub(r"datediff(CAST(\1 AS DATE), DATE '2002-01-01')", VIEWS[view])


def duckdb_text(view: str) -> str:
    text = _DAYS.sub(r"CAST(date_diff('day', DATE '2002-01-01', CAST(\1 AS DATE)) AS INTEGER)", VIEWS[view])
    return _TABLE_REF.sub(r"\1", text)


def duckdb_with(*views: str) -> str:
    """``WITH`` prefix defining the given stand-in views for an oracle query."""
    parts = [f"{v} AS ({duckdb_text(v)}\n)" for v in views]
    return "WITH " + ",\n".join(parts) + "\n"


def load(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """Stand-in table for ``role`` (see ROLE) over the star tables in ``sf_dir``."""
    view = ROLE.get(role, role)
    text = spark_text(view)
    names = sorted(set(_TABLE_REF.findall(text)))
    frames = {n: read_table(spark, sf_dir, n) for n in names}
    return spark.sql(text, **frames)

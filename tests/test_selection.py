"""Selection instead of sorting: exact quantiles by brackets, split by cut values."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.operators.histogram import _bracket, exact_quantiles, quantile_edges
from lendspark.operators.split import cut_values, stratified_split

PROBS = [0.0, 0.025, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.975, 1.0]


def hard_values():
    r = random.Random(5)
    many = [r.gauss(0, 1) for _ in range(3000)]
    return {
        "normal": many,
        "hot": [7.0] * 900 + [r.random() for _ in range(100)],
        "one": [3.25],
        "constant": [-2.0] * 50,
        "tiny and huge": [5e-324, -5e-324, 1e308, -1e308, 0.0, -0.0, 2.0 ** -1022, 1.0],
        "powers": [float(2.0 ** k) for k in range(-60, 60)] + [float(np.nextafter(2.0 ** k, 0)) for k in range(-60, 60)],
        "close": [1.0 + k * 2.0 ** -52 for k in range(4000)],
        "infinite": [math.inf, -math.inf, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0],
    }


@pytest.mark.parametrize("rows_to_sort", [1_000_000, 3])
def test_quantiles_are_numpys(spark, rows_to_sort):
    rows = [(k, x) for k, xs in hard_values().items() for x in xs] + [("normal", None), ("normal", math.nan), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    probs = [0.1, 0.25, 0.5, 0.9] if rows_to_sort == 3 else PROBS
    got = {(r["k"], r["q_index"]): r["quantile"] for r in exact_quantiles(df, "x", probs, ["k"], rows_to_sort=rows_to_sort).collect()}
    for k, xs in hard_values().items():
        s = sorted(xs)
        for i, p in enumerate(probs):
            h = p * (len(s) - 1)
            a, b = s[math.floor(h)], s[min(math.floor(h) + 1, len(s) - 1)]
            want = a if h == math.floor(h) else a + (h - math.floor(h)) * (b - a)
            assert got[(k, i)] == want or (math.isnan(want) and math.isnan(got[(k, i)])), (k, p)
            if k in ("normal", "hot", "powers"):
                assert got[(k, i)] == pytest.approx(np.percentile(xs, 100 * p), rel=1e-12, abs=1e-300)
    assert not any(k == "none" for k, _ in got)


def test_null_keys_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, x double")
    assert {r["k"]: r["quantile"] for r in exact_quantiles(df, "x", [0.5], ["k"]).collect()} == {None: 2.0, "a": 5.0}
    assert exact_quantiles(df, "x", [0.5]).first()["quantile"] == 3.0
    assert exact_quantiles(df.where("false"), "x", [0.5], ["k"]).collect() == []
    assert [r["edges"] for r in quantile_edges(df, "x", 2).collect()] == [[1.0, 3.0, 5.0]]


def test_brackets_keep_the_order(spark):
    xs = sorted({x for v in hard_values().values() for x in v if not math.isinf(x)} | {math.inf, -math.inf})
    got = [r["b"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select(
        "i", _bracket(F.col("x")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def plain_split(rows, test=0.2, valid=0.2):
    import hashlib

    out = {}
    for label in {y for _, y in rows}:
        ids = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, y in rows if y == label)
        a, b = math.floor(len(ids) * test + 0.5), math.floor(len(ids) * (test + valid) + 0.5)
        out |= {i: "test" if k < a else "validation" if k < b else "train" for k, (_, i) in enumerate(ids)}
    return out


@pytest.mark.parametrize("rows_to_sort", [1_000_000, 1])
def test_split_is_the_ranking(spark, rows_to_sort):
    r = random.Random(2)
    rows = [(i, int(r.random() < 0.3)) for i in r.sample(range(10**9), 2500)] + [(-5, 2), (-6, 2), (-7, None)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(5)
    got = {x["id"]: x["split"] for x in stratified_split(df, "id", "y", rows_to_sort=rows_to_sort).collect()}
    assert got == plain_split(rows)


def test_split_takes_all_or_none(spark):
    df = spark.createDataFrame([(i, 0) for i in range(40)], "id long, y int")
    assert {r["split"] for r in stratified_split(df, "id", "y", test=1.0, valid=0.0).collect()} == {"test"}
    assert {r["split"] for r in stratified_split(df, "id", "y", test=0.0, valid=0.0).collect()} == {"train"}
    assert stratified_split(df.where("false"), "id", "y").collect() == []


def test_the_split_moves_no_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    plan = stratified_split(df, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    assert len(cut_values(df, "id", "y", [0.2, 0.4])) == 4


def test_quantiles_exchange_counts_not_values(spark):
    """A million different values: what is shuffled are brackets, and the rows of those that hold a wanted rank."""
    df = spark.range(1_000_000).select(F.rand(3).alias("x"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "quantiles")
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.75])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("quantiles")) <= 12
    xs = sorted(r["x"] for r in df.collect())
    h = [p * 999_999 for p in (0.25, 0.5, 0.75)]
    assert [r["quantile"] for r in q.orderBy("prob").collect()] == [xs[int(x)] + (x - int(x)) * (xs[int(x) + 1] - xs[int(x)]) for x in h]

"""Bins of the scorecard and conformance of requests: pool adjacent violators, pooled levels, typed requests."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lendspark.operators import conformance as conf
from lendspark.operators import scorecard as sc
from lendspark.plans.artefacts import artefact
from lendspark.plans.q_scorecard import MODEL_PARTS, fit_scorecard

COUNTS = "feature string, bin string, n long, good long, bad long, lower double, upper double"


def plain_pav(bins: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(n, bad) in order, pooled by the usual stack; direction by the trend's sign."""
    k = len(bins)
    mean = sum(b / n for n, b in bins) / k
    slope = sum((i - (k - 1) / 2) * (b / n - mean) for i, (n, b) in enumerate(bins))
    sign = -1 if slope < -1e-12 else 1
    stack: list[list[int]] = []
    for n, b in bins:
        stack.append([n, b])
        while len(stack) > 1 and sign * stack[-2][1] * stack[-1][0] >= sign * stack[-1][1] * stack[-2][0]:
            n2, b2 = stack.pop()
            stack[-1][0] += n2
            stack[-1][1] += b2
    return [tuple(x) for x in stack]


def test_monotone_merge_is_pool_adjacent_violators(spark):
    r = random.Random(11)
    rows, want = [], {}
    for f in range(40):
        bins = [(n := r.randint(5, 60), r.randint(0, n)) for _ in range(r.randint(1, 12))]
        if f == 0:
            bins = [(10, 3)] * 120                              # more than 99 bins of one rate
        want[f"f{f}"] = plain_pav(bins)
        rows += [(f"f{f}", f"q{i + 1:02d}", n, n - b, b, float(i) if i else None, float(i + 1) if i < len(bins) - 1 else None) for i, (n, b) in enumerate(bins)]
    rows += [("f1", "missing", 7, 4, 3, None, None), ("c", "=a", 5, 5, 0, None, None), ("c", "*", 2, 1, 1, None, None)]
    out = sc.monotone_merge(spark.createDataFrame(rows, COUNTS)).collect()
    for f, bins in want.items():
        got = sorted((r for r in out if r["feature"] == f and r["bin"][0] == "q"), key=lambda r: int(r["bin"][1:]))
        assert [(r["n"], r["bad"]) for r in got] == bins, f
        assert got[0]["lower"] is None and got[-1]["upper"] is None
        assert all(a["upper"] == b["lower"] for a, b in zip(got, got[1:], strict=False))
    assert sorted(r["bin"] for r in out if r["feature"] == "c") == ["*", "=a"] and sum(r["bin"] == "missing" for r in out) == 1


def test_rare_levels_are_pooled_before_the_driver(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"),
                                    F.when(F.col("id") % 2 == 0, F.concat(F.lit("rare"), F.col("id"))).when(F.col("id") % 10 == 1, F.lit(None)).otherwise("big").alias("c"))
    levels = sc.long_categorical(df, ["c"], "id", "y")
    assert [(r["feature"], r["level"]) for r in sc.frequent_levels(levels).collect()] == [("c", "big")]
    edges = sc.prebin_edges(df.withColumn("x", F.col("id")), ["x"], "id", "y")
    binned = sc.assign_bins(df.withColumn("x", F.col("id")), ["x"], ["c"], edges, "id", "y")
    bins = sc.woe_table(binned, "y")
    got = {r["bin"]: r["n"] for r in bins.where("feature = 'c'").collect()}
    assert got == {"=big": 12_000, "missing": 3_000, sc.POOLED: 15_000}
    bmap = sc.BinMap.collect(bins)
    woe = {r["bin"]: r["woe"] for r in bins.where("feature = 'c'").collect()}
    seen = spark.createDataFrame([("big",), ("rare4",), ("never seen",), (None,)], "c string")
    assert [r[0] for r in seen.select(bmap.woe_column("c", False)).collect()] == [woe["=big"], woe["*"], woe["*"], woe["missing"]]


def test_the_scorecard_is_trained_once(spark):
    card = fit_scorecard(spark, SF001)
    before = [artefact(spark, SF001, name).current() for name in MODEL_PARTS]
    again = fit_scorecard(spark, SF001)
    assert [artefact(spark, SF001, name).current() for name in MODEL_PARTS] == before and None not in before
    assert again.coefs == card.coefs and again.kept == card.kept
    assert "Scan parquet" in card.frame._jdf.queryExecution().executedPlan().toString()
    rates = card.bins.where(F.col("bin").startswith("q")).select("feature", F.substring("bin", 2, 9).cast("int").alias("i"), "event_rate").collect()
    for f in {r["feature"] for r in rates}:
        x = [r["event_rate"] for r in sorted((r for r in rates if r["feature"] == f), key=lambda r: r["i"])]
        assert x == sorted(x) or x == sorted(x, reverse=True)


SCHEMA = conf.RequestSchema(("amount", "flag"), {"kind": ("a", "b")})


def test_requests_are_typed_or_rejected(spark):
    data = [(1, {"amount": "12.5", "flag": "true", "kind": "a"}), (2, {}), (3, None), (4, {"amount": "1", "zzz": "2", "abc": None}),
            (5, {"amount": "twelve", "flag": "0", "kind": "c"}), (6, {"kind": None}), (7, {"amount": "NaN", "flag": " FALSE "}),
            (8, {f"x{k:02d}": "1" for k in range(12)})]
    got = {r["id"]: r for r in conf.conform(spark.createDataFrame(data, "id int, f map<string,string>"), "f", SCHEMA).collect()}
    assert got[1][1:] == (None, 12.5, 1.0, "a")
    assert got[2]["reason"] == got[3]["reason"] == "empty request"
    assert got[4]["reason"] == "unknown features: abc, zzz"
    assert got[5][1:] == (None, None, 0.0, None) and got[6][1:] == (None, None, None, None) and got[7][1:] == (None, None, 0.0, None)
    assert got[8]["reason"].endswith("x09 ...")
    with pytest.raises(ValueError, match="amount"):
        conf.conform(spark.createDataFrame([(1, {"flag": "1"})], "amount int, f map<string,string>"), "f", SCHEMA)

"""Ranking metrics, profit grid and PSI: golden values and the reference's
property tests (perfect separation, random scores, Gini identity, Brier only
for probabilities, PSI behaviour)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from lendspark.operators import profit as prof
from lendspark.operators import psi as psi_ops
from lendspark.operators import ranking
from lendspark.sources import fixtures


def metrics_of(spark, y, s):
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    return ranking.ranking_metrics(df, [], "s", "y").first()


def brute_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def test_golden_fixture_metrics(spark):
    """FIXTURES.md part D: AUC, Gini, KS, AP, Brier of p_a / p_b at sf0.01."""
    d = fixtures.load(spark, SF01, "scored").unpivot(["id", "target"], ["p_a", "p_b"], "model", "score")
    got = {r["model"]: r for r in ranking.ranking_metrics(d, ["model"], "score", "target").collect()}
    gold = {"p_a": (0.866469220755122, 0.732938441510244, 0.6989309868373209, 0.4912568281128129, 0.06410028029623689),
            "p_b": (0.7611502917700316, 0.5223005835400631, 0.5462148207403098, 0.315350179070891, 0.07105940936877729)}
    for m, (auc, gini, ks, ap, brier) in gold.items():
        r = got[m]
        assert r["auc"] == pytest.approx(auc, rel=1e-9)
        assert r["gini"] == pytest.approx(gini, rel=1e-9)
        assert r["ks"] == pytest.approx(ks, rel=1e-9)
        assert r["pr_auc"] == pytest.approx(ap, rel=1e-9)
        assert r["brier"] == pytest.approx(brier, rel=1e-9)


def test_perfect_separation_and_random(spark):
    r = metrics_of(spark, [0] * 500 + [1] * 500, [0.1] * 500 + [0.9] * 500)
    assert r["gini"] == pytest.approx(1.0) and r["ks"] == pytest.approx(1.0)
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 3000), rng.random(3000)
    r = metrics_of(spark, y, s)
    assert abs(r["gini"]) < 0.1
    assert r["auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert r["gini"] == pytest.approx(2 * r["auc"] - 1)


def test_ties_match_brute_force(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 2000), rng.integers(0, 7, 2000) / 7
    assert metrics_of(spark, y, s)["auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_brier_only_for_probabilities(spark):
    assert metrics_of(spark, [0, 1, 0, 1, 0, 1], [0.1, 0.8, 0.3, 0.9, 0.2, 0.7])["brier"] is not None
    assert metrics_of(spark, [0, 1, 0, 1, 0, 1], [-1.0, 2.0, 0.3, 5.0, 0.2, 0.7])["brier"] is None


def test_grid_is_linspace_and_index_exact(spark):
    grid = prof.grid_values()
    df = spark.range(400).select(prof.grid_threshold(F.col("id")).alias("t"))
    assert [r["t"] for r in df.orderBy("t").collect()] == list(grid)
    ps = sorted(set(list(grid) + list(np.nextafter(grid, 0)) + [0.0, 0.004, 0.5, 1.0, 1.5]))
    rows = spark.createDataFrame([(float(p),) for p in ps], "p double").select(
        "p", prof.grid_index(F.col("p")).alias("k")).collect()
    for r in rows:
        assert r["k"] == int((grid <= r["p"]).sum())


def test_best_cutoff_golden(spark):
    """FIXTURES.md D: best grid index 46 / 98, first maximum wins, strict p < t."""
    d = fixtures.load(spark, SF01, "scored").unpivot(["id", "target", "amt_credit"], ["p_a", "p_b"], "model", "score")
    best = {r["model"]: r for r in prof.best_threshold(prof.profit_curve(d, ["model"], "score", "target", "amt_credit"),
                                                          ["model"]).collect()}
    assert best["p_a"]["best_j"] == 46 and best["p_b"]["best_j"] == 98
    assert best["p_a"]["best_threshold"] == pytest.approx(0.11971177944862155)
    assert best["p_a"]["best_profit"] == pytest.approx(287914344.6084, rel=1e-9)


def psi_of(spark, ref, new):
    r = spark.createDataFrame([(float(x),) for x in ref], "v double")
    n = spark.createDataFrame([(float(x),) for x in new], "v double")
    return psi_ops.psi(r, n, "v").first()["psi"]


def test_psi_properties(spark):
    rng = np.random.default_rng(42)
    a, b = rng.normal(0, 1, 4000), rng.normal(0, 1, 4000)
    assert psi_of(spark, a, b) < 0.02
    shifts = [psi_of(spark, a, rng.normal(m, 1, 4000)) for m in (0.2, 0.6, 1.5)]
    assert shifts[0] < shifts[1] < shifts[2]
    assert math.isfinite(psi_of(spark, a, rng.normal(50, 1, 1000)))
    with_nan = np.concatenate([rng.normal(0, 1, 4000), [np.nan] * 1000])
    assert psi_of(spark, a, with_nan) < 0.02


def test_psi_golden(spark):
    """FIXTURES.md D: PSI p_a → p_b = 0.00884731028874683; p_a → p_a = 0."""
    d = fixtures.load(spark, SF01, "scored")
    assert psi_ops.psi(d.select(F.col("p_a").alias("v")), d.select(F.col("p_b").alias("v")), "v").first()["psi"] \
        == pytest.approx(0.00884731028874683, rel=1e-9)
    assert psi_ops.psi(d.select(F.col("p_a").alias("v")), d.select(F.col("p_a").alias("v")), "v").first()["psi"] \
        == pytest.approx(0.0, abs=1e-15)


def test_verdict_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,), (None,)], "v double")
    got = [r[0] for r in df.select(psi_ops.verdict("v")).collect()]
    assert got == ["no shift", "moderate - watch", "moderate - watch", "serious - review", "not computable"]

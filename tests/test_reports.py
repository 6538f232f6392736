"""Drift report, uplift, selection funnel and rank comparison against plain Python on small frames."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.functions.local import local_frame
from lendspark.operators import profit as prof
from lendspark.operators import psi as psi_ops
from lendspark.operators import scorecard as sc

NAMES = ["baseline", "mild_recession", "none_such"]


def plain_psi(ref, new):
    ref, new = (np.array([x for x in v if x is not None and not np.isnan(x)], dtype=float) for v in (ref, new))
    if not len(ref) or not len(new):
        return None
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    if len(edges) < 3:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    shares = [np.maximum(np.histogram(v, edges)[0] / len(v), 1e-6) for v in (ref, new)]
    return float(((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum())


def plain_auc(score, y):
    score, y = np.asarray(score), np.asarray(y)
    diff = score[y == 1][:, None] - score[y == 0][None, :]
    return float((diff > 0).mean() + (diff == 0).mean() / 2)


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(5)

    def rows(n, shift, scenario=None):
        out = []
        for i in range(n):
            s = float(np.round(rng.beta(2 + shift, 8), 3))
            a = None if i % 11 == 0 else float(np.round(rng.normal(shift), 2))
            b = float("nan") if i % 17 == 0 else float(rng.integers(0, 4))
            row = (s, int(rng.random() < 0.3), a, b, 1.0)
            out.append((scenario, *row) if scenario else row)
        return out

    ref, base, mild = rows(400, 0), rows(150, 0, "baseline"), rows(150, 1.5, "mild_recession")
    schema = "p double, y int, a double, b double, c double"
    return ref, base, mild, local_frame(spark, ref, schema), local_frame(spark, base + mild, f"scenario string, {schema}")


def test_drift_report_equals_plain_python(frames):
    ref, base, mild, reference, new = frames
    got = {r["scenario"]: r for r in psi_ops.drift_report(reference, new, NAMES, "p", "y", ["a", "b", "c"], most=2).collect()}
    assert set(got) == set(NAMES)
    for name, rows in (("baseline", base), ("mild_recession", mild)):
        r, col = got[name], lambda i, rows=rows: [x[i] for x in rows]
        assert r["score_psi"] == pytest.approx(plain_psi([x[0] for x in ref], col(1)))
        assert r["auc"] == pytest.approx(plain_auc(col(1), col(2))) and r["gini"] == pytest.approx(2 * r["auc"] - 1)
        assert r["mean_prediction"] == pytest.approx(np.mean(col(1))) and r["default_rate"] == pytest.approx(np.mean(col(2)))
        want = {f: plain_psi([x[i] for x in ref], col(i + 1)) for i, f in ((2, "a"), (3, "b"), (4, "c"))}
        assert want["c"] == 0.0                                   # a constant has fewer than three edges
        top = sorted(want, key=lambda f: (-want[f], f))[:2]
        assert [t["feature"] for t in r["most_shifted"]] == top
        assert [t["psi"] for t in r["most_shifted"]] == pytest.approx([want[f] for f in top])
    empty = got["none_such"]                                      # a scenario without rows is reported, not dropped
    assert empty["score_psi"] is None and empty["verdict"] == "not computable" and empty["auc"] is None
    assert got["mild_recession"]["verdict"] == "serious - review"


def test_drift_report_without_features_or_rows(frames):
    _, _, _, reference, new = frames
    assert [r["most_shifted"] for r in psi_ops.drift_report(reference, new, ["baseline"], "p", "y", []).where("scenario = 'baseline'").collect()] == [[]]
    none = psi_ops.drift_report(reference.limit(0), new.limit(0), NAMES, "p", "y", ["a"])
    assert none.count() == 0


def test_psi_by_scenario_equals_one_scenario_at_a_time(frames):
    _, _, _, reference, new = frames
    at_once = {(r["scenario"], r["feature"]): r["psi"] for r in
               psi_ops.feature_psi(reference, new, ["a", "b"], by="scenario", names=NAMES[:2]).collect()}
    for name in NAMES[:2]:
        for r in psi_ops.feature_psi(reference, new.where(F.col("scenario") == name), ["a", "b"]).collect():
            assert at_once[name, r["feature"]] == pytest.approx(r["psi"])


def test_uplift(spark):
    rows = [("m1", "approve_all", -100.0, 0, 0), ("m1", "fixed_0.50", 5.0, 1, 1), ("m1", "optimum", 50.0, 9, 4),
            ("m2", "approve_all", 0.0, 0, 0), ("m2", "fixed_0.50", 7.0, 1, 1), ("m2", "optimum", 80.0, 8, 3)]
    got = {r["model"]: r for r in prof.uplift(local_frame(
        spark, rows, "model string, scenario string, profit double, prevented_bad long, lost_good long"), "model", "m1").collect()}
    assert got["m1"]["uplift"] == 150.0 and got["m1"]["uplift_share"] == 1.5 and got["m1"]["gain_over_reference"] == 0.0
    assert got["m2"]["uplift"] == 80.0 and got["m2"]["uplift_share"] is None and got["m2"]["gain_over_reference"] == 30.0
    assert got["m2"]["prevented_bad"] == 8 and got["m2"]["lost_good"] == 3


def test_selection_funnel():
    assert sc.selection_funnel([("all", ["a", "b", "c"]), ("iv", ["a", "c"]), ("sign", ["c"])]) == [
        (0, "all", 3, []), (1, "iv", 2, ["b"]), (2, "sign", 1, ["a"])]
    with pytest.raises(ValueError, match="not in the stage before"):
        sc.selection_funnel([("all", ["a"]), ("iv", ["b"])])


def test_rank_disagreement(spark):
    contribution = sc.rank_features(local_frame(spark, [("a", 0.5), ("b", 0.5), ("c", 0.9), ("d", 0.1)], "feature string, v double"), "v", "contribution_rank")
    gain = local_frame(spark, [("z", 1), ("b", 2), ("c", 7), ("a", 9)], "feature string, gain_rank int")
    got = {r["feature"]: (r["contribution_rank"], r["gain_rank_here"], r["disagreement"]) for r in sc.rank_disagreement(contribution, gain).collect()}
    assert got == {"c": (1, 2, 1), "a": (2, 3, 1), "b": (3, 1, -2), "d": (4, None, None)}

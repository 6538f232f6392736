"""Early stopping on validation AUC: staged margins against models cut at every stage, the patience rule, edge cases."""
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendspark.operators import trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=600), rng.normal(size=600)
    y = (rng.random(600) < 1 / (1 + np.exp(-1.5 * x))).astype(int)
    data = [(i, int(y[i]), None if i % 9 == 0 else float(x[i]), float(z[i]), f"l{i % 80}", i % 3 == 0) for i in range(600)]
    return spark.createDataFrame(data, "id int, target int, x double, z double, c string, valid boolean")


def exact_auc(score, y):
    s, y = np.asarray(score), np.asarray(y)
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    return float((diff > 0).mean() + (diff == 0).mean() / 2)


def test_staged_auc_equals_models_cut_at_each_stage(spark, rows):
    tm = trees.fit(rows, "target", ["x", "z"], ["c"], max_trees=6)     # 81 levels: more than the least number of bins
    assert tm.n_trees == 6 and tm.stage_auc == []
    model = tm.model.stages[-1]
    d, _ = trees.prepare(rows, ["x", "z"], ["c"])
    for stage in tm.model.stages[:-1]:
        d = stage.transform(d)
    got = trees.staged_auc(model, d, "target")
    assert len(got) == 6
    for t in range(1, 7):
        scored = trees.cut(model, t, spark).transform(d).select("target", vector_to_array("probability")[1].alias("p")).toPandas()
        assert got[t - 1] == pytest.approx(exact_auc(scored["p"], scored["target"]), abs=0.005)


def test_fit_keeps_the_best_stage_and_stored_margins(spark, rows):
    tm = trees.fit(rows, "target", ["x", "z"], [], validation="valid", max_trees=8, patience=2, first_trees=4)
    best, _ = trees.best_stage(tm.stage_auc, 2)
    assert tm.n_trees == best == tm.model.stages[-1].getNumTrees
    scored = trees.predict(tm, rows.where("valid"), ["x", "z"], []).select("target", "tree_probability").toPandas()
    assert tm.stage_auc[best - 1] == pytest.approx(exact_auc(scored["tree_probability"], scored["target"]), abs=0.005)
    assert trees.importance(tm, spark).count() == 2


def test_one_class_in_validation_keeps_the_first_run(rows):
    one = rows.withColumn("valid", F.col("valid") & (F.col("target") == 1))
    tm = trees.fit(one, "target", ["x"], [], validation="valid", max_trees=4, first_trees=2)
    assert tm.n_trees == 2 and tm.stage_auc == [None, None]


@pytest.mark.parametrize("aucs, patience, want", [
    ([], 2, (0, False)), ([None, None], 1, (0, False)), ([0.5, 0.6, 0.6, 0.6], 2, (2, True)),
    ([0.5, 0.6, 0.55, 0.7], 2, (4, False)), ([0.7, 0.6, 0.65, 0.9], 2, (1, True)), ([None, 0.5], 3, (2, False))])
def test_patience(aucs, patience, want):
    assert trees.best_stage(aucs, patience) == want


def test_idle_indicators_are_left_out_of_the_fit_and_change_no_tree(spark, rows, monkeypatch):
    full = rows.select("id", "target", "c", "valid", "z", "x", (F.col("x") * F.col("z")).alias("xz"),
                       F.when(F.col("id") % 7 > 0, F.col("z")).alias("z7"), F.lit(None).cast("double").alias("none"))
    full = full.unionByName(full.where("id < 200"))                 # repeated rows
    numeric = ["z", "x", "xz", "z7", "none"]
    tm = trees.fit(full, "target", numeric, ["c"], max_trees=5)
    assert [c for c in tm.inputs if c.startswith("m_")] == ["m_x", "m_z7"]
    monkeypatch.setattr(trees, "idle_indicators", lambda *a: set())
    whole = trees.fit(full, "target", numeric, ["c"], max_trees=5)
    assert len(whole.inputs) == len(tm.inputs) + 3
    gain = lambda m: {r["feature"]: r["importance"] for r in trees.importance(m, spark).collect()}
    assert gain(tm) == pytest.approx(gain(whole))
    score = lambda m: [r[0] for r in trees.predict(m, full, numeric, ["c"]).orderBy("id").select("tree_probability").collect()]
    assert score(tm) == pytest.approx(score(whole))


def test_indicators_missing_in_as_many_other_rows_stay(spark):
    d = spark.createDataFrame([(0, None, 1.0), (0, None, 1.0), (1, 2.0, None), (1, 2.0, None)], "target int, a double, b double")
    assert trees.idle_indicators(d, ["a", "b"]) == set()

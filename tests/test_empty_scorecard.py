"""A scorecard whose selection leaves no feature is its intercept, and all that reads it still answers."""
import math

import pytest
from pyspark.sql import functions as F

from lendspark.functions.local import local_frame
from lendspark.operators import scorecard as sc
from lendspark.operators import trees
from lendspark.plans.q_scorecard import additivity_error

ROWS = [(i, int(i % 4 == 0), "train" if i % 3 else "validation") for i in range(40)]


@pytest.fixture(scope="module")
def woe(spark):
    return local_frame(spark, ROWS, "sk_id_curr long, target int, split string")


def test_fit_without_features_is_the_log_odds(woe):
    kept, intercept, coefs, rounds, dropped = sc.sign_repair(woe, [], "target", woe.count())
    assert (kept, coefs, rounds, dropped) == ([], {}, 0, []) and intercept == pytest.approx(math.log(10 / 30))
    assert sc.fit_logit(woe.where("target = 1"), [], "target", 10)[0] == math.inf
    assert sc.fit_logit(woe.where("target = 0"), [], "target", 30)[0] == -math.inf
    with pytest.raises(ValueError, match="no rows"):
        sc.fit_logit(woe.where("false"), [], "target", 0)


def test_intercept_scores_reasons_points_and_bands(spark, woe):
    scored = sc.score_columns(woe, math.log(10 / 30), {})
    assert {round(r["probability"], 12) for r in scored.collect()} == {0.25}
    facts = scored.withColumn("e", additivity_error(scored, {}, {}, math.log(10 / 30))).agg(
        F.max("e").alias("e"), F.expr(sc.DIRECTION_HOLDS).alias("holds")).first()
    assert facts["e"] == 0.0 and facts["holds"]
    given = sc.contributions(scored, {}, {}).select(sc.top_reasons(F.col("contribs"), 8).alias("r"))
    assert all(r["r"] == [] for r in given.collect())
    assert given.schema["r"].dataType.elementType.names == ["feature", "contribution", "direction", "woe"]
    bins = local_frame(spark, [("a", "q01", 3, 0.1, 0.5)], "feature string, bin string, n long, event_rate double, woe double")
    table = sc.points_table(bins, -1.0, {})
    assert table.count() == 0 and dict(table.dtypes)["coefficient"] == "double" and dict(table.dtypes)["points"] == "double"
    band = sc.points_bands(scored, "target").collect()
    assert [(b["band"], b["applications"], b["default_rate"]) for b in band] == [(1, 40, 0.25)]


def test_trees_without_features_are_constant(spark, woe):
    rows = woe.withColumn("v", F.col("split") == "validation")
    tm = trees.fit(rows, "target", [], [], validation="v", first_trees=2, max_trees=2, patience=1)
    assert len({r["tree_probability"] for r in trees.predict(tm, woe, [], []).collect()}) == 1
    assert tm.stage_auc[0] == 0.5 and trees.importance(tm, spark).count() == 0

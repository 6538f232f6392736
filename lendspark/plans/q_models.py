"""Tree challenger, importance, proxy leakage and gap decomposition
(M30–M32, M35, M18). Rows-only checks: these are iterative fits."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.functions.local import local_frame
from lendspark.operators import fairness as fair
from lendspark.operators import ranking
from lendspark.operators import scorecard as sc
from lendspark.operators import trees
from lendspark.operators.bootstrap import paired_difference
from lendspark.operators.histogram import exact_quantiles
from lendspark.plans.artefacts import artefact, published
from lendspark.plans.q_audit import customer_split
from lendspark.plans.registry import query
from lendspark.session import ensure_checkpoint_dir
from lendspark.sources.tables import column_roles

TREE_CATEGORICAL = ["name_contract_type", "name_education_type", "occupation_type"]
PROXY_TREES = 30


def tree_inputs(spark: SparkSession, sf_dir: str):
    ensure_checkpoint_dir(spark)
    # iterative fits re-read their input many times: cut the lineage once
    s = customer_split(spark, sf_dir)
    roles = column_roles(s, "sk_id_curr", "target")
    numeric = fair.compliant_features([c for c in roles["numeric"] + roles["bool"] if c != "split"])
    categorical = fair.compliant_features(TREE_CATEGORICAL)
    fair.compliance_gate(numeric + categorical)
    return s, numeric, categorical


def fit_challenger(s: DataFrame, numeric, categorical) -> trees.TreeModel:
    fit_rows = s.where(F.col("split").isin("train", "validation")).withColumn(
        "is_valid", F.col("split") == "validation")
    return trees.fit(fit_rows, "target", numeric, categorical, validation="is_valid")


CHALLENGER = ("tree_importances", "tree_stages", "tree_scores")


def challenger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Importances, validation AUC by number of trees (with the number kept) and every customer's probability, as
    published; the first job that finds no scores trains the model. The scores are published last."""
    parts = [artefact(spark, sf_dir, name) for name in CHALLENGER]
    if parts[-1].current() is None:
        s, numeric, categorical = tree_inputs(spark, sf_dir)
        tm = fit_challenger(s, numeric, categorical)
        parts[0].publish(trees.importance(tm, spark), "feature")
        stages = [(t, auc, t == tm.n_trees) for t, auc in enumerate(tm.stage_auc, 1)]
        parts[1].publish(local_frame(spark, stages, "trees int, validation_auc double, kept boolean"), "trees", contracts={
            "one number of trees is kept": "count_if(kept) = 1"})
        scored = trees.predict(tm, s, numeric, categorical).select("sk_id_curr", "target", "split", "tree_probability")
        parts[2].publish(scored, "sk_id_curr", contracts={
            "probabilities lie in [0, 1]": "count_if(tree_probability IS NULL OR tree_probability NOT BETWEEN 0 AND 1) = 0"})
    return tuple(p.read() for p in parts)


@query("tree_challenger", "M30,M32")
def q_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking quality of the early-stopped tree model per split, with the
    number of trees kept and the train − validation AUC gap."""
    _, stages, scored = challenger(spark, sf_dir)
    m = ranking.ranking_metrics(scored, ["split"], "tree_probability", "target")
    gap = m.groupBy().agg((F.max(F.when(F.col("split") == "train", F.col("auc")))
                           - F.max(F.when(F.col("split") == "validation", F.col("auc")))).alias("overfit_gap"))
    kept = stages.where("kept").first()["trees"]
    return m.withColumn("_k", F.lit(1)).join(gap.withColumn("_k", F.lit(1)), "_k").drop("_k").withColumn("n_trees", F.lit(kept))


@query("tree_stages", "M30")
def q_tree_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation AUC after each tree trained, and which number was kept."""
    return challenger(spark, sf_dir)[1]


@query("tree_importance", "M31")
def q_tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return challenger(spark, sf_dir)[0]


@query("proxy_leakage", "M35,P18")
def q_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Can a removed (tier-1) attribute be predicted from the compliant
    features? Target = above the training median (numeric) or equal to the
    training mode (text); AUC on test; top-3 proxies by importance."""
    s, numeric, categorical = tree_inputs(spark, sf_dir)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    rows = []
    for attr in fair.TIER_1:
        if dict(s.dtypes)[attr] == "string":
            spelled = F.coalesce(F.col(attr), F.lit("nan"))       # NULL is a level of its own
            top = train.groupBy(spelled.alias("level")).count().orderBy(F.desc("count"), "level").first()     # one row
            rule_value = top["level"]
            target = (spelled == F.lit(rule_value)).cast("int")
            rule = f"equals mode '{rule_value}'"
        else:
            med = exact_quantiles(train, attr, [0.5]).first()["quantile"]              # one value
            target = F.coalesce(F.col(attr) > F.lit(med), F.lit(False)).cast("int")   # NULL is not above
            rule = f"above median {med:g}"
        tr = train.withColumn("_t", target)
        if tr.select("_t").distinct().count() < 2:
            continue
        tm = trees.fit(tr, "_t", numeric, categorical, max_trees=PROXY_TREES)
        pred = trees.predict(tm, test.withColumn("_t", target), numeric, categorical)
        auc = ranking.ranking_metrics(pred, [], "tree_probability", "_t").first()["auc"]
        imp = trees.importance(tm, spark).orderBy("rank").limit(3).collect()
        rows.append((attr, rule, auc, trees.leakage_level(auc), [r["feature"] for r in imp]))
    return spark.createDataFrame(rows, "attribute string, target_rule string, auc double, level string, "
                                       "top_proxies array<string>")


GAP_MODELS = ("scorecard", "same_features", "all_features")


def gap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the scorecard, of a tree model on exactly its features and of the challenger for every customer,
    published once."""
    from lendspark.plans.q_scorecard import fit_scorecard

    def build() -> DataFrame:
        s, numeric, categorical = tree_inputs(spark, sf_dir)
        card = fit_scorecard(spark, sf_dir)
        kn, kc = [f for f in card.kept if f in numeric], [f for f in card.kept if f in categorical]
        same = trees.predict(fit_challenger(s, kn, kc), s, kn, kc).select("sk_id_curr", F.col("tree_probability").alias(GAP_MODELS[1]))
        scored = sc.score_columns(card.frame, card.intercept, card.coefs).select(
            "sk_id_curr", "target", "split", F.col("probability").alias(GAP_MODELS[0]))
        full = challenger(spark, sf_dir)[2].select("sk_id_curr", F.col("tree_probability").alias(GAP_MODELS[2]))
        return scored.join(same, "sk_id_curr").join(full, "sk_id_curr")

    return published(spark, sf_dir, "gap_scores", build, key="sk_id_curr", contracts={
        "every customer has all scores": f"count_if({' OR '.join(f'{m} IS NULL' for m in GAP_MODELS)}) = 0"})


@query("gap_decomposition", "M18")
def q_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-AUC gap between the tree challenger and the scorecard, split into
    model class (tree refitted on exactly the scorecard's features) and extra
    features."""
    test = gap_scores(spark, sf_dir).where(F.col("split") == "test").unpivot(["target"], list(GAP_MODELS), "model", "score")
    auc = {r["model"]: r["auc"] for r in ranking.ranking_metrics(test, ["model"], "score", "target").select("model", "auc").collect()}
    auc_card, auc_same, auc_full = (auc.get(m) for m in GAP_MODELS)
    known = None not in (auc_card, auc_same, auc_full)            # one class only among the test rows: no AUC, no gap
    total = auc_full - auc_card if known else None
    cls = auc_same - auc_card if known else None
    extra = total - cls if known else None
    share = (lambda v: v / total if total else None)
    rows = [("scorecard", auc_card, None, None), ("tree, scorecard features", auc_same, cls, share(cls)),
            ("tree, all compliant features", auc_full, total, 1.0 if total else None),
            ("extra features", None, extra, share(extra))]
    return local_frame(spark, rows, "component string, auc double, auc_gain double, share double")


@query("gap_intervals", "M17,M18")
def q_gap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three paired comparisons behind the gap, on the same test customers and the same bootstrap draws: difference in
    AUC, 95 % interval, p-value, and whether the interval leaves out zero."""
    test = gap_scores(spark, sf_dir).where(F.col("split") == "test")
    card, same, full = GAP_MODELS
    out = None
    for comparison, a, b in (("total", full, card), ("model class", same, card), ("extra features", full, same)):
        d = paired_difference(test, "sk_id_curr", a, b, "target").withColumn("comparison", F.lit(comparison))
        out = d if out is None else out.unionByName(d)
    return out.withColumn("significant", (F.col("ci_low") > 0) | (F.col("ci_high") < 0))


@query("baseline_logit", "P23,M25,M6")
def q_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hand-picked features, median fill + indicators + scaling, logistic;
    ranking quality per split."""
    s, _, _ = tree_inputs(spark, sf_dir)
    model = trees.fit_baseline(s.where(F.col("split") == "train"), "target")
    return ranking.ranking_metrics(trees.predict_baseline(model, s), ["split"], "baseline_probability", "target")


@query("model_comparison", "U2,M6,M29")
def q_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One validation-metrics row per model — single variable, baseline
    logistic, scorecard, tree challenger — appended by ``unionByName``."""
    from lendspark.plans.q_scorecard import fit_scorecard

    s, _, _ = tree_inputs(spark, sf_dir)
    valid = s.where(F.col("split") == "validation")
    med = exact_quantiles(s.where(F.col("split") == "train"), "ext_source_mean", [0.5]).first()["quantile"]
    single = valid.select("target", (-F.coalesce(F.col("ext_source_mean"), F.lit(med))).alias("score"))
    base = trees.predict_baseline(trees.fit_baseline(s.where(F.col("split") == "train"), "target"), valid) \
        .select("target", F.col("baseline_probability").alias("score"))
    card = fit_scorecard(spark, sf_dir)
    cs = sc.score_columns(card.frame.where(F.col("split") == "validation"), card.intercept, card.coefs) \
        .select("target", F.col("probability").alias("score"))
    tree = challenger(spark, sf_dir)[2].where("split = 'validation'").select("target", F.col("tree_probability").alias("score"))
    parts = [("single variable: ext_source_mean", single), ("baseline logistic, 10 features", base),
             (f"scorecard, {len(card.kept)} features", cs), ("boosted trees", tree)]
    out = None
    for name, d in parts:
        m = ranking.ranking_metrics(d.withColumn("model", F.lit(name)), ["model"], "score", "target")
        out = m if out is None else out.unionByName(m)
    return out

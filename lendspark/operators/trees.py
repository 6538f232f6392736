"""Boosted-tree challenger (M30–M32), proxy-leakage test (M35) and the AUC gap
decomposition (M18), on ``pyspark.ml``.

Spark trees have no learned direction for missing values, so every numeric
feature with NULLs gets a missing indicator and the NULL itself a sentinel far
below the observed range. Indicators that are constant on the training rows, or
equal to an earlier one, can win no split and are left out of the fit: each one
costs as much a tree as a feature. Categories go through ``StringIndexer`` with
``handleInvalid='keep'`` (unseen levels share one extra index).

Early stopping is by AUC on the validation rows, with patience. Boosting with n trees is a prefix of boosting with
more, so one pass over the validation rows gives the margin after every tree (leaf values summed tree by tree), each
task counts them in a grid of log-odds, and the grids' sums give one AUC a stage. Trees are trained in doubling runs
until the best stage lies ``patience`` trees back; the model is then cut there.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.session import ensure_checkpoint_dir

MAX_TREES = 3000
FIRST_TREES = 40
PATIENCE = 20
DEPTH = 4
STEP = 0.1
LEAST_BINS = 64
GRID, GRID_EDGE = 4096, 16.0       # cells of log-odds between -16 and 16
ROWS_AT_ONCE = 2000
SENTINEL = -1.0e9
LEAK_HIGH, LEAK_MEDIUM = 0.75, 0.65


@dataclass
class TreeModel:
    model: object
    inputs: list          # assembled column names (after indicators)
    features: list        # original feature names
    n_trees: int
    stage_auc: list = field(default_factory=list)   # validation AUC after each trained tree; empty without validation rows


def prepare(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Sentinel-filled numerics + missing indicators; categorical columns kept
    as text for the indexer. Without features a constant stands in: the trees
    are then single leaves."""
    cols, inputs = [], []
    if not (numeric or categorical):
        return df.withColumn("n_", F.lit(0.0)), ["n_"]
    for f in numeric:
        c = F.col(f).cast("double")
        cols.append(F.coalesce(c, F.lit(SENTINEL)).alias(f"n_{f}"))
        cols.append(c.isNull().cast("double").alias(f"m_{f}"))
        inputs += [f"n_{f}", f"m_{f}"]
    for f in categorical:
        cols.append(F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias(f"c_{f}"))
    return df.select("*", *cols), inputs


def idle_indicators(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> set[str]:
    """Missing indicators that no tree on ``train`` can split on: constant ones, and those equal to an earlier feature's
    (of equal gains the first wins). Two are equal when as many rows miss the features
    and their hashes have the same sum: a sum in doubles never overflows, and equal columns round alike."""
    if not numeric:
        return set()
    row = F.xxhash64(*numeric, *categorical).cast("double")
    d = train.select(row.alias("_row"), *[F.col(f).cast("double").isNull().alias(f"m_{f}") for f in numeric])
    seen = d.agg(F.count(F.lit(1)), *[a for f in numeric for a in (F.count_if(F.col(f"m_{f}")), F.sum(F.when(F.col(f"m_{f}"), F.col("_row"))))]).first()
    idle, first = set(), set()
    for i, f in enumerate(numeric):
        missing = seen[1 + 2 * i], seen[2 + 2 * i]
        if missing[0] in (0, seen[0]) or missing in first:
            idle.add(f"m_{f}")
        first.add(missing)
    return idle


def leaf_values(model: GBTClassificationModel, spark) -> np.ndarray:
    """Weighted value of every leaf, one row a tree, in the order of the model's leaf indices. Read from the saved model:
    trees x 2^depth numbers, whatever the data."""
    at = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(at)
    leaves = spark.read.parquet(f"{at}/data").where("nodeData.leftChild < 0").select(
        "treeID", "nodeData.id", "nodeData.prediction").orderBy("treeID", "id").collect()
    values = np.zeros((model.getNumTrees, 1 << model.getMaxDepth()))
    place = dict.fromkeys(range(model.getNumTrees), 0)
    for r in leaves:
        values[r["treeID"], place[r["treeID"]]] = r["prediction"] * model.treeWeights[r["treeID"]]
        place[r["treeID"]] += 1
    return values


def staged_auc(model: GBTClassificationModel, rows: DataFrame, label: str, values: np.ndarray | None = None) -> list[float | None]:
    """AUC of ``rows`` (features, label 0/1) after each tree, in one pass. Margins that share a cell of the grid (1/128 of
    log-odds) count as ties, so a stage's AUC is exact up to half the pairs within cells. None where a class is absent."""
    spark = rows.sparkSession
    values = leaf_values(model, spark) if values is None else values
    stages = len(values)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((stages, 2, GRID), dtype=np.uint32)
        for b in batches:
            for at in range(0, len(b), ROWS_AT_ONCE):
                y = b["y"].iloc[at:at + ROWS_AT_ONCE].to_numpy().astype(int)
                leaf = np.stack(b["leaf"].iloc[at:at + ROWS_AT_ONCE].to_numpy()).astype(int)
                margin = np.zeros(len(y))
                for t in range(stages):
                    margin += values[t, leaf[:, t]]
                    cell = np.clip((2.0 * margin + GRID_EDGE) * (GRID / (2 * GRID_EDGE)), 0, GRID - 1).astype(int)
                    np.add.at(seen[t], (y, cell), 1)
        t, cell = np.nonzero(seen.sum(axis=1))
        yield pd.DataFrame({"stage": t, "cell": cell, "bad": seen[t, 1, cell], "good": seen[t, 0, cell]})

    leaved = model.copy().setLeafCol("leaf").transform(rows.select("features", F.col(label).cast("int").alias("y")).where("y IS NOT NULL"))
    cells = leaved.select("y", vector_to_array("leaf", "float32").alias("leaf")) \
        .mapInPandas(count, "stage long, cell long, bad long, good long") \
        .groupBy("stage", "cell").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    below = F.coalesce(F.sum("good").over(Window.partitionBy("stage").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = cells.withColumn("won", F.col("bad") * (below + F.col("good") / 2)).groupBy("stage").agg(
        F.try_divide(F.sum("won"), F.sum("bad") * F.sum("good")).alias("auc")).collect()        # one row a tree
    by_stage = {r["stage"]: r["auc"] for r in won}
    return [by_stage.get(t) for t in range(stages)]


def best_stage(aucs: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """Trees of the best stage, the first of equals, and whether ``patience`` trees after it brought nothing better."""
    best, at = -1.0, 0
    for t, auc in enumerate(aucs, 1):
        if auc is not None and auc > best:
            best, at = auc, t
        elif at and t - at >= patience:
            return at, True
    return at, False


def cut(model: GBTClassificationModel, n_trees: int, spark) -> GBTClassificationModel:
    """The model of the first ``n_trees`` trees."""
    ml = spark.sparkContext._jvm.org.apache.spark.ml
    trees = spark.sparkContext._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n_trees)
    weights = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, n_trees)
    grown = model._java_obj.trees()
    for i, w in enumerate(model.treeWeights[:n_trees]):
        trees[i], weights[i] = grown[i], w
    return model._copyValues(GBTClassificationModel(ml.classification.GBTClassificationModel(f"{model.uid}_{n_trees}", trees, weights)))


def fit(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], validation: str | None = None,
        max_trees: int = MAX_TREES, seed: int = 42, patience: int = PATIENCE, first_trees: int = FIRST_TREES) -> TreeModel:
    """GBT classifier. ``validation`` names a boolean column of the rows that only choose the number of trees; without
    it all ``max_trees`` are trained and kept, as they are where the validation rows hold one class only (there the
    first run's)."""
    spark = df.sparkSession
    d, inputs = prepare(df, numeric, categorical)
    d = d.withColumn("_label", F.col(label).cast("double"))
    train = d.where(~F.col(validation)) if validation else d
    idle = idle_indicators(train, numeric, categorical)
    inputs = [c for c in inputs if c not in idle] + [f"i_{f}" for f in categorical]
    stages = [StringIndexer(inputCol=f"c_{f}", outputCol=f"i_{f}", handleInvalid="keep") for f in categorical]
    ready = Pipeline(stages=stages + [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]).fit(train)
    levels = [len(m.labels) + 1 for m in ready.stages[:-1]]           # one more for unseen levels
    vectors = ready.transform(d)
    rows = vectors.where(F.col(validation)) if validation else None
    n = min(first_trees, max_trees) if validation else max_trees
    while True:
        gbt = GBTClassifier(labelCol="_label", featuresCol="features", maxIter=n, maxDepth=DEPTH, stepSize=STEP, seed=seed,
                            maxBins=max([LEAST_BINS, *levels]))
        model = gbt.fit(vectors.where(~F.col(validation)) if validation else vectors)
        aucs = staged_auc(model, rows, "_label") if validation else []
        best, settled = best_stage(aucs, patience)
        if settled or not best or n >= max_trees:
            break
        n = min(2 * n, max_trees)
    model = cut(model, best, spark) if best and best < n else model
    return TreeModel(PipelineModel([*ready.stages, model]), inputs, list(numeric) + list(categorical), model.getNumTrees, aucs)


def predict(tm: TreeModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    d, _ = prepare(df, numeric, categorical)
    out = tm.model.transform(d.withColumn("_label", F.lit(0.0)))
    return out.withColumn("tree_probability", vector_to_array("probability")[1])


def importance(tm: TreeModel, spark) -> DataFrame:
    """Gain-style importances folded back to original features (value +
    missing indicator), with share and rank; ``used`` = importance > 0."""
    imp = tm.model.stages[-1].featureImportances.toArray()
    per: dict[str, float] = {}
    for name, v in zip(tm.inputs if tm.features else [], imp):
        per[name[2:]] = per.get(name[2:], 0.0) + float(v)
    rows = sorted(per.items(), key=lambda kv: (-kv[1], kv[0]))
    total = sum(v for _, v in rows) or 1.0
    data = [(f, v, v / total, i + 1, v > 0) for i, (f, v) in enumerate(rows)]
    return spark.createDataFrame(data, "feature string, importance double, share double, rank int, used boolean")


def leakage_level(auc: float | None) -> str:
    if auc is None:
        return "not computable"
    return "high" if auc > LEAK_HIGH else "medium" if auc > LEAK_MEDIUM else "low"


# --- P23/M25 baseline: median fill + missing indicators + standardised logistic ---

BASELINE_FEATURES = ["ext_source_mean", "ext_source_min", "cc_utilization_avg", "bb_dpd_ratio", "prev_refused_ratio",
                     "inst_late_ratio", "credit_income_ratio", "annuity_income_ratio", "age_years", "flag_not_employed"]


def fit_baseline(train: DataFrame, label: str, features: Sequence[str] = BASELINE_FEATURES):
    """Median imputation (``Imputer``, approximate median), a missing indicator
    per feature, standardisation with centring, then an L2 logistic regression
    equal to C=1 (regParam = 1/n). Returns a fitted pipeline."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Imputer, StandardScaler

    d = train.select("*", *[F.col(f).cast("double").alias(f"b_{f}") for f in features],
                     *[F.col(f).isNull().cast("double").alias(f"mi_{f}") for f in features],
                     F.col(label).cast("double").alias("_label"))
    n = d.count()
    stages = [
        Imputer(strategy="median", inputCols=[f"b_{f}" for f in features], outputCols=[f"bi_{f}" for f in features],
                relativeError=0.0001),
        VectorAssembler(inputCols=[f"bi_{f}" for f in features] + [f"mi_{f}" for f in features], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol="_label", featuresCol="features", regParam=1.0 / max(n, 1),
                           standardization=False, maxIter=200),
    ]
    return Pipeline(stages=stages).fit(d)


def predict_baseline(model, df: DataFrame, features: Sequence[str] = BASELINE_FEATURES) -> DataFrame:
    d = df.select("*", *[F.col(f).cast("double").alias(f"b_{f}") for f in features],
                  *[F.col(f).isNull().cast("double").alias(f"mi_{f}") for f in features])
    return model.transform(d).withColumn("baseline_probability", vector_to_array("probability")[1])

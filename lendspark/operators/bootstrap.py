"""Bootstrap uncertainty of AUC (M16) and of a paired AUC difference.

Poisson bootstrap over rows: a row's weight in a replicate is Poisson(1), drawn by inverse CDF from a 64-bit counter hash
of (row id, replicate): reproducible, independent of order and partitioning, and the same for every score of a row, which
makes the paired test paired. Rows of a NULL id are drawn as id 0.

Rows are range-partitioned by score and id once; a task draws all replicates of its rows block by block and keeps three
numbers a replicate: positives, negatives and the pairs ordered inside its range, with its first and its last score apart,
as their rows may go on in other tasks. Those small sums, not rows x replicates, are exchanged; pairs across ranges follow
from them. So time follows rows x replicates, and memory the block.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.operators.histogram import cumulative_below

REPLICATES = 2000
ROWS_PER_TASK = 200_000
DRAWS_AT_ONCE = 1 << 21

# The increment and multipliers of the counter hash (a published 64-bit mixer).
GAMMA, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def poisson_table(length: int = 25) -> np.ndarray:
    """P(W <= 0), P(W <= 1), ... of Poisson(1), as far as doubles tell them from 1."""
    out, term = [], math.exp(-1.0)
    acc = term
    for k in range(1, length + 1):
        out.append(acc)
        term = term / k
        acc += term
    return np.array(out)


def uniforms(ids: np.ndarray, replicates: int) -> np.ndarray:
    """U[0, 1) of each (id, replicate)."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64)[:, None] + np.uint64(GAMMA) * np.arange(1, replicates + 1, dtype=np.uint64)[None, :]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX_1)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX_2)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def row_weights(ids: np.ndarray, replicates: int) -> np.ndarray:
    """Weights (rows x replicates)."""
    return np.searchsorted(poisson_table(), uniforms(ids, replicates), side="right").astype(np.float64)


def range_sums(score: np.ndarray, label: np.ndarray, ids: np.ndarray, replicates: int) -> list[tuple[float, bool, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows in order of score as up to three stretches (least score, one score only, and for each replicate positives,
    negatives and ordered pairs, ties counting half): the first score, the last one, and those between. The pairs of one
    score alone are left at 0, as its rows may go on elsewhere."""
    zero = np.zeros(replicates)
    step, edges = max(1, DRAWS_AT_ONCE // replicates), {}
    between, positive, negative, pairs = None, zero, zero, zero
    held = None                                                  # score and sums of a value that may go on

    def close(scores: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        nonlocal between, positive, negative, pairs
        inner = (scores != score[0]) & (scores != score[-1])
        for at in np.flatnonzero(~inner):
            edges[scores[at]] = (pos[at], neg[at])
        if not inner.any():
            return
        between = scores[inner][0] if between is None else between
        pos, neg = pos[inner], neg[inner]
        below = negative + np.cumsum(neg, axis=0) - neg
        pairs = pairs + (pos * (below + 0.5 * neg)).sum(axis=0)
        positive, negative = positive + pos.sum(axis=0), negative + neg.sum(axis=0)

    for at in range(0, len(score), step):
        s, y = score[at:at + step], label[at:at + step, None]
        w = row_weights(ids[at:at + step], replicates)
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        pos, neg = np.add.reduceat(w * y, first, axis=0), np.add.reduceat(w * (1 - y), first, axis=0)
        if held is not None:
            if held[0] == s[0]:
                pos[0] += held[1]
                neg[0] += held[2]
            else:
                close(np.array([held[0]]), held[1][None], held[2][None])
        close(s[first][:-1], pos[:-1], neg[:-1])
        held = (s[-1], pos[-1], neg[-1])
    if held is not None:
        close(np.array([held[0]]), held[1][None], held[2][None])
    out = [(float(at), True, pos, neg, zero) for at, (pos, neg) in edges.items()]
    return out if between is None else [*out, (float(between), False, positive, negative, pairs)]


def _sums(groups: list[str], replicates: int):
    def run(batches):
        rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is None:                                   # at most about ROWS_PER_TASK rows otherwise
            return
        keys = list(zip(*[rows[g].to_pylist() for g in groups], strict=True)) if groups else [()] * rows.num_rows
        score, label, ids = (rows[c].to_numpy() for c in ("_s", "_y", "_id"))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            for low, single, *sums in range_sums(score[a:b], label[a:b], ids[a:b], replicates):
                lists = [pa.array([x], pa.list_(pa.float64())) for x in sums]
                yield pa.RecordBatch.from_arrays([*[rows[g].combine_chunks()[a:a + 1] for g in groups], pa.array([low], pa.float64()), pa.array([single]), *lists],
                                                 [*groups, "low", "single", "pos", "neg", "pairs"])

    return run


def replicate_aucs(rows: DataFrame, groups: Sequence[str], replicates: int = REPLICATES) -> DataFrame:
    """(groups..., replicate, auc) from rows (groups..., _s score, _y label, _id); NULL where a replicate has only one
    class."""
    groups, spark = list(groups), rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / ROWS_PER_TASK))
    kinds = ", ".join(f"`{g}` {rows.schema[g].dataType.simpleString()}" for g in groups)
    ordered = rows.repartitionByRange(parts, *groups, "_s", "_id").sortWithinPartitions(*groups, "_s")
    sums = ordered.mapInArrow(_sums(groups, replicates), f"{kinds}{', ' if groups else ''}low double, single boolean, pos array<double>, neg array<double>, pairs array<double>")
    each = sums.select(*groups, "low", "single", F.posexplode(F.arrays_zip("pos", "neg", "pairs")).alias("replicate", "x")).select(
        *groups, "low", "single", "replicate", "x.*")      # stretches x replicates rows
    whole = each.groupBy(*groups, "replicate", "low", "single").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "pairs")])
    own = F.when(F.col("single"), F.col("pos") * F.col("neg") * 0.5).otherwise(F.col("pairs"))
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*groups, "replicate").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = whole.withColumn("pairs", own + F.col("pos") * below).groupBy(*groups, "replicate").agg(
        F.sum("pairs").alias("pairs"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return total.select(*groups, "replicate", F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("pairs") / (F.col("p") * F.col("n"))).alias("auc"))


def _row(score: str, label: str, id_col: str) -> list[Column]:
    """A row's _s (0.0 for -0.0), _y and _id."""
    return [(F.col(score).cast("double") + F.lit(0.0)).alias("_s"), F.col(label).cast("double").alias("_y"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("_id")]


def weighted_auc(df: DataFrame, groups: Sequence[str], score: str, label: str, weight: str | None = None,
                 n_buckets: int = 256) -> DataFrame:
    """Mid-rank AUC per group from a weighted histogram; NULL when a group has only one class."""
    groups = list(groups)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(label).cast("double")
    hist = df.groupBy(*groups, F.col(score).cast("double").alias("_s")).agg(
        F.sum(w * y).alias("pos"), F.sum(w * (F.lit(1.0) - y)).alias("neg"))
    cum = cumulative_below(hist, groups, "_s", ["pos", "neg"], n_buckets=n_buckets)
    auc = cum.groupBy(*groups).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("_num"),
        F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n"))
    return auc.select(*groups, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                      F.col("_num") / (F.col("_p") * F.col("_n"))).alias("auc"))


def _usable(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    for s in scores:
        df = df.where(F.col(s).isNotNull() & ~F.isnan(F.col(s).cast("double")))
    return df.where(F.col(label).isNotNull())


def bootstrap_auc(df: DataFrame, groups: Sequence[str], id_col: str, score: str, label: str,
                  replicates: int = REPLICATES) -> DataFrame:
    """Per group the AUC and its 95 % percentile interval. Rows without score or label are left out."""
    groups, df = list(groups), _usable(df, [score], label)
    reps = replicate_aucs(df.select(*groups, *_row(score, label, id_col)), groups, replicates).where(F.col("auc").isNotNull())
    ends = F.percentile("auc", F.array(F.lit(0.025), F.lit(0.975)))        # of ``replicates`` values a group
    ci = reps.groupBy(*groups).agg(ends[0].alias("ci_low"), ends[1].alias("ci_high"), F.count(F.lit(1)).alias("replicates"))
    point = weighted_auc(df, groups, score, label)
    if groups:
        return point.join(ci, groups, "left")
    return point.withColumn("_k", F.lit(1)).join(ci.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")


def paired_difference(df: DataFrame, id_col: str, score_a: str, score_b: str, label: str,
                      replicates: int = REPLICATES) -> DataFrame:
    """AUC(a) − AUC(b) with a paired percentile interval and the two-sided p = min(1, 2·min(P(d ≤ 0), P(d ≥ 0))).
    ``df`` is wide (both scores per row); rows without both scores and the label are left out."""
    df = _usable(df, [score_a, score_b], label).select(
        id_col, F.col(label).cast("double").alias("_y"), F.col(score_a).cast("double").alias(score_a), F.col(score_b).cast("double").alias(score_b))
    rows = df.unpivot([id_col, "_y"], [score_a, score_b], "model", "score").select("model", *_row("score", "_y", id_col))
    reps = replicate_aucs(rows, ["model"], replicates)
    of = lambda frame, m: F.max(F.when(F.col("model") == m, F.col("auc")))
    d = reps.groupBy("replicate").agg((of(reps, score_a) - of(reps, score_b)).alias("d")).where(F.col("d").isNotNull())
    ends = F.percentile("d", F.array(F.lit(0.025), F.lit(0.975)))          # of ``replicates`` values
    ci = d.agg(ends[0].alias("ci_low"), ends[1].alias("ci_high"), F.avg((F.col("d") <= 0).cast("double")).alias("_le"),
               F.avg((F.col("d") >= 0).cast("double")).alias("_ge"), F.count(F.lit(1)).alias("replicates"), F.lit(1).alias("_k"))
    point = weighted_auc(df.unpivot([id_col, "_y"], [score_a, score_b], "model", "score"), ["model"], "score", "_y")
    difference = point.agg((of(point, score_a) - of(point, score_b)).alias("difference"), F.lit(1).alias("_k"))
    return difference.join(ci, "_k").select(              # one row each, joined on a constant key
        F.lit(score_a).alias("model_a"), F.lit(score_b).alias("model_b"), "difference", "ci_low", "ci_high",
        F.least(F.lit(1.0), 2 * F.least("_le", "_ge")).alias("p_value"), "replicates")

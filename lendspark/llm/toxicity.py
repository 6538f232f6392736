"""Toxic passages by maximum-scoring segments.

Model: log-odds of "toxic" against "not toxic" for the words of labelled documents and for their
beginnings (``stems``: lengths in bytes), from the numbers of documents that hold them (so that one
long text counts once), with a Dirichlet prior of the background shares. Terms seen in fewer than
``least_count`` documents, or whose log-odds do not stand out (``|z| < least_z``), are left out; at most
``most_terms`` stay (the strongest): the model's size is bounded whatever the corpus. A word has its own
weight, else that of its longest beginning in the model (so unseen forms count), else 0; always less
``drift``.

Search: every document is scanned once, from left to right, for all maximal scoring segments
(Ruzzo and Tompa's linear-time algorithm). A document's best segment is judged by extreme-value
statistics: the chance that n words without toxic passages hold a segment of score s is
1 - exp(-k * n * exp(-lambda * s)), where lambda is the positive root of E[exp(lambda * w)] = 1
over the word weights of non-toxic documents. Passages that are significant by themselves are
returned as spans of words. A logistic curve (two coefficients, fitted on the labelled documents'
scores) turns the evidence into a score from 0 to 1.

The classifier (weights and curve) is fitted on at most ``fit_rows`` labelled training documents,
those that come first by a hash of the id; that sample's ids are the only thing broadcast besides
the model. Everything is scored from whole texts. Labels with null doc_id or null toxic are
left out; a document's label is the largest of its label rows. Without labels of both kinds
every score is 0. Null or empty text: no words, no segment: the score of no evidence.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored


#: Evidence is cut at plus and minus this; beyond it the score is 0 or 1 anyway.
LIMIT = 20.0


@dataclass(frozen=True)
class Toxicity:
    stems: tuple[int, ...] = (4, 5, 6, 7, 8)
    prior: float = 2.0
    least_z: float = 3.5
    most_terms: int = 100_000
    least_count: int = 5
    drift: float = 0.5
    cap: float = 6.0
    alpha: float = 0.01
    fit_rows: int = 200_000


def tokens(raw: bytes | None) -> list[bytes]:
    return raw.lower().split() if raw else []


def _count(batches: Iterator, stems: tuple[int, ...]) -> Iterator[pd.DataFrame]:
    """Terms (words, and beginnings after a line feed) with the numbers of toxic and other documents that hold them;
    the line feed alone stands for all documents."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pd.DataFrame:
        keys = sorted(seen[0].keys() | seen[1].keys())
        out = pd.DataFrame({"term": keys, "toxic_n": [seen[1][k] for k in keys], "other_n": [seen[0][k] for k in keys]})
        seen[0].clear()
        seen[1].clear()
        return out

    for batch in batches:
        for raw, label in zip(batch["text"], batch["toxic"]):
            own = set(tokens(raw))
            into = seen[int(label)]
            into.update(own)
            for n in stems:
                into.update({b"\n" + w[:n] for w in own if len(w) > n})
            into[b"\n"] += 1
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield flush()
    yield flush()


def training_rows(docs: DataFrame, labels: DataFrame, cfg: Toxicity) -> DataFrame:
    """(doc_id, text, toxic) of the first ``fit_rows`` labelled documents in hash order."""
    label = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    sample = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.fit_rows)
    return docs.select("doc_id", F.encode("text", "utf-8").alias("text")).join(F.broadcast(sample), "doc_id")


def term_weights(train: DataFrame, cfg: Toxicity = Toxicity()) -> dict[bytes, float]:
    """Weights of words, and of beginnings under a line feed and the beginning."""
    stems = cfg.stems
    counted = stored(
        train.select("text", "toxic").mapInPandas(lambda it: _count(it, stems), "term binary, toxic_n long, other_n long")
        .groupBy("term").agg(F.sum("toxic_n").alias("a"), F.sum("other_n").alias("b"))
        .where((F.col("a") + F.col("b") >= cfg.least_count) | (F.length("term") == 1)))
    total = counted.where(F.col("term") == F.lit(b"\n")).first()
    if total is None or not total["a"] or not total["b"]:
        return {}
    n_a, n_b = float(total["a"]), float(total["b"])
    y, z = F.col("a") + cfg.prior * n_a / (n_a + n_b), F.col("b") + cfg.prior * n_b / (n_a + n_b)
    weight = F.log(y / z) - math.log(n_a / n_b)
    scored = counted.where(F.col("term") != F.lit(b"\n")).select(
        "term", weight.alias("weight"), (F.abs(weight) / F.sqrt(1 / y + 1 / z)).alias("z"))
    rows = scored.where(F.col("z") >= cfg.least_z).orderBy(F.desc("z"), "term").limit(cfg.most_terms).collect()
    return {bytes(r["term"]): float(max(-cfg.cap, min(cfg.cap, r["weight"]))) for r in rows}


def maximal_segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), left to right, in linear time."""
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at end, last one that began lower
    total = 0.0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        start, left, k = i, before, len(found) - 1
        while True:
            while k >= 0 and found[k][2] >= left:
                k = found[k][4]
            if k < 0 or found[k][3] >= total:
                break
            start, left, nxt = found[k][0], found[k][2], found[k][4]
            del found[k:]
            k = nxt
        found.append((start, i + 1, left, total, k))
    return [(s, e, r - b) for s, e, b, r, _ in found]


class Scanner:
    """Word weights of a text and its segments."""

    def __init__(self, weights: dict[bytes, float], cfg: Toxicity):
        self.weights, self.cfg = weights, cfg
        self.cache: dict[bytes, float] = {}

    def weight(self, word: bytes) -> float:
        w = self.cache.get(word)
        if w is None:
            found = self.weights.get(word)
            for n in sorted(self.cfg.stems, reverse=True) if found is None else ():
                if len(word) >= n and (found := self.weights.get(b"\n" + word[:n])) is not None:
                    break
            w = (found or 0.0) - self.cfg.drift
            if len(self.cache) > 300_000:
                self.cache.clear()
            self.cache[word] = w
        return w

    def scan(self, raw: bytes | None) -> tuple[int, float, list[tuple[int, int, float]]]:
        own = tokens(raw)
        segments = maximal_segments([self.weight(w) for w in own])
        return len(own), max((s for _, _, s in segments), default=0.0), segments


def _null_lambda(histogram: dict[int, float]) -> float:
    """Positive root of E[exp(lambda w)] = 1; w in tenths, from non-toxic text."""
    w = np.array(sorted(histogram)) / 10.0
    p = np.array([histogram[k] for k in sorted(histogram)], dtype=float)
    p /= p.sum()
    if not (w > 0).any() or (p * w).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while (p * np.exp(high * w)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * w)).sum() < 1 else (low, mid)
    return float(low)


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    cfg: Toxicity
    lam: float
    slope: float
    shift: float

    def evidence(self, n: int, best: float) -> float:
        """Extreme-value score of a best segment: lambda * s - ln(n)."""
        return max(-LIMIT, min(LIMIT, self.lam * best - math.log(max(n, 1))))

    def score(self, n: int, best: float) -> float:
        if not self.weights:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * self.evidence(n, best) + self.shift))))


def fit(docs: DataFrame, labels: DataFrame, cfg: Toxicity = Toxicity()) -> Model:
    """Fits on the given rows alone: hand over the training rows."""
    spark = docs.sparkSession
    train = training_rows(docs, labels, cfg)
    weights = term_weights(train, cfg)
    if not weights:
        return Model({}, cfg, 1.0, 1.0, 0.0)
    shared = spark.sparkContext.broadcast(weights)

    def measure(batches):
        scanner = Scanner(shared.value, cfg)
        for batch in batches:
            rows = [scanner.scan(raw)[:2] for raw in batch["text"]]
            hist = [np.unique(np.round(np.array([scanner.weight(w) for w in tokens(raw)] or [0.0]) * 10).astype(int), return_counts=True)
                    for raw in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "n": [r[0] for r in rows], "best": [r[1] for r in rows],
                                "w": [h[0].tolist() for h in hist], "c": [h[1].tolist() for h in hist]})

    seen = stored(train.mapInPandas(measure, "doc_id long, toxic int, n long, best double, w array<int>, c array<long>"))
    hist = {r["w"]: float(r["c"]) for r in seen.where("toxic = 0").select(F.inline(F.arrays_zip("w", "c")))
            .groupBy("w").agg(F.sum("c").alias("c")).collect()}  # weights in tenths, cut at +-cap: some 140 values
    lam = _null_lambda(hist)
    sample = seen.select("n", "best", "toxic").toPandas()  # fit_rows at most
    x = np.clip(lam * sample["best"].to_numpy() - np.log(np.maximum(sample["n"].to_numpy(), 1)), -LIMIT, LIMIT)
    y = sample["toxic"].to_numpy().astype(float)
    slope, shift = _logistic(x, y)
    return Model(weights, cfg, lam, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Two-parameter logistic fit by Newton steps."""
    mean, dev = x.mean(), x.std() or 1.0
    u = np.column_stack([(x - mean) / dev, np.ones(len(x))])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(u @ b, -30, 30)))
        g = u.T @ (p - y) / len(y) + ridge * b
        h = (u * (p * (1 - p))[:, None]).T @ u / len(y) + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0] / dev), float(b[1] - b[0] * mean / dev)


def score_toxicity(docs: DataFrame, model: Model, *, passages: bool = True) -> DataFrame:
    """``docs`` (doc_id, text): doc_id, n_words, best (segment score), p_value, score, predicted and, with
    ``passages``, the significant segments as (start, end, score) in words. Other columns are left out."""
    spark = docs.sparkSession
    cfg, lam, slope, shift = model.cfg, model.lam, model.slope, model.shift
    shared = spark.sparkContext.broadcast(model.weights)

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        m = Model(shared.value, cfg, lam, slope, shift)
        scanner = Scanner(m.weights, cfg)
        for batch in batches:
            out = []
            for raw in batch.column(1).to_pylist():
                n, best, segments = scanner.scan(raw)
                p = -math.expm1(-min(50.0, max(n, 1) * math.exp(-m.lam * best))) if best > 0 else 1.0
                found = [{"start": s, "end": e, "score": v} for s, e, v in segments
                         if max(n, 1) * math.exp(-m.lam * v) <= m.cfg.alpha] if passages else []
                out.append((n, best, p, m.score(n, best), found))
            cols = list(zip(*out)) if out else [()] * 5
            types = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=t) for c, t in zip(cols, types))],
                names=["doc_id", "n_words", "best", "p_value", "score", "passages"])

    scored = docs.select("doc_id", F.encode("text", "utf-8").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, best double, p_value double, score double, "
             "passages array<struct<start:int,end:int,score:double>>")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

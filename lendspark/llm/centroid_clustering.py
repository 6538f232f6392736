"""Centroid clustering with Ptolemaic pivots, in exact whole numbers.

Vectors of ``dims`` finite components become whole numbers floor(scale * x). Start centroids are the vectors of least
hash; every round assigns each vector to its nearest centroid (ties: smaller number) and replaces non-empty centroids
by the floor of their vectors' mean.

A few fixed pivot vectors are far from each other. Every vector's distances to them are computed once and stored with
it; a centroid's are computed when it moves. For a pair of pivots p, q Ptolemy's inequality gives the lower bound

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

from cached numbers alone. The greatest over the pairs, rounded down by more than its arithmetic can err, is compared
with the exact distance of the best centroid so far; only centroids that it leaves are compared exactly, in 64-bit
integers. So results are those of a full comparison.

The driver sees centroids, pivots and one row of sums a cluster, never rows of the table. Sums are taken in each
task before the shuffle, so a vector that makes up a third of the rows costs nothing extra.

Vectors that are null, of another length, or hold a null or non-finite component are left out. Components beyond
2^27 once scaled are an error: squared distances would not fit in a long. Equal ids: vectors of their own, ordered by
their components as start centroids; null ids start last. Fewer vectors than clusters: as many clusters as vectors.
Other columns are ignored. Empty table: no rows.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored


@dataclass(frozen=True)
class Clustering:
    clusters: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    seed: int = 2
    pivots: int = 6


LARGEST = 1 << 27
#: More than the relative error of a product of two distances (each a rounded square root of a rounded integer).
SLACK = 1e-14
BLOCK = 4096


def _whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * vectors.astype(np.float64))
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} once scaled: squared distances would not fit in a long")
    return out.astype(np.int64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to rows (or the one row) of ``b``."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def spread(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different ones of the vectors, each the farthest from those before it."""
    chosen = vectors[:1]
    while 0 < len(chosen) < n:
        least = np.min([_squared(vectors, p) for p in chosen], axis=0)
        if least.max() == 0:
            break
        chosen = np.concatenate([chosen, vectors[[least.argmax()]]])
    return chosen


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squared(vectors, p) for p in pivots], axis=1).astype(np.float64)) if len(pivots) else np.zeros((len(vectors), 0))


def lower_bounds(of: np.ndarray, centres: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances that vectors (rows of pivot distances ``of``) have at least to the centroids (``centres``)."""
    between, best = pivot_distances(pivots, pivots), np.zeros((len(of), len(centres)))
    for p in range(len(pivots)):
        for q in range(p):
            one, two = np.outer(of[:, p], centres[:, q]), np.outer(of[:, q], centres[:, p])
            np.maximum(best, (np.abs(one - two) - SLACK * (one + two)) / between[p, q], out=best)
    return best * best * (1 - SLACK)


def nearest(vectors: np.ndarray, of: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how many exact distances that took."""
    centres = pivot_distances(centroids, pivots)
    number, distance, taken = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64), 0
    for at in range(0, len(vectors), BLOCK):
        own, low = vectors[at:at + BLOCK], lower_bounds(of[at:at + BLOCK], centres, pivots)
        to = low.argmin(axis=1)
        best = _squared(own, centroids[to])
        taken += len(own)
        first = to.copy()
        for c in range(len(centroids)):
            rows = np.flatnonzero((low[:, c] <= best) & (first != c))
            d = _squared(own[rows], centroids[c])
            taken += len(rows)
            nearer = (d < best[rows]) | ((d == best[rows]) & (c < to[rows]))
            to[rows[nearer]], best[rows[nearer]] = c, d[nearer]
        number[at:at + BLOCK], distance[at:at + BLOCK] = to, best
    return number, distance, taken


def _columns(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
    vectors = flat("v").reshape(-1, dims).astype(np.int64)
    return vectors, flat("to_pivots").reshape(len(vectors), -1)


def _prepare(settings: Clustering, pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = _whole(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.dims), settings.scale)
                lists = lambda a, kind: pa.ListArray.from_arrays(
                    pa.array(np.arange(len(v) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel(), kind))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists(v, pa.int32()), lists(pivot_distances(v, pivots), pa.float64())], ["id", "v", "to_pivots"])

    return run


def _sums(settings: Clustering, centroids: np.ndarray, pivots: np.ndarray):
    """A task's vectors to one row of count and sums for each cluster that has any."""

    def run(batches):
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            vectors, of = _columns(batch, settings.dims)
            to, _, _ = nearest(vectors, of, centroids, pivots)
            n += np.bincount(to, minlength=len(n))
            for c in np.unique(to):
                total[c] += vectors[to == c].sum(axis=0)
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(full, pa.int64()), "n": pa.array(n[full]), "sums": pa.array(total[full].tolist(), pa.list_(pa.int64()))})

    return run


def _assign(settings: Clustering, centroids: np.ndarray, pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            to, distance, _ = nearest(*_columns(batch, settings.dims), centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to), pa.array(distance)], ["id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, settings: Clustering = Clustering(), *, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """All vectors that count with their ``cluster``, squared ``distance``, the ``cluster_inertia`` and ``inertia`` (sums of
    distances over the cluster and over all) and the centroid's ``centroid_sha256`` (of its components, comma-joined);
    and the final centroids."""
    spark, dims = vectors.sparkSession, settings.dims
    source = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).where(
        (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
    kind = source.schema["id"].dataType.simpleString()

    order = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("id").cast("string")), 256)
    start = source.orderBy(order.asc_nulls_last(), "v").limit(settings.clusters).select("v").collect()  # as many rows as clusters
    centroids = _whole(np.array([r["v"] for r in start], np.float64).reshape(len(start), dims), settings.scale)
    pivots = spread(centroids, settings.pivots)

    table = stored(source.mapInArrow(_prepare(settings, pivots), f"id {kind}, v array<int>, to_pivots array<double>"))
    for _ in range(settings.rounds if len(centroids) else 0):
        sums = table.mapInArrow(_sums(settings, centroids, pivots), "cluster bigint, n bigint, sums array<bigint>")
        moved = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(dims)]).alias("sums"))
        centroids = centroids.copy()
        for r in moved.collect():  # one row a cluster
            centroids[r["cluster"]] = [s // r["n"] for s in r["sums"]]

    assigned = stored(table.mapInArrow(_assign(settings, centroids, pivots), f"id {kind}, cluster bigint, distance bigint"))
    per_cluster = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = [(c, d, sum(per_cluster.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in per_cluster.items()]
    known = spark.createDataFrame(facts, "cluster bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = assigned.join(F.broadcast(known), "cluster").select(  # as many rows as clusters
        F.col("id").alias(id), F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out, centroids

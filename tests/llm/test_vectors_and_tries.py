"""Clustering and conversation trie against brute force: nulls, ties, repeated rows, empty tables, clashing names, long paths."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm.centroid_clustering import Clustering, cluster_vectors, lower_bounds, nearest, pivot_distances, spread
from lendspark.llm.conversation_trie import SpillingQueue, Trie, own_turns, prefix_trie
from lendspark.llm.queries import op12_centroid_clustering, op13_conversation_trie

VECTORS = "vec_id long, embedding array<float>"


def clustered(rows, clusters=40, rounds=5, dims=64):
    """(id, cluster, distance) and final centroids, by comparing everything."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        of = defaultdict(list)
        for (_, v), (_, k) in zip(kept, assign(), strict=True):
            of[k].append(v)
        for k, vs in of.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return [(i, k, d) for (i, _), (d, k) in zip(kept, assign(), strict=True)], centroids


def some_vectors(n=150, dims=64, seed=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.2) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.03) for x in centres[i % 6]]) for i in range(n)]
    rows += [(n + k, rows[3][1]) for k in range(30)]  # a hot vector: ties
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[1][1]), (None, rows[2][1])]  # repeated and null ids
    bad = list(rows[0][1])
    return rows + [(900, None), (901, []), (902, bad[:63]), (903, bad + [0.0]), (904, [None] + bad[1:]), (905, [float("nan")] + bad[1:]),
                   (906, [float("inf")] + bad[1:]), (907, [0.0] * 64), (908, [-0.0] * 64)]


def test_clusters_as_brute_force(spark, tmp_path):
    rows = some_vectors()
    spark.createDataFrame(rows, VECTORS).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, centroids = clustered(rows)
    inertia = Counter()
    for _, k, d in want:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    got = op12_centroid_clustering(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for i, k, d in want), key=str)


def test_fewer_vectors_than_clusters_text_ids_and_other_columns(spark):
    rows = [("a", [1.0, 2.0]), ("b", [1.0, 2.0]), ("c", [-3.0, 0.5])]
    names = ["id", "v", "to_pivots", "cluster", "distance"]
    df = spark.createDataFrame(rows, "name string, point array<double>").select("*", *[F.lit(1).alias(n) for n in names])
    out, centroids = cluster_vectors(df, Clustering(dims=2, clusters=5), id="name", vector="point")
    want, expected = clustered(rows, 5, dims=2)
    assert sorted((r["name"], r["cluster"], r["distance"]) for r in out.collect()) == sorted(want)
    assert centroids.tolist() == expected


def test_no_vectors(spark):
    out, centroids = cluster_vectors(spark.createDataFrame([(1, None)], VECTORS))
    assert out.collect() == [] and len(centroids) == 0


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit in a long"):
        cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], VECTORS))


def test_pivots_leave_out_centroids_and_never_the_nearest():
    r = np.random.default_rng(7)
    centroids = r.integers(-300, 300, (40, 64))
    vectors = centroids[r.integers(0, 40, 5000)] + r.integers(-12, 13, (5000, 64))
    pivots = spread(centroids, 6)
    of = pivot_distances(vectors, pivots)
    exact = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (lower_bounds(of, pivot_distances(centroids, pivots), pivots) <= exact).all()
    to, distance, taken = nearest(vectors, of, centroids, pivots)
    assert (to == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert taken < 0.5 * exact.size


def test_bounds_hold_where_they_are_equalities():
    line = np.arange(0, 4000, 7)[:, None] * np.array([[3, 4]]) + 1  # points of one line, far from the origin too
    for shift in (0, 10**6):
        points = line + shift
        pivots = spread(points, 6)
        low = lower_bounds(pivot_distances(points, pivots), pivot_distances(points[::9], pivots), pivots)
        assert (low <= ((points[:, None, :] - points[None, ::9]) ** 2).sum(axis=2)).all()


CHATS = "conv_id long, turn long, role string, text string"


def trie(paths: dict[int, list]) -> list[tuple]:
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(node))))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def own(rows) -> dict[int, list]:
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t)] for c, t in by.items()}


def rebuilt(rows) -> dict[int, list]:
    turns, out = own(rows), {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + t[h:]
    return out


def chats(n=120, seed=1):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 17 == 5:
            continue  # gaps: heads that are absent
        for t in range(r.choice([1, 2, 3, 4, 8])):
            rows.append((c, t, ("user", "assistant")[t % 2], r.choice(["hi", "yes", "é ß", "no\nno"]) if t else "hello"))
    rows += [(c, t, "user", "hot") for c in range(200, 260) for t in range(3)]  # one common conversation
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(400)] + [(305, t, "user", f"turn {t % 3}") for t in range(300)]  # long ones
    rows += [(400, None, "user", "x"), (400, 0, None, None), (400, 1, None, ""), (400, 2, "", None), (None, 0, "user", "nobody")]
    rows += [(405, 3, "user", "same"), (405, 3, "user", "same"), (406, 0, "ab", "c"), (407, 0, "a", "bc")]
    return rows


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_query_as_brute_force(spark, tmp_path):
    spark.createDataFrame(chats(), CHATS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_conversation_trie(spark, str(tmp_path))) == trie(rebuilt(chats()))


@pytest.mark.parametrize("settings", [Trie(), Trie(paths=2, fan=2, messages=2, piece=3)])
def test_many_shards_rounds_and_spills(spark, settings):
    rows = [r for r in chats(60, 2) if r[0] != 300]
    df = spark.createDataFrame(rows, CHATS).repartition(3).withColumns({"turns": F.lit(1), "n": F.lit(2), "path": F.lit(3)})
    assert got(prefix_trie(own_turns(df), settings)) == trie(own(rows))


def test_one_conversation_without_turns_and_none_at_all(spark):
    schema = "conv_id long, turns array<struct<turn:long,step:string,bytes:long>>"
    assert got(prefix_trie(spark.createDataFrame([(4, [])], schema))) == trie({4: []})
    assert got(prefix_trie(spark.createDataFrame([], schema))) == []
    assert got(prefix_trie(own_turns(spark.createDataFrame([], CHATS)))) == []


def test_equal_turns_have_one_order(spark):
    rows = [(c, 0, "user", t) for c in (1, 2) for t in ("b", "a", "c")]
    for seed in (1, 2):
        r = list(rows)
        random.Random(seed).shuffle(r)
        assert prefix_trie(own_turns(spark.createDataFrame(r, CHATS))).where("depth = 3 and n_convs = 2").count() == 1


def test_queue_spills_and_keeps_order():
    r = random.Random(3)
    queue, live, out = SpillingQueue(5), [], []
    floor = 0
    for _ in range(3000):
        if r.random() < 0.6 or not live:
            place = floor + r.randrange(50)
            queue.push((place, "x"), place)
            live.append(place)
        else:
            live.sort()
            assert queue.least() == (live[0], "x")
            place, message = queue.pop()
            assert place == (live[0], "x") and message == live.pop(0)
            floor = message
            out.append(message)
    while live:
        live.sort()
        assert queue.pop()[1] == live.pop(0)
    assert out == sorted(out) and queue.least() is None

"""Exact top-k search and centroid clustering against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import centroids, topk
from ledgerlens.llm.common import Stages, ready

SCHEMA = "vec_id long, embedding array<double>, rid string, score int, cluster string, cell int"


def frame(spark, rows):
    ready(spark)
    return spark.createDataFrame([(i, v, "x", 1, "y", 2) for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top_k(rows, k, every=50, bound=topk.BOUND):
    kept = [(i, [max(-bound, min(bound, math.floor(256 * x))) for x in v]) for i, v in rows if usable(v)]
    out = []
    for a, (qi, q) in enumerate(kept):
        if qi is None or qi % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i is None, i or 0) for b, (i, v) in enumerate(kept) if b != a)
        out += [(qi, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def got_top_k(spark, rows, k):
    df = topk.top_k(frame(spark, rows), Stages(spark, "t"), F.expr("vec_id % 50 = 0"), k=k)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dims, seed, spread=0.2):
    rng = random.Random(seed)
    return [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(n)]


def edge_rows():
    base = vectors(60, 8, 3)
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100 + i, base[7]) for i in range(20)]  # a common vector, all ties
    rows += [(50, base[3]), (50, base[3]), (100, base[50])]  # repeated query ids, equal and unlike rows
    rows += [(200, None), (201, [None] + [0.1] * 7), (250, [float("nan")] * 8), (300, [float("inf")] + [0.0] * 7)]
    rows += [(350, []), (351, [0.5]), (400, [0.25] * 12), (None, base[7]), (None, base[9])]
    rows += [(450, [1e300, -1e300] + [0.0] * 6), (451, [1e12] * 8)]
    return rows


@pytest.mark.parametrize("most", [8192, 7])
def test_top_k_of_edge_rows(spark, monkeypatch, most):
    monkeypatch.setattr(topk, "BLOCK_ROWS", most)
    rows = edge_rows()
    assert got_top_k(spark, rows, 5) == brute_top_k(rows, 5)


def test_top_k_of_more_than_all_rows_and_of_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.5, 0.25])]
    assert got_top_k(spark, rows, 5) == brute_top_k(rows, 5)
    assert got_top_k(spark, [(0, [1.0])], 5) == []
    assert got_top_k(spark, [], 5) == []
    assert got_top_k(spark, [(1, [1.0]), (2, [0.5])], 5) == []


def test_top_k_over_several_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    rows = [(i * 10, v) for i, v in enumerate(vectors(300, 16, 5))]
    assert got_top_k(spark, rows, 5) == brute_top_k(rows, 5)


def spiky(n, dims, seed):
    """Vectors whose weight lies on few dimensions."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 3, (n, dims))
    x[np.arange(n), rng.integers(0, dims, n)] += (256 * rng.pareto(1.5, n)).astype(np.int64) + 50
    return x.astype(np.int32)


def test_threshold_stops_long_before_the_lists_end():
    x = spiky(4000, 16, 1)
    block = topk.Block(x, topk.Block.sorted_lists(x))
    queries, own = x[:50].astype(np.int64), np.arange(50)
    i, j, s, scored = block.search(queries, own, 5)
    all_scores = queries @ x.astype(np.int64).T
    all_scores[np.arange(50), own] = -(1 << 60)
    want = [[(c, all_scores[q, c]) for c in np.lexsort((np.arange(4000), -all_scores[q]))[:5]] for q in range(50)]
    assert [list(zip(j[i == q], s[i == q])) for q in range(50)] == want
    assert scored < 50 * 4000 / 3


def test_threshold_meets_all_ties():
    x = np.ones((3000, 4), dtype=np.int32)
    block = topk.Block(x, topk.Block.sorted_lists(x))
    i, j, s, _ = block.search(np.ones((1, 4), dtype=np.int64), np.array([2]), 5)
    assert list(j) == [0, 1, 3, 4, 5] and set(s) == {4}


def brute_clusters(rows, k, rounds, dims=64, scale=1024, bound=centroids.BOUND):
    kept = [(i, [max(-bound, min(bound, math.floor(scale * x))) for x in v]) for i, v in rows if usable(v) and len(v) == dims]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "",
                     np.array(r[1], dtype="<i4").tobytes())
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    sq = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def place():
        return [min((sq(v, c), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for n in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == n]
            if own:
                cents[n] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    inertia = sum(d for d, _ in at)
    per = {n: sum(d for d, c in at if c == n) for n in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    top = (1 << 63) - 1
    return sorted(((i, c, d, min(per[c], top), min(inertia, top), sha[c]) for (i, _), (d, c) in zip(kept, at)), key=str)


def got_clusters(spark, rows, dims=64):
    out = centroids.cluster_vectors(frame(spark, rows).repartition(3), Stages(spark, "t"), k=8, rounds=10, dims=dims)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_clusters_equal_plain_rounds(spark):
    centers = vectors(5, 64, 9)
    rng = random.Random(2)
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centers[i % 5]]) for i in range(150)]
    rows += [(1000 + i, rows[4][1]) for i in range(40)] + [(7, rows[8][1]), (7, rows[8][1])]
    rows += [(None, rows[0][1]), (500, None), (501, [0.1] * 63), (502, [float("nan")] * 64), (503, [None] + [0.1] * 63), (504, [])]
    assert got_clusters(spark, rows) == brute_clusters(rows, 8, 10)


def test_clusters_of_few_equal_and_huge_vectors(spark):
    rows = [(1, [0.5] * 4), (2, [0.5] * 4), (3, [-0.5] * 4)]
    assert got_clusters(spark, rows, dims=4) == brute_clusters(rows, 8, 10, dims=4)
    rows = [(i, [0.25, -0.25, 0.0, 1e-9]) for i in range(30)]  # empty clusters, ties
    assert got_clusters(spark, rows, dims=4) == brute_clusters(rows, 8, 10, dims=4)
    rows = [(i, [1e300 * (-1) ** i, 1e9, -1e9 * (i % 3), 3.0]) for i in range(20)]
    assert got_clusters(spark, rows, dims=4) == brute_clusters(rows, 8, 10, dims=4)
    assert got_clusters(spark, []) == []
    assert got_clusters(spark, [(1, None)]) == []


def test_pivots_save_exact_distances():
    rng = np.random.default_rng(4)
    means = rng.integers(-3000, 3000, (8, 64))
    x = (means[rng.integers(0, 8, 2000)] + rng.integers(-100, 100, (2000, 64))).astype(np.int64)
    pivots = centroids.choose_pivots(x[:8], x[:300], centroids.PIVOTS)
    table = centroids._distances(x, pivots)
    cents = means.astype(np.int64)
    cluster, best, exact = centroids.assign(x, table, cents, pivots)
    d = ((x[:, None, :] - cents[None]) ** 2).sum(-1)
    assert (cluster == d.argmin(1)).all() and (best == d.min(1)).all()
    assert exact < 1.2 * len(x)  # of 8 distances each

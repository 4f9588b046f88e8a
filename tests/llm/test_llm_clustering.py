"""Clustering with bounds against the plain algorithm."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.clustering import Centroids, assign, cluster_vectors


def plain(rows, k, rounds, scale, seed="2"):
    """Every vector against every centroid, in whole numbers of any size."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        where = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), w in zip(kept, where, strict=True) if w == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted((i, nearest(v)[1], nearest(v)[0], tuple(centroids[nearest(v)[1]])) for i, v in kept)


@given(
    st.integers(1, 9),
    st.lists(st.lists(st.tuples(*[st.integers(-4, 4)] * 2), min_size=9, max_size=9), min_size=1, max_size=4),
    st.lists(st.tuples(*[st.integers(-6, 6)] * 2), min_size=1, max_size=60),
)
@settings(max_examples=150, deadline=None)
def test_bounds_never_change_the_answer(k, moves, vectors):
    x = np.array(vectors, np.int64)
    near, second = np.zeros(len(x), np.int32), np.full(len(x), min(1, k - 1), np.int32)
    upper, lower = np.full(len(x), np.inf), np.full(len(x), -np.inf)
    c = None
    for points in moves:
        points = np.array(points[:k], np.int64)
        c = Centroids.start(points) if c is None else c.after(points)
        assign(x, near, second, upper, lower, c)
        d = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
        assert near.tolist() == d.argmin(axis=1).tolist()
        if k > 1:
            assert (upper**2 >= d.min(axis=1) * (1 - 1e-6)).all()
            rest = np.where(np.arange(k) == near[:, None], np.iinfo(np.int64).max, d)
            assert (np.maximum(lower, 0) ** 2 <= rest.min(axis=1) * (1 + 1e-6)).all()


@pytest.mark.parametrize("k", [1, 2, 7, 200])
def test_whole_clusters(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.normal(size=5) + 3 * (i % 4)).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]
    got = cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=k, rounds=4, dim=5, scale=16.0)
    found = got.collect()
    assert sorted((r.vec_id, r.cluster, r.distance, tuple(r.centroid)) for r in found) == plain(rows, k, 4, 16.0)
    total = sum(r.distance for r in found)
    for r in found:
        assert r.inertia == total and r.cluster_inertia == sum(o.distance for o in found if o.cluster == r.cluster)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5], "a"), (1, [0.5, -0.5], "b"), (None, [9.0, 9.0], "c"), (2, None, None), (3, [], "d"), (4, [1.0], "e"), (5, [1.0, 2.0, 3.0], "f")]
    rows += [(6, [None, 1.0], "g"), (7, [nan, 1.0], "h"), (8, [inf, 1.0], "i"), (9, [1e30, 1.0], "j"), (10, [-3.3, 4.1], "k")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, near string")
    got = cluster_vectors(table, k=3, rounds=2, dim=2, scale=10.0).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 1, 1, 10]
    assert {tuple(r.centroid) for r in got} == {(5, -5), (-33, 41), (90, 90)} or sum(r.distance for r in got) > 0
    assert cluster_vectors(table.limit(0), k=3, dim=2).count() == 0
    assert cluster_vectors(table.where("vec_id = 3"), k=3, dim=2).count() == 0

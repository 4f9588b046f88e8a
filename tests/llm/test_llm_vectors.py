"""Linked vectors against all pairs."""

from __future__ import annotations

import numpy as np

from tidemark.llm import vectors
from tidemark.llm.vectors import near_vectors, spherical_kmeans


def plain(rows):
    ok = []
    for vec_id, label, v in rows:
        x = None if v is None or not len(v) or None in v else np.array(v, float)
        good = vec_id is not None and label is not None and x is not None and np.isfinite(x).all() and (x != 0).any()
        x = x / np.abs(x).max() if good else x
        ok.append(x / np.linalg.norm(x) if good else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and ok[i] is not None and ok[j] is not None and rows[i][1] == rows[j][1] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(links[i]), component, component == rows[i][0]))
    return out


def planted(n=400, seed=2):
    rng = np.random.default_rng(seed)
    rows, have = [], []
    for i in range(n):
        if have and rng.random() < 0.5:
            x = have[rng.integers(len(have))]
            x = x * rng.choice([1.0, 2.0]) + rng.normal(0, rng.choice([0.0, 0.1, 0.18, 0.25]), 16) * np.linalg.norm(x) / 4
        else:
            x = rng.normal(size=16)
        have.append(x)
        rows.append((1000 - i, int(rng.integers(0, 2)), [float(v) for v in x]))
    rows += [(2000 + i, 0, rows[0][2]) for i in range(50)]
    return rows


ODD = [
    (3000, None, [1.0] * 16),
    (3001, 0, None),
    (3002, 0, [0.0] * 16),
    (3003, 0, [float("nan")] + [1.0] * 15),
    (3004, 0, [float("inf")] + [1.0] * 15),
    (3005, 0, [None] + [1.0] * 15),
    (3006, 0, []),
    (3007, 0, [1.0, 2.0]),
    (3008, 0, [2.0, 4.0]),
    (3009, 1, [1e300, 1e300]),
    (3010, 1, [1e-300, 1e-300]),
    (None, 1, [1.0, 1.0]),
]


def got(spark, rows, columns="vec_id long, label int, embedding array<double>"):
    found = near_vectors(spark.createDataFrame(rows, columns).repartition(3)).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, bool(r.kept)) for r in found), key=str)


def test_links_and_components_equal_all_pairs(spark, monkeypatch):
    rows = planted() + ODD
    want = sorted(((a, b, c, d if a is not None else True) for a, b, c, d in plain(rows)), key=str)
    assert got(spark, rows) == want
    for cell, most, block in ((40, 256, 16), (20, 4, 1024)):  # many cells; several code books
        monkeypatch.setattr(vectors, "CELL_ROWS", cell)
        monkeypatch.setattr(vectors, "MOST_CENTROIDS", most)
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        assert got(spark, rows) == want


def test_empty_table_and_clashing_names(spark):
    schema = "vec_id long, label int, embedding array<float>, n_links string, rep int, unit int"
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(2, 1, [1.0, 0.0], "x", 1, 1), (1, 1, [1.0, 0.01], None, 1, 1)]
    found = near_vectors(spark.createDataFrame(rows, schema))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_kmeans_finds_separate_bunches():
    rng = np.random.default_rng(0)
    centres = np.eye(8)[:4]
    x = np.repeat(centres, 50, axis=0) + rng.normal(0, 0.05, (200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    best = (spherical_kmeans(x, 8) @ centres.T).max(axis=0)
    assert (best > 0.95).all()

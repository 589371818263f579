"""Centroids against a slow version in whole numbers, and the bounds against true distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from matchcast.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster int, v string"


def slow_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    middles = [v for _, v in first[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles))

    for _ in range(rounds):
        held = [[] for _ in middles]
        for _, v in kept:
            held[place(v)[1]].append(v)
        middles = [[sum(x) // len(h) for x in zip(*h)] if h else m for h, m in zip(held, middles)]
    placed = [(i, *place(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in placed)
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return [(i, c, d, sum(e for _, b, e in placed if b == c), total, names[c]) for i, c, d in placed]


def float32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("dims, k", [(5, 7), (64, 12), (2, 40)])
def test_clusters_are_slow_clusters(spark, dims, k):
    draw = random.Random(dims)
    centres = [[draw.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [float32(c + draw.gauss(0, 0.4)) for c in draw.choice(centres)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # a hot vector
    rows += [(400, None), (401, []), (402, [0.0] * (dims + 1)), (403, [None] * dims), (404, [math.nan] * dims), (405, [math.inf] + [0.0] * (dims - 1))]
    rows += [(None, [0.5] * dims), (0, rows[0][1]), (1, [0.0] * dims)]
    table = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA).repartition(5)
    found = centroids.cluster(table, k, 4, dims=dims)
    seen = sorted((tuple(r) for r in found.drop("compared").collect()), key=repr)
    assert seen == sorted(slow_clusters(rows, k, 4, dims), key=repr)
    assert 1 <= found.agg({"compared": "min"}).first()[0] <= found.agg({"compared": "max"}).first()[0] <= k


def test_edges(spark):
    def rows(*vectors):
        return spark.createDataFrame([(i, list(v), 0, "") for i, v in enumerate(vectors)], SCHEMA)

    assert centroids.cluster(rows(), dims=3).count() == 0
    assert centroids.cluster(rows([1.0, 2.0], []), dims=3).count() == 0
    same = centroids.cluster(rows(*[[1.0, 2.0, -0.001]] * 9), k=4, dims=3).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in same] == [(0, 0, 0)] * 9
    huge = centroids.cluster(rows([3e38, 0.0], [-3e38, 0.0], [3e38, 1.0]), k=2, dims=2).collect()
    assert len(huge) == 3 and all(r.distance >= 0 for r in huge)


@pytest.mark.parametrize("kind", ["spread", "flat", "line", "same", "wide"])
def test_bounds_hold(kind):
    draw = np.random.default_rng(3)
    points = draw.integers(-4000, 4000, (400, 64))
    if kind == "flat":
        points[:, 3:] = 7
    if kind == "line":
        points = points[:, :1] * np.ones((1, 64), np.int64)
    if kind == "same":
        points[:] = points[0]
    if kind == "wide":
        points[::7] *= 30_000
    middles = points[:40] + (kind == "spread")
    simplex = centroids.Simplex.of(middles)
    cluster, distance, compared = centroids.nearest(points, simplex.distances(points), middles, simplex)
    true = np.array([[int(((p - m) ** 2).sum()) for m in middles] for p in points])
    assert (cluster == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    assert len(simplex.pivots) == {"spread": 8, "flat": 4, "line": 2, "same": 1, "wide": len(simplex.pivots)}[kind]
    if kind in ("flat", "line"):
        assert compared.mean() < 5  # the simplex holds the whole space, so the bounds are the distances

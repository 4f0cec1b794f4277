"""Centroid clustering against plain Python."""

import hashlib
import math

import numpy as np
import pytest
from conftest import against_sql

from orgloom.llm import centroid_clusters, queries


def brute(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [tuple(sum(x) // len(x) for x in zip(*groups[i], strict=True)) if i in groups else c for i, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, d, c in found]


def run(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame([(v, i, "x", 1, 2) for i, v in rows], f"embedding {kind}, vec_id long, label string, parts int, squares int")
    out = centroid_clusters.with_inertia(*centroid_clusters.cluster(df, **more))
    return sorted(map(repr, ((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in out.collect())))


def grouped(n, seed=3):
    r = np.random.default_rng(seed)
    centers = r.normal(0, 3, (5, 64))
    return [(i, (centers[i % 5] + r.normal(0, 0.2, 64)).astype(np.float32).tolist()) for i in range(n)]


def test_equals_plain_python(spark):
    rows = grouped(120)
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (900, [0.0] * 64), (901, [-0.0] * 64), (902, [0.5] * 64)]
    assert run(spark, rows) == sorted(map(repr, brute(rows)))


def test_what_is_kept(spark):
    rows = [(0, None), (1, []), (2, [1.0] * 63), (3, [1.0] * 65), (4, [None] + [1.0] * 63), (5, [float("nan")] + [1.0] * 63), (6, [float("inf")] + [1.0] * 63), (7, [-1.0] * 64), (8, [1.0] * 64)]
    assert run(spark, rows) == sorted(map(repr, brute(rows)))
    assert run(spark, rows[:7]) == [] and run(spark, []) == []


def test_fewer_vectors_than_centroids_and_ties(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(9)]
    assert run(spark, rows) == sorted(map(repr, brute(rows)))


def test_large_components_stay_exact(spark):
    rows = [(i, [float(16_000_000 - i) if j == i else (i * j % 7) / 64 for j in range(64)]) for i in range(20)]
    assert run(spark, rows, "array<double>") == sorted(map(repr, brute(rows)))
    assert run(spark, [*rows, (99, [1e9] * 64), (98, [1e308] * 64)], "array<double>") == sorted(map(repr, brute(rows)))  # of no place: README and docstring say so


@pytest.mark.parametrize("segment", [1, 2, 8])
def test_screening_changes_nothing_but_the_work(spark, segment):
    rows = grouped(200, 5)
    assert run(spark, rows, segment=segment) == sorted(map(repr, brute(rows)))


def test_bounds_rule_out_and_lose_none():
    r = np.random.default_rng(8)
    parts = np.array([np.floor(64 * np.array(v)) for _, v in grouped(500)], np.int64)
    centroids = np.concatenate([parts[:5], parts[:5] + r.integers(-9, 9, (5, 64)), parts[:6]])
    blocks = parts.reshape(len(parts), -1, 4)
    found, best, exact = centroid_clusters.screen(parts, blocks.sum(axis=2), (blocks * blocks).sum(axis=2), centroids, 4)
    d = ((parts[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (found == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact.mean() < 8  # of sixteen


def test_query_equals_sql(spark, sf_dir):
    got, want = against_sql(spark, sf_dir, queries.op11_centroid_clusters, queries.ORACLES["op11_centroid_clusters"])
    assert got == want and len(got) > 400

"""Centroid clustering against plain rounds over all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from rolecast.llm import drake_kmeans as dk


def plain(rows, k, rounds):
    """(cluster, distance) by row, and the centroids; Python integers throughout."""
    x = [[int(v) * 64 if abs(v) >= 2**53 else math.floor(64 * v) for v in e] for _, e in rows]
    first = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), rows[i][1]))[:k]
    at = [x[i] for i in first]
    for turn in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)) for v in x]
        if turn < rounds:
            for n in range(len(at)):
                mine = [v for v, (_, m) in zip(x, best) if m == n]
                at[n] = [sum(col) // len(mine) for col in zip(*mine)] if mine else at[n]
    return best, at


def check(spark, rows, k=16, rounds=3, width=4, log=None):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in dk.drake_kmeans(df, k, rounds, width, log).collect())
    best, at = plain(rows, k, rounds)
    whole = min(sum(min(d, dk.MOST_LONG) for d, _ in best), dk.MOST_LONG)
    per = {n: min(sum(min(d, dk.MOST_LONG) for d, m in best if m == n), dk.MOST_LONG) for _, n in best}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    assert got == sorted((i, n, min(d, dk.MOST_LONG), per[n], whole, digest[n]) for (i, _), (d, n) in zip(rows, best))


def clouds(rng, n, centres=6, width=4, spread=0.3):
    c = rng.normal(size=(centres, width)) * 3
    return [(i, [float(x) for x in c[i % centres] + rng.normal(size=width) * spread]) for i in range(n)]


def test_equals_plain_rounds_and_saves_distances(spark):
    log = []
    check(spark, clouds(np.random.default_rng(1), 300, 12), 12, 6, log=log)
    assert len(log) == 7 and log[0] == (3, 300 * 12)
    assert all(seen < 300 * 12 // 2 for _, seen in log[2:]), log


@pytest.mark.parametrize("k", [1, 2, 5])
def test_few_centroids(spark, k):
    check(spark, clouds(np.random.default_rng(k), 60), k, 2)


def test_ties_and_repeated_rows(spark):
    square = [(i, [float(a), float(b), 0.0, 0.0]) for i, (a, b) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)] * 6)]
    check(spark, square, 5, 3)
    check(spark, [(7, [1.0, 2.0, 3.0, 4.0])] * 9, 4, 3)


def test_fewer_vectors_than_clusters(spark):
    check(spark, clouds(np.random.default_rng(3), 5), 16, 3)


def test_components_beyond_64_bits(spark):
    rng = np.random.default_rng(4)
    rows = clouds(rng, 20) + [(100 + i, [float(x) * 10.0 ** (5 * i) for x in rng.normal(size=4)]) for i in range(8)]
    check(spark, rows, 6, 3)


def test_rows_that_do_not_count(spark):
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None, 1.0, 1.0]), (5, [float("nan")] * 4), (6, [float("inf")] * 4), (None, [0.5] * 4), (8, [-0.5] * 4)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, near string")
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in dk.drake_kmeans(df, 2, 3, 4).collect()}
    assert got == {8: (0, 0), None: (1, 0)}
    assert dk.drake_kmeans(df.filter("vec_id < 4"), 2, 3, 4).collect() == []


def test_bounds_hold(spark):
    """After any moves the upper bound is no less than the own distance, and no other centroid is nearer than its lower bound."""
    rng = np.random.default_rng(5)
    x, at = np.floor(rng.normal(size=(200, 4)) * 64), np.floor(rng.normal(size=(10, 4)) * 64)
    state, _ = dk.scan(x, at, 4)
    for turn in range(8):
        new = at + np.floor(rng.normal(size=at.shape) * 64 / 2**turn)
        moved = np.sqrt(((new - at) ** 2).sum(axis=1))
        at = new
        state, _, _ = dk.advance(x, at, moved, state.cut(4 - turn // 3))
        d = dk.squared(x, at)
        assert (state.near[:, 0] == d.argmin(axis=1)).all()
        root, b = np.sqrt(d), state.near.shape[1] - 1
        assert (state.bound[:, 0] >= root.min(axis=1)).all()
        listed = np.take_along_axis(root, state.near, axis=1)
        assert (state.bound[:, 1 : b + 1] <= listed[:, 1:]).all()
        np.put_along_axis(root, state.near, np.inf, axis=1)
        assert (state.bound[:, b + 1] <= root.min(axis=1)).all()

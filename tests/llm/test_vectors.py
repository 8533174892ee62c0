"""Centroid clustering and hard negatives against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import hard_negatives
from scriptorium.llm.centroids import Simplex, bounds, clustered, nearest, squared, with_inertia
from scriptorium.llm.hard_negatives import LEVELS, Side, mined, passing, summaries
from scriptorium.llm.vectors import complete, whole

DIMS = 16


def test_bounds_enclose_the_distance_and_degenerate_pivots_are_left_out():
    rng = np.random.default_rng(1)
    pivots = rng.integers(-1000, 1000, (6, DIMS))
    pivots[2], pivots[4] = pivots[0], pivots[0] + 2 * (pivots[1] - pivots[0])  # a copy and a point on a line
    simplex = Simplex(pivots)
    assert simplex.used == [0, 1, 3, 5]
    x, y = rng.integers(-1000, 1000, (200, DIMS)), rng.integers(-1000, 1000, (30, DIMS))
    low, high = bounds(simplex.apexes(x), simplex.apexes(y))
    exact = squared(x, y)
    assert (low <= exact).all() and (exact <= high).all()
    near, distance = nearest(x, simplex.apexes(x), y, simplex.apexes(y))
    assert (near == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert len(Simplex(pivots[:1]).lower) == 0


def test_bounds_leave_out_far_centroids():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (8, DIMS))
    x = np.concatenate([c + rng.integers(-50, 50, (100, DIMS)) for c in centres])
    simplex = Simplex(centres[:6])
    low, high = bounds(simplex.apexes(x), simplex.apexes(centres))
    assert (low <= high.min(axis=1, keepdims=True)).mean() < 0.3


def plain_clusters(rows, k, rounds):
    centroids = [x for _, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:k]]
    assign = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [assign(x)[1] for _, x in rows]
        for i in range(len(centroids)):
            members = [x for c, (_, x) in zip(own, rows) if c == i]
            if members:
                centroids[i] = [sum(v) // len(members) for v in zip(*members)]
    return sorted(((i, *assign(x)[::-1]) for i, x in rows), key=repr), centroids


def test_clusters(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(-300, 300) for _ in range(4)]) for i in range(200)]
    rows += [(500 + i, [7, 7, 7, -7]) for i in range(150)] + [(7, rows[7][1]), (None, [1, 2, 3, 4])]
    frame = spark.createDataFrame([(i, x, "y") for i, x in rows], "id long, x array<long>, apex string")
    found, centroids = clustered(frame, F.col("id"), k=5, rounds=4)
    expected, plain = plain_clusters(rows, 5, 4)
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in found.collect()), key=repr) == expected
    assert centroids.tolist() == plain
    totals = with_inertia(found, centroids).select("cluster", "cluster_inertia", "inertia").distinct().collect()
    for r in totals:
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in expected)


def test_fewer_rows_than_centroids_equal_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(1, [5, 5]), (2, [5, 5]), (3, [5, 5])], "id long, x array<long>")
    found, centroids = clustered(frame, F.col("id"), k=8, rounds=2)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, 0), (2, 0, 0), (3, 0, 0)] and len(centroids) == 3
    none, centroids = clustered(frame.limit(0), F.col("id"))
    assert none.count() == 0 and with_inertia(none, centroids).count() == 0


def test_complete_and_whole_vectors(spark):
    rows = [(1, [0.5, -0.001]), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("-inf"), 1.0]), (5, [1.0]), (6, None), (7, [])]
    frame = spark.createDataFrame(rows, "i long, v array<float>")
    kept = frame.where(complete(F.col("v"), 2)).select("i", whole(F.col("v"), 1024).alias("x")).collect()
    assert [(r["i"], r["x"]) for r in kept] == [(1, [512, -2])]
    with pytest.raises(Exception, match="too large"):
        spark.createDataFrame([([1e9],)], "v array<double>").select(whole(F.col("v"), 1024)).collect()


def test_no_pair_that_is_wanted_misses_the_bounds():
    rng = np.random.default_rng(3)
    level = lambda n: np.repeat(rng.integers(-90, 90, (n, 16)), 4, axis=1) + rng.integers(-9, 9, (n, 64))
    x, y = level(40), level(300)  # what segments of four have in common lies in their means
    a, b = Side(x, summaries(x)), Side(y, summaries(y))
    least, most = rng.integers(-9000, 20000, 40).astype(float), rng.integers(20000, 60000, 40).astype(float)
    allowed = rng.random((40, 200)) < 0.7
    i, j, score = passing(a, b, slice(100, 300), allowed, least, most)
    exact = x @ y.T
    wanted = allowed & (exact[:, 100:] >= least[:, None]) & (exact[:, 100:] <= most[:, None])
    got = np.zeros_like(wanted)
    got[i, j - 100] = True
    assert (score == exact[i, j]).all() and not (wanted & ~got).any()
    assert LEVELS == (4, 8, 16) and got.sum() < 1.2 * wanted.sum() + 20


def plain_negatives(rows, every, positives=5, negatives=10):
    rows = sorted({(i, label, tuple(x)) for i, label, x in rows if i is not None and label is not None and x is not None})
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a in rows:
        if a[0] % every:
            continue
        scored = sorted((-dot(a[2], b[2]), b[0], b[1]) for b in rows if b != a)
        for s, i, _ in [t for t in scored if t[2] == a[1]][:positives]:
            fit = [t for t in scored if t[2] != a[1] and 30 * -s <= 100 * -t[0] <= 90 * -s][:negatives]
            out += [(a[0], i, rank, t[1], -s, -t[0]) for rank, t in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize(("group", "slot", "chunk"), [(2000, 50_000, 2000), (3, 40, 7)])
def test_negatives(spark, monkeypatch, group, slot, chunk):
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 1, 2, 3]), [rng.randrange(-3, 5) for _ in range(DIMS)]) for i in range(300)]
    rows += [rows[10], rows[20], (None, 1, rows[3][2]), (400, None, rows[3][2]), (410, 1, None), (420, 9, rows[3][2]), (430, 2, [0] * DIMS)]
    rows += [(500 + i, 2, rows[0][2]) for i in range(40)]
    frame = spark.createDataFrame([(i, label, x, "z") for i, label, x in rows], "vec_id long, label int, x array<long>, summary string")
    found = mined(frame, F.col("vec_id") % 10 == 0, DIMS, group=group, slot=slot)
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, 10)
    assert mined(frame.limit(0), F.col("vec_id") % 10 == 0, DIMS).count() == 0

"""The exact cosine join against comparing all pairs, and the share of pairs that it compares."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import dedup


def clustered(rng, clusters, each, width=32, spread=0.012):
    centres = rng.normal(size=(clusters, width))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return np.repeat(centres, each, axis=0) + rng.normal(size=(clusters * each, width)) * spread


def frame(spark, x, **more):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>").repartition(4)


def brute(x, threshold):
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), dedup.FLOOR)
    a, b = np.nonzero(np.triu(u @ u.T >= threshold, 1))
    return set(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("threshold", [0.99, 0.98, 0.4])
@pytest.mark.parametrize("block_rows", [4096, 64])
def test_pairs_equal_brute_force(spark, threshold, block_rows):
    x = clustered(np.random.default_rng(1), 60, 25)
    x[7] = 0
    x[8] = x[9] * 1e-9  # shorter than the floor
    got = [(r.a, r.b) for r in dedup.cosine_pairs(frame(spark, x), threshold, block_rows=block_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(x, threshold)


def test_share_of_compared_pairs(spark):
    rng = np.random.default_rng(2)
    x = clustered(rng, 100, 20)
    for threshold, most in ((0.99, 0.05), (0.98, 0.05), (0.4, 1.01)):
        share = dedup.compared_share(frame(spark, x), threshold)
        print(f"threshold {threshold}: {share:.4f} of all pairs compared")
        assert 0 < share <= most
    # what spreads evenly has no cells, and all pairs are compared once
    assert dedup.compared_share(frame(spark, rng.normal(size=(800, 32))), 0.4) == pytest.approx(1)


def test_bound_holds_for_any_pivots():
    """No pair within the angle is missed, whatever the pivots."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = dedup._directions(clustered(rng, 5, 8, width=3, spread=0.3))
        threshold = rng.uniform(0.3, 0.999)
        angle = math.acos(threshold)
        home, visits = dedup._visits(x, dedup._directions(rng.normal(size=(6, 3))), angle)
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            assert visits[b, home[a]] and visits[a, home[b]]


def test_groups_widths_and_odd_rows(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (3, "b", [1.0, 0.0]), (4, "a", [1.0, 0.0, 0.0]), (5, None, [1.0, 0.0]), (6, "a", None), (7, "a", []), (8, "b", [2.0, 0.0])]
    d = spark.createDataFrame(rows, "id long, g string, embedding array<double>")
    pairs = lambda by: sorted((r.a, r.b) for r in dedup.cosine_pairs(d, 0.99, by=by).collect())
    assert pairs("g") == [(1, 2), (3, 8)] and pairs(None) == [(a, b) for a in (1, 2, 3, 5, 8) for b in (1, 2, 3, 5, 8) if a < b]
    assert dedup.cosine_pairs(d.limit(0), 0.9).count() == 0 and dedup.compared_share(d.limit(0), 0.9) == 0


@pytest.mark.parametrize("threshold", [0.9, 1.0])
def test_copies_make_no_pairs(spark, threshold):
    """A group of copies is marked without a pair of its own; the result is that of a pass in order."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 6))
    x = np.concatenate([base, base[rng.integers(0, 60, 200)], np.repeat(base[:1], 300, axis=0), base + rng.normal(size=base.shape) * 0.2, np.zeros((2, 6))])[rng.permutation(622)]
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), dedup.FLOOR)
    kept: list[int] = []
    for i in range(len(u)):
        if not kept or (u[kept] @ u[i]).max() < threshold:
            kept.append(i)
    got = dedup.mark_near_duplicates(frame(spark, x).withColumn("n", F.lit(1)), threshold).collect()
    assert len(got) == len(x) and (threshold == 1.0 or sorted(r.id for r in got if not r.near_duplicate) == kept)
    if threshold < 1:
        copies = dedup._copies(frame(spark, x), threshold, "id", "embedding").count()
        assert copies >= 500

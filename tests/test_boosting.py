"""Boosted trees: the best split against trying all, a whole model against growing it row by row, and what probabilities must be."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import boosting

S = boosting.Settings(rounds=4, depth=2)


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(i, str(c), v.tolist()) for i, (v, c) in enumerate(zip(x, y))], "id long, label string, embedding array<double>").repartition(parts)


def blobs(rng, each=30, classes=3, width=6, spread=1.0):
    y = np.repeat(np.arange(classes), each)
    return rng.normal(size=(classes, width))[y] * 3 + rng.normal(size=(len(y), width)) * spread, y


def plain_split(bins, g, h, features, s):
    best = (1e-9, -1, -1)
    for j in np.flatnonzero(features):
        for b in range(boosting.BINS - 1):
            left = bins[:, j] <= b
            if h[left].sum() >= s.least_weight and h[~left].sum() >= s.least_weight:
                part = lambda m: g[m].sum() ** 2 / (h[m].sum() + s.shrink)
                gain = part(left) + part(~left) - part(np.ones(len(g), bool))
                if gain > best[0] + 1e-12:
                    best = (gain, j, b)
    return best[1:]


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(1)
    for n in (3, 20, 200):
        bins = rng.integers(0, boosting.BINS, (n, 4))
        g, h = rng.normal(size=n), rng.random(n)
        sums = np.zeros((4, boosting.BINS, 2))
        for j in range(4):
            np.add.at(sums[j, :, 0], bins[:, j], g)
            np.add.at(sums[j, :, 1], bins[:, j], h)
        features = np.array([True, True, False, True])
        feature, at, left, right = boosting.best_split(sums, features, S)
        assert (feature, at) == plain_split(bins, g, h, features, S)
        mask = bins[:, feature] <= at if feature >= 0 else np.ones(n, bool)
        assert left == pytest.approx(-g[mask].sum() / (h[mask].sum() + 1) * S.rate)
        assert feature < 0 or right == pytest.approx(-g[~mask].sum() / (h[~mask].sum() + 1) * S.rate)


def test_model_equals_growing_it_plainly(spark):
    """Without sampling, every tree is the greedy one over the fold's training rows."""
    rng = np.random.default_rng(2)
    x, y = blobs(rng, each=12, spread=2.0)
    s = boosting.Settings(rounds=7, depth=2, rows=1.0, features=1.0)
    got = {r.id: r for r in boosting.out_of_sample(frame(spark, x, y), folds=3, settings=s).collect()}
    fold = np.array([got[i].fold for i in range(len(x))])
    edges = np.quantile(x, np.arange(1, boosting.BINS - 1) / (boosting.BINS - 1), axis=0).T
    bins = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(x.shape[1])], axis=1)
    every = np.ones(x.shape[1], bool)
    for f in range(3):
        margins, train = np.zeros((len(x), 3)), fold != f
        for _ in range(s.rounds):
            e = np.exp(margins - margins.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            for k in range(3):
                g = np.rint((p[:, k] - (y == k)) * boosting.ONE) / boosting.ONE
                h = np.rint(2 * p[:, k] * (1 - p[:, k]) * boosting.ONE) / boosting.ONE
                nodes = [np.ones(len(x), bool)]
                for _ in range(s.depth):
                    after = []
                    for m in nodes:
                        t = m & train
                        j, b = plain_split(bins[t], g[t], h[t], every, s)
                        left = m & (bins[:, j] <= b) if j >= 0 else m
                        after += [left, m & ~left]
                    nodes = after
                for m in nodes:
                    t = m & train
                    margins[m, k] += -g[t].sum() / (h[t].sum() + s.shrink) * s.rate
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        own = np.flatnonzero(fold == f)
        assert np.allclose(p[own], [got[i].pred_probs for i in own.tolist()], atol=1e-6)


def test_probabilities(spark):
    rng = np.random.default_rng(3)
    x, y = blobs(rng, each=25)
    x[4, 2] = np.nan
    x[:, 5] = 7.0  # tells nothing
    runs = [{r.id: (r.fold, r.pred_probs) for r in boosting.out_of_sample(frame(spark, x, y, parts), folds=4, settings=S).collect()} for parts in (1, 5)]
    assert runs[0] == runs[1]  # however rows are dealt
    p = np.array([runs[0][i][1] for i in range(len(x))])
    assert p.shape == (75, 3) and np.allclose(p.sum(axis=1), 1, atol=1e-12) and (p > 0).all() and (p.argmax(axis=1) == y).mean() > 0.9
    assert sorted({f for f, _ in runs[0].values()}) == [0, 1, 2, 3]


def test_a_large_class_is_many_tasks(spark, monkeypatch):
    """Nine rows of ten are of one class: passes over them aren't one task's work."""
    rng = np.random.default_rng(5)
    x, y = blobs(rng, each=200, classes=2)
    y = (np.arange(len(y)) % 10 == 0).astype(int)
    tables = []
    whole = boosting.materialise
    monkeypatch.setattr(boosting, "materialise", lambda df, tag: tables.append(whole(df, tag)) or tables[-1])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert boosting.out_of_sample(frame(spark, x, y), folds=2, settings=boosting.Settings(rounds=1, depth=1)).count() == 400
        sizes = [r["count"] for r in tables[0].groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 400 and max(sizes) < 200


def test_absent_class_and_odd_rows(spark):
    assert boosting._softmax(np.zeros((2, 1, 3)), np.array([[True, False, True]])).tolist() == [[[0.5, 0.0, 0.5]]] * 2
    rng = np.random.default_rng(4)
    x, y = blobs(rng, each=6, classes=2)
    d = frame(spark, x, y)
    odd = spark.createDataFrame([(100, None, [0.0] * 6), (101, "0", None), (None, "1", [0.0] * 6)], d.schema)
    assert boosting.out_of_sample(d.unionByName(odd), folds=2, settings=S).count() == 12
    with pytest.raises(ValueError, match="one width"):
        boosting.out_of_sample(d.unionByName(spark.createDataFrame([(200, "0", [1.0])], d.schema)), folds=2, settings=S)
    with pytest.raises(ValueError, match="one width"):
        boosting.out_of_sample(d.limit(0), folds=2, settings=S)

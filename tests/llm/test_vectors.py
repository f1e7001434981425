"""Vector operators against brute force, and on odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import ann, crosspolytope, nndescent


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(20, 48))
    y = crosspolytope.rotated(x, 3)
    assert y.shape == (20, 64) and np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert (crosspolytope.probes(x, 1, 5)[:, 0] == crosspolytope.codes(x, 1)).all()
    assert (crosspolytope.probes(x, 1, 5, 2)[:, 0] == crosspolytope.codes(x, 1, 2)).all()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16))
    x[300:360] = x[5] + rng.normal(size=(60, 16)) * 0.01
    x[360:380] = x[7]
    out = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    return out + [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [1.0, None] + [0.0] * 14, 1), (404, [float("inf")] * 16, 1), (405, [], 1), (406, x[5].tolist(), None), (407, [1.0, 2.0], 1), (408, (x[7] * 3).tolist(), 1)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit("x")).withColumn("n_links", F.lit(9)).repartition(3)


def usable(rows):
    return {i: np.array(v) for i, v, _ in rows if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)}


def test_search(spark, rows, table):
    x = usable(rows)
    got: dict[int, list] = {}
    for r in ann.search(table, F.col("vec_id") % 10 == 0, k=5, block=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for q in (i for i in x if i % 10 == 0):
        cos = sorted(((-ann.cosines(x[q], v[None])[0], i) for i, v in x.items() if i != q))[:5]
        own = got.get(q, [])
        hits += len({i for i, _ in own} & {i for _, i in cos})
        total += 5
        assert q not in {i for i, _ in own} and own == sorted(own, key=lambda z: (-z[1], z[0]))
        assert all(abs(s - ann.cosines(x[q], x[i][None])[0]) < 1e-12 for i, s in own)
    assert hits / total >= 0.9 and 400 not in got and 405 not in got
    assert [i for i, _ in got[360]] == [7, 361, 362, 363, 364] or [i for i, _ in got[360]][:4] == [7, 361, 362, 363]
    assert ann.search(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def clusters(rng, width, groups, each, spread):
    c = rng.normal(size=(groups, width))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    return np.repeat(c, each, axis=0) + rng.normal(size=(groups * each, width)) * spread / np.sqrt(width)


@pytest.mark.parametrize(("width", "spread"), [(16, None), (64, None), (256, None), (768, 0.3)])
def test_recall_by_width(spark, width, spread):
    """Against brute force: at least 0.9 at every width, for vectors that spread evenly as for those in clusters, and of these few are compared."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(1200, width)) if spread is None else clusters(rng, width, 120, 10, spread)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    asked = F.col("vec_id") % 20 == 0
    plan = ann.calibrate(d, asked)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got: dict[int, set] = {}
    for r in ann.search(d, asked, plan=plan).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 1200, 20):
        cos = unit @ unit[q]
        cos[q] = -2
        hits += len(got[q] & set(np.argsort(-cos)[:5].tolist()))
    print(f"width {width}, {'even' if spread is None else 'clustered'}: {plan}, recall {hits / 300:.3f}")
    assert hits / 300 >= 0.9 and (spread is None or plan.share <= 0.1)


def test_depth_two_reaches_what_it_counts():
    """Probes of two rotations together are the codes of least loss, and what calibration counts is where a neighbour's code stands among them."""
    rng = np.random.default_rng(9)
    q, v = rng.normal(size=(6, 16)), rng.normal(size=(6, 16))
    need = ann.needed_probes(q, np.arange(6), v, 3, 2)
    for i in range(6):
        places = []
        for t in range(3):
            y = [crosspolytope.rotated(q[i : i + 1], t * 8 + k)[0] for k in range(2)]
            both = [np.concatenate([a, -a]) for a in y]
            loss = (both[0].max() - both[0])[:, None] + (both[1].max() - both[1])[None, :]
            order = np.argsort(loss.ravel(), kind="stable")
            places.append(int(np.flatnonzero(order == crosspolytope.codes(v[i : i + 1], t, 2)[0])[0]) + 1)
        assert need[i] == min(places)


def test_search_of_few_rows(spark):
    """Every query gets all rows there are, where those are few."""
    x = np.random.default_rng(8).normal(size=(7, 64))
    for n in (1, 2, 4, 7):
        got = ann.search(spark.createDataFrame([(i, x[i].tolist()) for i in range(n)], "vec_id long, embedding array<double>"), F.lit(True), block=3).collect()
        for q in range(n):
            best = sorted((-ann.cosines(x[q], x[i][None])[0], i) for i in range(n) if i != q)[:5]
            assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for _, i in best]


def test_near_duplicates(spark, rows, table):
    x, label = usable(rows), {i: g for i, _, g in rows}
    links = {i: {j for j in x if j != i and label[i] is not None and label[i] == label[j] and ann.cosines(x[i], x[j][None])[0] >= 0.98} if i in x else set() for i, _, _ in rows}
    component = {}
    for i in sorted(links):
        if i not in component:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in component:
                    component[j] = i
                    todo += links[j]
    for most in (16 << 20, 40 * 128):  # one cell a label; several cells in all tables, some of them cut into blocks
        got = {r.vec_id: r for r in nndescent.near_duplicates(table, cell_bytes=most).collect()}
        assert len(got) == len(rows)
        assert {i: r.n_links for i, r in got.items()} == {i: len(v) for i, v in links.items()}
        assert {i: r.component_id for i, r in got.items()} == component and all(r.kept == (i == r.component_id) for i, r in got.items())
    got = nndescent.near_duplicates(table)
    true = sum(len(v) for i, v in links.items() if i % 5 == 0)
    assert nndescent.recall(table, got, 5) == (true, true)
    assert nndescent.near_duplicates(table.limit(0)).count() == 0


def test_null_vector_ids(spark):
    kind = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2**60 + 1, [0.0, 1.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nndescent.near_duplicates(spark.createDataFrame(rows, kind)).collect()}
    assert got == {0: (1, 0, True), None: (0, None, True), 2: (1, 0, False), 2**60 + 1: (0, 2**60 + 1, True)}
    found = ann.search(spark.createDataFrame(rows, kind), F.col("vec_id") % 2 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(0, 1, 2), (0, 2, 2**60 + 1), (2, 1, 0), (2, 2, 2**60 + 1)]


def brute(x, threshold=0.98):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= threshold
    np.fill_diagonal(hit, False)
    return hit


def groups(rng, n, sizes, width=24, noise=0.01):
    x = [rng.normal(size=(n, width))]
    for size in sizes:
        x.append(rng.normal(size=(1, width)) + rng.normal(size=(size, width)) * noise)
    return np.concatenate(x)[rng.permutation(n + sum(sizes))]


@pytest.mark.parametrize("orders", [0, nndescent.ORDERS])
def test_descent_finds_links(orders):
    """From lists of random rows too, every link is found, with lists that double and rows that are compared with all."""
    rng = np.random.default_rng(1)
    x = groups(rng, 900, [2] * 20 + [5] * 10 + [30, 50, 150])
    hit = brute(x)
    weight = rng.integers(1, 4, size=len(x))
    degree, root = nndescent.links_of_cell(x, 0.98, weight, orders=orders)
    assert (degree == hit @ weight).all()
    assert all(root[i] == min([i, *np.flatnonzero(hit[i])]) for i in range(len(x)))


def test_descent_is_what_finds_them(monkeypatch):
    """Without rounds the first lists miss links, and an audit that sees nothing lets them pass: the joins find what the lists lack."""
    rng = np.random.default_rng(2)
    x = groups(rng, 1500, [3] * 60)
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    want = int(brute(x).sum())
    start = nndescent.first_lists(unit, 16, np.random.default_rng(0), 1)
    found = [int((nndescent.refine(unit, start, 16, 0.98, np.random.default_rng(0), rounds=n)[1] >= 0.98).sum()) for n in (0, 40)]
    assert found[0] < 0.9 * want and found[1] >= 0.99 * want
    assert nndescent.links_of_cell(x, 0.98)[0].sum() == want
    compared = []
    monkeypatch.setattr(nndescent.Links, "linked", lambda self, rows: compared.append(len(rows)) or np.zeros((len(rows), len(self.unit)), dtype=bool))
    assert nndescent.links_of_cell(x, 0.98)[0].sum() >= 0.99 * want and sum(compared) <= 2 * nndescent.AUDIT


def test_links_of_blocks_and_tables():
    rng = np.random.default_rng(3)
    x = groups(rng, 200, [4] * 10 + [120])
    hit, side, codes = brute(x), rng.integers(0, 2, size=len(x)), rng.integers(0, 3, size=(len(x), 2))
    other = side[:, None] != side[None]
    unseen = ~(codes[:, None] == codes[None]).any(axis=2)
    degree, root = nndescent.links_of_cell(x, 0.98, side=side, codes=codes)
    assert (degree == (hit & other & unseen).sum(axis=1)).all() and len(np.unique(root)) == len(np.unique(nndescent.links_of_cell(x, 0.98)[1]))

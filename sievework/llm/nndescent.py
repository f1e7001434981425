"""Embedding near-duplicates by NN-descent.

1. Vectors with equal components become one class with a count. The classes of a label form one cell, and one neighbour graph, as long
   as their vectors take a bounded number of bytes. The classes of a larger label are dealt to coarse cells of several cross-polytope
   tables, and a cell that stays too large, as around one common vector, is cut into blocks, each pair of which is a task.
2. In a cell, each row's list starts with its neighbours in the order of a few cross-polytope codes. Rounds join neighbours of
   neighbours, forward and reverse, and keep the best of each list, until a round finds no link and hardly any better neighbour.
3. Lists full of links are saturated: they are doubled and refined again. Rows whose lists of ``LONGEST_LIST`` are still full
   are compared with the whole cell, which counts their links without listing them.
4. A sample of rows, half of them with links, is compared with the whole cell. If a link is missing, all lists are doubled.
5. A cell returns each row's number of links and the smallest row that its links reach in the cell, never pairs, so that a group of
   copies gives as many rows as it has members. Of the tables, only the first in which two rows share a cell counts their link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crosspolytope
from .ann import by_width, unpack
from .common import materialise, vectors_of
from .components import connected_components

#: Tables of a label of several cells, and bytes of a cell's vectors.
TABLES, CELL_BYTES = 10, 16 << 20
#: A list's entries at first and at most; of each list, so many take part in a round; codes that order the first neighbours.
LIST, LONGEST_LIST, SAMPLED, ORDERS = 16, 64, 8, 8
#: Rows of a cell whose lists are audited in a pass.
AUDIT = 64
ROUNDS = 40
MARGIN = 1e-4  # what single precision may miss; links are decided in double precision
AT_ONCE = 8 << 20  # numbers that candidates' vectors or a block of cosines may take


def first_lists(unit: np.ndarray, k: int, rng: np.random.Generator, orders: int = ORDERS) -> np.ndarray:
    """Each row's first neighbours: those beside it in the order of some cross-polytope codes, and random ones."""
    n = len(unit)
    near = rng.integers(0, n - 1, size=(n, k))
    near += near >= np.arange(n)[:, None]
    place = np.empty(n, dtype=np.int64)
    for t in range(min(orders, k // 2)):
        order = np.lexsort((rng.permutation(n), crosspolytope.codes(unit, 100 + t, 2)))
        place[order] = np.arange(n)
        near[:, 2 * t] = order[place - 1]
        near[:, 2 * t + 1] = order[(place + 1) % n]
    return near


def _reverse(near: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    """Some of the rows that list each row, ``width`` at most, drawn anew each time; the row itself where there are fewer."""
    n, k = near.shape
    source, target = np.repeat(np.arange(n), k), near.ravel()
    order = rng.permutation(len(source))
    order = order[np.argsort(target[order], kind="stable")]
    source, target = source[order], target[order]
    place = np.arange(len(order)) - np.searchsorted(target, target)
    kept = place < width
    out = np.repeat(np.arange(n)[:, None], width, axis=1)
    out[target[kept], place[kept]] = source[kept]
    return out


def _best(unit: np.ndarray, rows: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the k best distinct candidates of each row, their cosines); a place without one has the row itself and -9."""
    candidates = np.sort(candidates, axis=1)
    out = np.zeros(candidates.shape, dtype=bool)
    out[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    out |= candidates == rows[:, None]
    value = np.matmul(unit[candidates], unit[rows][:, :, None])[:, :, 0]
    value[out] = -9
    if value.shape[1] > k:
        top = np.argpartition(-value, k - 1, axis=1)[:, :k]
        value, candidates = np.take_along_axis(value, top, axis=1), np.take_along_axis(candidates, top, axis=1)
    return np.where(value > -9, candidates, rows[:, None]), value


def refine(unit: np.ndarray, near: np.ndarray, k: int, links_from: float, rng: np.random.Generator, only: np.ndarray | None = None, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(lists, cosines) after rounds of joins of neighbours of neighbours, for all rows or the rows ``only``; lists get k entries."""
    rows = np.arange(len(unit)) if only is None else only
    if near.shape[1] < k:
        near = np.concatenate([near, np.repeat(np.arange(len(unit))[:, None], k - near.shape[1], axis=1)], axis=1)
    near = near.copy()
    sims = np.full(near.shape, -9, dtype=unit.dtype)
    step = max(1, AT_ONCE // (unit.shape[1] * near.shape[1]))
    for a in range(0, len(unit), step):
        own = np.arange(a, min(a + step, len(unit)))
        near[own], sims[own] = _best(unit, own, near[own], k)
    fresh = np.ones(near.shape, dtype=bool)
    quiet = 0
    for _ in range(rounds):
        rows = rows[sims[rows].min(axis=1) < links_from]  # a list full of links waits to be doubled
        if not len(rows):
            break
        width = max(SAMPLED, k // 2)
        drawn = np.argsort(rng.random(near.shape) - fresh, axis=1)[:, :width]  # new entries first
        forward = np.take_along_axis(near, drawn, axis=1)
        np.put_along_axis(fresh, drawn, False, axis=1)
        hop = np.concatenate([forward, _reverse(forward, width, rng)], axis=1)
        changed = linked = 0
        step = max(1, AT_ONCE // (unit.shape[1] * (hop.shape[1] ** 2 + k)))
        new_near, new_sims = near.copy(), sims.copy()
        for a in range(0, len(rows), step):
            own = rows[a : a + step]
            found, value = _best(unit, own, np.concatenate([hop[hop[own]].reshape(len(own), -1), near[own]], axis=1), k)
            added = (value > -9) & ~(found[:, :, None] == near[own][:, None, :]).any(axis=2)
            new_near[own], new_sims[own], fresh[own] = found, value, fresh[own] * False | added
            changed += int(added.sum())
            linked += int((added & (value >= links_from)).sum())
        near, sims = new_near, new_sims
        quiet = quiet + 1 if not linked else 0
        if not changed or quiet >= 2 or quiet and changed < 0.01 * len(rows) * k:
            break
    return near, sims


class Links:
    """Links of a cell's rows, found in double precision: counts and a root for each row, without pairs."""

    def __init__(self, x: np.ndarray, threshold: float, weight: np.ndarray, side: np.ndarray | None, codes: np.ndarray):
        n = len(x)
        self.scaled = x / np.abs(x).max(axis=1, keepdims=True)
        self.unit = self.scaled / np.sqrt((self.scaled * self.scaled).sum(axis=1, keepdims=True))
        self.threshold, self.weight, self.side, self.codes = threshold, weight, side, codes
        self.degree, self.root = np.zeros(n, dtype=np.int64), np.arange(n)

    def exactly(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        p, q = self.scaled[left], self.scaled[right]
        return (p * q).sum(axis=1) / np.sqrt((p * p).sum(axis=1)) / np.sqrt((q * q).sum(axis=1)) >= self.threshold

    def linked(self, rows: np.ndarray) -> np.ndarray:
        """Which rows of the cell each of ``rows`` links with."""
        sims = self.unit[rows] @ self.unit.T
        sims[np.arange(len(rows)), rows] = -9
        hit = sims >= self.threshold
        i, j = np.nonzero(np.abs(sims - self.threshold) <= 1e-9)
        hit[i, j] = self.exactly(rows[i], j)
        return hit

    def counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether a link counts here: not where an earlier table has it, and only across the two sides, if there are any."""
        ok = ~(self.codes[left] == self.codes[right]).any(axis=-1)
        return ok if self.side is None else ok & (self.side[left] != self.side[right])

    def _merge(self, i: int, js: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[js], self.root[i]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def add_pairs(self, left: np.ndarray, right: np.ndarray) -> None:
        """Distinct pairs that link."""
        own = self.counts(left, right)
        np.add.at(self.degree, left[own], self.weight[right[own]])
        np.add.at(self.degree, right[own], self.weight[left[own]])
        while True:
            low = np.minimum(self.root[left], self.root[right])
            before = self.root.copy()
            for side in (left, right):
                np.minimum.at(self.root, self.root[side], low)
                np.minimum.at(self.root, side, low)
            self.root = self.root[self.root]
            if (self.root == before).all():
                return

    def add_rows(self, rows: np.ndarray) -> None:
        """All links of these rows."""
        inside = np.zeros(len(self.unit), dtype=bool)
        inside[rows] = True
        step = max(1, AT_ONCE // len(self.unit))
        every = np.arange(len(self.unit))
        for a in range(0, len(rows), step):
            own = rows[a : a + step]
            hit = self.linked(own)
            counted = hit.copy()
            for t in range(self.codes.shape[1]):
                counted &= self.codes[own, t][:, None] != self.codes[every, t][None]
            if self.side is not None:
                counted &= self.side[own][:, None] != self.side[None]
            counted = counted.astype(np.float64)  # sums stay below 2^53
            self.degree[own] += (counted @ self.weight).astype(np.int64)
            self.degree += np.where(inside, 0, self.weight[own] @ counted).astype(np.int64)
            for i, row in zip(own.tolist(), hit):
                self._merge(i, np.flatnonzero(row))


def links_of_cell(x: np.ndarray, threshold: float, weight: np.ndarray | None = None, side: np.ndarray | None = None, codes: np.ndarray | None = None, k: int = LIST, orders: int = ORDERS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the rows that each row links with, smallest row that its links reach) for the rows of one cell.

    ``side``: only links between rows of different sides are counted. ``codes``: a link between rows that share a value in a column isn't
    counted (but followed)."""
    n = len(x)
    weight = np.ones(n, dtype=np.int64) if weight is None else weight
    links = Links(x, threshold, weight, side, np.zeros((n, 0), dtype=np.int64) if codes is None else codes)
    if n < 2:
        return links.degree, links.root
    rng = np.random.default_rng([seed, n])
    unit = links.unit.astype(np.float32)
    edge = threshold - MARGIN
    k = min(k, n - 1)
    near, sims = refine(unit, first_lists(unit, k, rng, orders), k, edge, rng)
    while True:
        while True:
            full = np.flatnonzero(sims.min(axis=1) >= edge)
            if not len(full) or k >= min(LONGEST_LIST, n - 1):
                break
            k = min(2 * k, n - 1)
            near, sims = refine(unit, near, k, edge, rng, full)
        dense = sims.min(axis=1) >= edge if k < n - 1 else np.zeros(n, dtype=bool)
        i, j = np.nonzero((sims >= edge) & ~dense[:, None])
        j = near[i, j]
        i, j = i[~dense[j]], j[~dense[j]]
        keys = np.unique(np.minimum(i, j) * n + np.maximum(i, j))
        left, right = keys // n, keys % n
        ok = np.zeros(len(keys), dtype=bool)
        for a in range(0, len(keys), AT_ONCE // x.shape[1] + 1):
            b = a + AT_ONCE // x.shape[1] + 1
            ok[a:b] = links.exactly(left[a:b], right[a:b])
        left, right = left[ok], right[ok]
        if k >= n - 1:
            break
        listed = np.bincount(left, minlength=n) + np.bincount(right, minlength=n)
        open_ = np.flatnonzero(~dense)
        some = np.flatnonzero(listed > 0)
        sample = np.unique(np.concatenate([rng.permutation(open_)[:AUDIT], rng.permutation(some)[:AUDIT]]))
        missing = False
        for a in range(0, len(sample), max(1, AT_ONCE // n)):
            own = sample[a : a + max(1, AT_ONCE // n)]
            missing |= bool((listed[own] < (links.linked(own) & ~dense[None]).sum(axis=1)).any())
        if not missing:
            break
        k = min(2 * k, n - 1)
        near, sims = refine(unit, near, k, edge, rng)
    links.add_pairs(left, right)
    if dense.any():
        links.add_rows(np.flatnonzero(dense))
    return links.degree, links.root


def _cells(count: int, most: int) -> int:
    """Number of coarse codes for so many rows: a power of two with about half as many rows to a cell as it may have."""
    return 1 if count <= most else 1 << int(np.ceil(np.log2(2 * count / most)))


def near_duplicates(df: DataFrame, threshold: float = 0.98, tables: int = TABLES, cell_bytes: int = CELL_BYTES, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: two rows link when their labels are equal and not null and their cosine is at least
    the threshold; component_id is the smallest id that links reach, the own one included; kept = (id = component_id).

    Vectors that are null, zero, empty or hold null or non-finite components, and rows without a label or an id, link with nothing (a null
    id has a null component_id and is kept); vectors of different widths neither. Ids are integers; repeated rows of one id count as
    rows of their own."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = vectors_of(batch.column(2))
            blobs: list[bytes | None] = [None] * batch.num_rows
            for i, v in zip(rows.tolist(), vectors):
                blobs[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(blobs, pa.binary())], names=["id", "label", "vec"])

    rows = df.select(id_col, F.col(label_col).cast("string").alias("label"), vec_col).mapInArrow(read, "id long, label string, vec binary")
    rows = rows.withColumn("whole", F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull())
    keyed = rows.withColumn("h1", F.when(F.col("whole"), F.xxhash64("label", "vec"))).withColumn("h2", F.when(F.col("whole"), F.xxhash64("vec", "label", F.lit(3))))
    members = materialise(keyed.select("id", "h1", "h2"), "members")
    first = [F.first(c).alias(c) for c in ("label", "vec")]
    classes = materialise(keyed.where("whole").groupBy("h1", "h2").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"), *first), "vector-classes")
    classes = classes.withColumn("width", F.octet_length("vec"))
    sizes = classes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("_rows"))
    where = ["label", "width", "tab", "code"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each table; ``before``: the row's codes in the tables before, empty where the label is one cell."""
        for batch in batches:
            if not batch.num_rows:
                continue
            width, count = batch.column("width").to_numpy(), batch.column("_rows").to_numpy()
            cells = np.array([_cells(int(c), max(2, cell_bytes // int(w))) for c, w in zip(count, width)])
            blobs = batch.column("vec").to_pylist()
            for w, c in {(int(w), int(c)) for w, c in zip(width, cells)}:
                at = np.flatnonzero((width == w) & (cells == c))
                kept = [batch.column(name).take(pa.array(at)) for name in ("label", "width", "node", "n", "vec")]
                unit = next(by_width([np.frombuffer(blobs[i], dtype=np.float64) for i in at]))[1]
                codes = np.stack([crosspolytope.coarse_codes(unit, t, c) for t in range(tables if c > 1 else 1)], axis=1)
                for t in range(codes.shape[1]):
                    before = pa.array([row.tobytes() for row in codes[:, :t]], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t), pa.int32()), pa.array(codes[:, t], pa.int64()), before, *kept], names=["tab", "code", "before", "label", "width", "node", "n", "vec"])

    dealt = classes.join(sizes, ["label", "width"]).select("label", "width", "node", "n", "vec", "_rows")
    dealt = dealt.mapInArrow(deal, "tab int, code long, before binary, label string, width int, node long, n long, vec binary")
    most = F.greatest(F.floor(F.lit(cell_bytes) / F.col("width")), F.lit(2))
    split = dealt.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    placed = dealt.join(split, where).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def search(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        order = np.argsort(nodes, kind="stable")  # the smallest row that is reached has the smallest node
        nodes, weight, own = nodes[order], table.column("n").to_numpy()[order], table.column("own").to_numpy()[order]
        taken = table.take(pa.array(order))
        codes = np.frombuffer(b"".join(taken.column("before").to_pylist()), dtype=np.int64).reshape(len(nodes), -1)
        across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        degree, root = links_of_cell(unpack(taken.column("vec").to_pylist()), threshold, weight, own if across else None, codes)
        kept = np.flatnonzero((degree > 0) | (root != np.arange(len(root))))
        return pa.table({"node": pa.array(nodes[kept], pa.int64()), "linked": pa.array(degree[kept], pa.int64()), "root": pa.array(nodes[root[kept]], pa.int64())})

    cells = placed.select(*where, "i", "j", "own", "before", "node", "n", "vec").groupBy(*where, "i", "j").applyInArrow(search, "node long, linked long, root long")
    found = materialise(cells, "vector-links")
    degree = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = connected_components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    by_class = classes.select("node", "n", "h1", "h2").join(degree, "node", "left").join(joined, "node", "left")
    by_class = by_class.select("h1", "h2", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = members.join(by_class, ["h1", "h2"], "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def recall(df: DataFrame, found: DataFrame, one_in: int, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[int, int]:
    """(links found, links there are) of the usable rows whose id is divisible by ``one_in``, each compared with all rows: an audit of what
    ``near_duplicates`` returned. The sampled vectors are sent to all executors, so their number has to be a small one."""
    usable = F.col(vec_col).isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    sample = df.where(usable & (F.col(id_col) % one_in == 0)).select(id_col, F.col(label_col).cast("string").alias("label"), vec_col)
    local = sample.toArrow()
    at, vectors = vectors_of(local.column(vec_col))
    ids, labels = local.column(id_col).to_numpy()[at], np.array(local.column("label").to_pylist(), dtype=object)[at]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            rows, own = vectors_of(batch.column(2))
            label = np.array(batch.column(1).to_pylist(), dtype=object)[rows]
            for k, v in enumerate(vectors):
                same = [own[i] for i in np.flatnonzero(label == labels[k]) if len(own[i]) == len(v)]
                if same:
                    m = np.stack(same)
                    true[k] += int((m @ v / np.linalg.norm(m, axis=1) / np.linalg.norm(v) >= threshold).sum())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(true, pa.int64())], names=["id", "n"])

    rows = df.select(id_col, F.col(label_col).cast("string").alias("label"), vec_col).mapInArrow(count, "id long, n long")
    true = rows.groupBy("id").agg((F.sum("n") - 1).alias("n"))
    both = true.join(found.select(F.col(id_col).alias("id"), "n_links"), "id").agg(F.sum(F.least("n", "n_links")), F.sum("n")).first()
    return int(both[0] or 0), int(both[1] or 0)

"""Boosted trees for several classes, one model a fold, grown together from shared histograms.

Features become bins once. A level of all trees of all folds is one pass over the rows: tasks sum gradients by (fold, class, node, feature, bin),
sums meet by (fold, class, node), and each such group returns its best split alone, so the driver gets a row a node. Rows are dealt
evenly to tasks, whatever their classes' sizes, and carry their margins, rewritten every few rounds; the trees since then are applied
as rows are read.

Gradients are summed as whole multiples of 2^-24, so that trees don't depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialise
from . import folds as folding

BINS = 64  # the last one is for values that aren't numbers
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 64 << 20  # rows that the bins' edges are taken from, as bounded in bytes as well
SAVE_EVERY = 5
ONE = float(1 << 24)
SLOTS = 1 << 30


@dataclass(frozen=True)
class Settings:
    rounds: int = 30
    depth: int = 3
    rate: float = 0.15
    rows: float = 0.9  # share of rows, and of features, that a tree sees
    features: float = 0.9
    shrink: float = 1.0
    least_weight: float = 1.0  # of second derivatives on either side of a split
    seed: int = 2026


@dataclass
class Trees:
    """One round's trees by (fold, class): feature and bin of the inner nodes (-1: everything goes left), and the leaves' values."""

    number: int
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    levels: int = 0  # how many are grown


@dataclass
class Model:
    present: np.ndarray  # (fold, class): whether the fold's training rows have the class
    trees: list[Trees] = field(default_factory=list)


def _node(bins: np.ndarray, t: Trees, fold: int, k: int, levels: int) -> np.ndarray:
    """The node of each row after so many levels, numbered within its level."""
    at = np.zeros(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    for level in range(levels):
        inner = (1 << level) - 1 + at
        feature = t.feature[fold, k, inner]
        right = (feature >= 0) & (bins[rows, np.maximum(feature, 0)] > t.bin[fold, k, inner])
        at = 2 * at + right
    return at


def _with(margins: np.ndarray, bins: np.ndarray, trees: list[Trees], depth: int) -> np.ndarray:
    out = margins.copy()
    for t in trees:
        for f in range(out.shape[1]):
            for k in range(out.shape[2]):
                out[:, f, k] += t.value[f, k, _node(bins, t, f, k, depth)]
    return out


def _softmax(margins: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Probabilities by the last axis; classes that aren't there have 0."""
    m = np.where(present, margins, -np.inf)
    e = np.exp(m - m.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _drawn(spread: np.ndarray, share: float, *by: int) -> np.ndarray:
    """Rows of a tree's sample, by a hash of the id and what the tree is."""
    if share >= 1:
        return np.ones(len(spread), dtype=bool)
    with np.errstate(over="ignore"):
        x = spread.astype(np.uint64) + np.uint64(hash(by) & (1 << 64) - 1)
        x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return (x >> np.uint64(34)).astype(np.int64) < int(share * SLOTS)


def _arrays(batch: pa.RecordBatch, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(bins, margins) of a batch."""
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(n, -1)
    margins = np.frombuffer(b"".join(batch.column("margins").to_pylist()), dtype="<f8").reshape(n, *shape)
    return bins, margins


def _histograms(rows: DataFrame, model: Model, pending: list[Trees], now: Trees, s: Settings) -> DataFrame:
    """(fold, class, node, sums) a task and node: what is summed over rows before it is shuffled."""
    shape, present, level = model.present.shape, model.present, now.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, margins = _arrays(batch, shape)
            width = bins.shape[1]
            if total is None:
                total = np.zeros((*shape, 1 << level, width * BINS, 2))
            y, fold, spread = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "spread"))
            p = _softmax(_with(margins, bins, pending, s.depth), present)
            place = np.arange(width) * BINS + bins
            for f in range(shape[0]):
                use = np.flatnonzero((fold != f) & _drawn(spread, s.rows, s.seed, now.number, f))
                own, seen = place[use], bins[use]
                for k in np.flatnonzero(present[f]).tolist():
                    g = p[use, f, k] - (y[use] == k)
                    h = np.maximum(2 * p[use, f, k] * (1 - p[use, f, k]), 1e-16)
                    flat = (_node(seen, now, f, k, level)[:, None] * (width * BINS) + own if level else own).ravel()
                    for i, v in enumerate((g, h)):
                        total[f, k, :, :, i] += np.bincount(flat, np.repeat(np.rint(v * ONE), width), minlength=(width * BINS) << level).reshape(1 << level, -1)
        if total is not None:
            keys = np.array([(f, k, n) for f, k in np.argwhere(present) for n in range(1 << level)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(keys[:, i].copy()) for i in range(3)), pa.array([total[f, k, n].astype("<f8").tobytes() for f, k, n in keys.tolist()], pa.binary())], names=["f", "k", "node", "sums"])

    return rows.mapInArrow(run, "f long, k long, node long, sums binary")


def best_split(sums: np.ndarray, features: np.ndarray, s: Settings) -> tuple[int, int, float, float]:
    """(feature, bin, value left, value right) of the split with the greatest gain, the first of equal ones; (-1, -1, value, value) without one.

    ``sums``: (feature, bin, 2) of first and second derivatives; values up to and with the bin go left."""
    g, h = sums[0, :, 0].sum(), sums[0, :, 1].sum()
    weight = lambda a, b: -a / (b + s.shrink) * s.rate
    left = np.cumsum(sums, axis=1)[:, :-1]
    gl, hl = left[..., 0], left[..., 1]
    gr, hr = g - gl, h - hl
    gain = gl**2 / (hl + s.shrink) + gr**2 / (hr + s.shrink) - g**2 / (h + s.shrink)
    gain = np.where((hl >= s.least_weight) & (hr >= s.least_weight) & features[:, None], gain, -np.inf)
    at = int(gain.argmax())
    if not gain.flat[at] > 1e-9:
        return -1, -1, float(weight(g, h)), float(weight(g, h))
    feature, bin_ = divmod(at, gain.shape[1])
    return feature, bin_, float(weight(gl.flat[at], hl.flat[at])), float(weight(gr.flat[at], hr.flat[at]))


def _grow(rows: DataFrame, model: Model, pending: list[Trees], now: Trees, width: int, s: Settings) -> None:
    """One more level of a round's trees."""

    def choose(table: pa.Table) -> pa.Table:
        f, k, node = (table.column(c)[0].as_py() for c in ("f", "k", "node"))
        sums = np.sum([np.frombuffer(b, dtype="<f8") for b in table.column("sums").to_pylist()], axis=0).reshape(width, BINS, 2) / ONE
        seen = np.random.default_rng([s.seed, now.number, f, k]).permutation(width) < max(1, round(s.features * width))
        split = best_split(sums, seen, s)
        return pa.table({"f": [f], "k": [k], "node": [node], "feature": [split[0]], "bin": [split[1]], "left": [split[2]], "right": [split[3]]})

    kind = "f long, k long, node long, feature long, bin long, left double, right double"
    level = now.levels
    for r in _histograms(rows, model, pending, now, s).groupBy("f", "k", "node").applyInArrow(choose, kind).collect():  # a row a node
        inner = (1 << level) - 1 + r["node"]
        now.feature[r["f"], r["k"], inner], now.bin[r["f"], r["k"], inner] = r["feature"], r["bin"]
        below = 1 << (s.depth - level - 1)  # leaves on each side
        first = 2 * r["node"] * below
        now.value[r["f"], r["k"], first : first + below] = r["left"]
        now.value[r["f"], r["k"], first + below : first + 2 * below] = r["right"]
    now.levels += 1


def _edges(df: DataFrame, vec_col: str, id_col: str, width: int, count: int) -> np.ndarray:
    """(width, BINS - 2) upper edges of the bins: quantiles of a bounded sample chosen by a hash of the id."""
    take = min(SAMPLE_ROWS, max(2, SAMPLE_BYTES // (8 * width)))
    near = F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(SLOTS)) < min(SLOTS, int(SLOTS * take / count) + 1)
    x = df.where(near).orderBy(id_col).limit(2 * take).select(F.col(vec_col).cast("array<double>")).toArrow().column(0).to_pylist()
    m = np.array([[np.nan if v is None else v for v in row] for row in x] or np.zeros((1, width)), dtype=np.float64)
    m[~np.isfinite(m)] = np.nan
    with np.errstate(all="ignore"):
        edges = np.nanquantile(np.where(np.isnan(m).all(axis=0), 0.0, m), np.arange(1, BINS - 1) / (BINS - 1), axis=0).T
    return np.ascontiguousarray(edges)


def out_of_sample(df: DataFrame, label_col: str = "label", vec_col: str = "embedding", id_col: str = "id", folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    """Rows with fold and pred_probs over the sorted classes of all rows; each row's model has not seen its fold.

    A class that a fold's training rows lack has probability 0. Rows with a null label, vector or id take no part; null and non-finite
    components go to a bin of their own. Vectors of different widths are an error. Probabilities add up to 1."""
    rows = df.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(vec_col)).alias("least"), F.max(F.size(vec_col)).alias("most")).first()
    if not sizes["n"] or sizes["least"] != sizes["most"]:
        raise ValueError(f"{sizes['n']} rows with vectors of {sizes['least']} to {sizes['most']} numbers; one width is needed")
    width, classes = sizes["most"], sorted(folding.classes_of(rows, label_col))
    k = folding.fold_count(rows, label_col, folds)
    edges = _edges(rows, vec_col, id_col, width, sizes["n"])
    index = F.array_position(F.array(*map(F.lit, classes)), F.col(label_col).cast("string")) - 1
    dealt = folding.stratified_folds(rows.select(id_col, label_col, vec_col), label_col, id_col, k)
    dealt = dealt.select(id_col, "fold", index.cast("long").alias("y"), F.xxhash64(id_col).alias("spread"), F.col(vec_col).cast("array<double>").alias("v"))
    dealt = dealt.repartition("spread")  # the folds' tasks hold whole classes, and all passes would
    shape = (k, len(classes))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = np.zeros(shape).tobytes()
        for batch in batches:
            v = batch.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            out = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(width)], axis=1) if batch.num_rows else np.zeros((0, width))
            out = np.where(np.isfinite(x), out, BINS - 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array([r.tobytes() for r in out], pa.binary()), pa.array([zero] * batch.num_rows, pa.binary())], names=[id_col, "fold", "y", "spread", "bins", "margins"])

    id_field = T.StructField(id_col, df.schema[id_col].dataType)
    state = T.StructType([id_field, T.StructField("fold", T.IntegerType()), T.StructField("y", T.LongType()), T.StructField("spread", T.LongType()), T.StructField("bins", T.BinaryType()), T.StructField("margins", T.BinaryType())])
    table = materialise(dealt.mapInArrow(binned, state), "boosting")
    counts = {(r["fold"], r["y"]): r["count"] for r in table.groupBy("fold", "y").count().collect()}  # folds x classes
    present = np.array([[sum(n for (f, y), n in counts.items() if f != fold and y == c) > 0 for c in range(len(classes))] for fold in range(k)])
    model, pending = Model(present), []
    nodes = (1 << settings.depth) - 1
    for number in range(settings.rounds):
        now = Trees(number, np.full((*shape, nodes), -1), np.full((*shape, nodes), -1), np.zeros((*shape, nodes + 1)))
        for _ in range(settings.depth):
            _grow(table, model, pending, now, width, settings)
        pending.append(now)
        model.trees.append(now)
        if len(pending) == SAVE_EVERY and number + 1 < settings.rounds:
            table, pending = materialise(_rewritten(table, pending, shape, settings.depth, state), "boosting"), []

    trees = pending

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margins = _arrays(batch, shape)
            fold = batch.column("fold").to_numpy()
            own = _softmax(_with(margins, bins, trees, settings.depth), present)[np.arange(len(fold)), fold]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("fold"), pa.array(list(own), pa.list_(pa.float64()))], names=["_id", "fold", "pred_probs"])

    found = table.mapInArrow(predicted, T.StructType([T.StructField("_id", id_field.dataType), T.StructField("fold", T.IntegerType()), T.StructField("pred_probs", T.ArrayType(T.DoubleType()))]))
    return rows.join(found, F.col(id_col) == F.col("_id")).drop("_id")


def _rewritten(table: DataFrame, trees: list[Trees], shape: tuple[int, int], depth: int, kind: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margins = _arrays(batch, shape)
            new = _with(margins, bins, trees, depth)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array([m.astype("<f8").tobytes() for m in new], pa.binary())], names=batch.schema.names)

    return table.mapInArrow(run, kind)

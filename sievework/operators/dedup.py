"""Exact cosine pairs by angular cells, and keep-first de-duplication.

The angle between vectors obeys the triangle inequality. Rows are at home in the cell of their nearest pivot. If x is at home with p, y with q,
and x and y are at most ``a`` apart, then y is at most 2 a further from p than from q: angle(y, p) <= angle(x, p) + a <= angle(x, q) + a
<= angle(y, q) + 2 a. So a row that also visits all cells within 2 a of its own distance meets every partner in that one's home. Whatever
the pivots are, no pair is missed; they only decide how many pairs are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fraction
from ..storage import materialise

FLOOR = float(np.finfo(np.float32).eps)
#: Rows that pivots are chosen from, as bounded in bytes as well, and the most pivots.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_PIVOTS = 8_192, 32 << 20, 1_024
SLACK = 1e-6  # radians: what rounding can do to an angle
SLOTS = 1 << 30


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in column.to_pylist()])
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), FLOOR)


def _directions(x: np.ndarray) -> np.ndarray:
    """Of unit length; rows shorter than ``FLOOR``, which ``_matrix`` leaves shorter, have a direction as well."""
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _visits(x: np.ndarray, pivots: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row, which cells it visits, its home among them)."""
    away = np.arccos(np.clip(_directions(x) @ pivots.T, -1, 1))
    home = away.argmin(axis=1)
    return home, away <= away[np.arange(len(x)), home][:, None] + 2 * angle + SLACK


@dataclass(frozen=True)
class Cells:
    """Pivots, and the angle that pairs are at most apart. Without a gain over comparing all there is one pivot."""

    pivots: np.ndarray
    angle: float

    @property
    def width(self) -> int:
        return self.pivots.shape[1]


def choose_cells(sample: np.ndarray, rows: int, threshold: float, most: int = MOST_PIVOTS) -> Cells:
    """Pivots for ``rows`` rows like the sample's: each is the row furthest from those before, and as many are taken as make the work least,
    counted on the sample: comparisons within cells and with pivots."""
    angle = math.acos(min(1.0, max(-1.0, threshold)))
    x = _directions(sample)
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(most, len(x)):
        far = int(nearest.argmin())
        if nearest[far] > math.cos(angle / 2):  # cells are smaller than pairs are wide
            break
        chosen.append(far)
        nearest = np.maximum(nearest, x @ x[far])
    best, least = 1, float(rows) / 2
    m = 2
    while m // 2 < len(chosen):
        m_now = min(m, len(chosen))
        home, visits = _visits(x, x[chosen[:m_now]], angle)
        at_home = np.bincount(home, minlength=m_now)
        foreign = visits.sum(axis=0) - at_home
        work = float((at_home * (at_home / 2 + foreign)).sum()) / len(x) ** 2 * rows + m_now
        if work < least:
            best, least = m_now, work
        m *= 2
    return Cells(x[chosen[:best]], angle)


def _usable(df: DataFrame, id_col: str, vec_col: str, by: str | None) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    group = F.concat_ws("/", F.size(v).cast("string"), F.col(by).cast("string") if by else F.lit(""))
    rows = df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0))
    if by:
        rows = rows.where(F.col(by).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("id"), group.alias("g"), v.alias("v"))


def _cells_for(rows: DataFrame, threshold: float) -> Cells | None:
    """Pivots from a sample chosen by a hash of the id, of the most common width; nothing without rows."""
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return None
    take = min(SAMPLE_ROWS, max(2, SAMPLE_BYTES // (8 * widths["width"])))
    near = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(SLOTS)) < min(SLOTS, int(SLOTS * take / widths["count"]) + 1)
    sample = rows.where((F.size("v") == widths["width"]) & near).orderBy("id").limit(2 * take).select("v").toArrow().column(0)
    x = _matrix(sample) if len(sample) else np.eye(1, widths["width"])
    return choose_cells(x[_directions(x).any(axis=1)] if x.any() else np.eye(1, widths["width"]), widths["count"], threshold)


def _dealt(rows: DataFrame, cells: Cells) -> DataFrame:
    """(g, cell, id, v, home): a row for each cell that a row visits."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for own in (lengths == cells.width, lengths != cells.width):
                part = batch.filter(pa.array(own))
                if not part.num_rows:
                    continue
                if lengths[own][0] == cells.width and len(cells.pivots) > 1:
                    home, visits = _visits(_matrix(part.column("v")), cells.pivots, cells.angle)
                else:
                    home, visits = np.zeros(part.num_rows, dtype=np.int64), np.ones((part.num_rows, 1), dtype=bool)
                row, cell = np.nonzero(visits)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column("g").take(at), pa.array(cell, pa.int64()), part.column("id").take(at), part.column("v").take(at), pa.array(cell == home[row])], names=["g", "cell", "id", "v", "home"])

    return rows.mapInArrow(visit, "g string, cell long, id long, v array<double>, home boolean")


def _sizes(dealt: DataFrame) -> DataFrame:
    return dealt.select("g", "cell", "home").groupBy("g", "cell").agg(F.count_if("home").alias("at_home"), F.count_if(~F.col("home")).alias("foreign"))


def compared_share(df: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "embedding", by: str | None = None) -> float:
    """The pairs that ``cosine_pairs`` multiplies, as a share of all pairs of the rows that take part."""
    rows = _usable(df, id_col, vec_col, by)
    cells = _cells_for(rows, threshold)
    if cells is None:
        return 0.0
    sizes = _sizes(_dealt(rows, cells))
    h, x = F.col("at_home").cast("double"), F.col("foreign").cast("double")
    done = sizes.agg(F.sum(h * (h - 1) / 2 + h * x).alias("n")).first()["n"] or 0.0
    whole = rows.groupBy("g").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("n")).first()["n"] or 0.0
    return done / whole if whole else 0.0


def _blocks(n: Column, block_rows: int) -> Column:
    return F.ceil(n / block_rows).cast("int")


def cosine_pairs(df: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "embedding", by: str | None = None, block_rows: int = 4_096) -> DataFrame:
    """(a, b, cosine) of all pairs a < b with cosine >= threshold; of equal ``by`` only, if given. Null and empty vectors, and with ``by`` null
    groups, have no pairs, nor have vectors of different widths.

    Rows meet in the cells of the module's bound, and within a cell in blocks, dealt by a hash of the id: each task multiplies two
    matrices of bounded size and returns what passes. Low thresholds, and vectors that spread evenly, leave nothing to bound; then there is one cell and
    all pairs are compared, with the same result."""
    rows = _usable(df, id_col, vec_col, by)
    cells = _cells_for(rows, threshold)
    if cells is None:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("cosine"))
    dealt = _dealt(rows, cells)
    sizes = materialise(_sizes(dealt), "cells").select("g", "cell", _blocks(F.col("at_home"), block_rows).alias("h"), _blocks(F.col("foreign"), block_rows).alias("x"))
    spread = F.xxhash64("id")
    own = F.when(F.col("home"), F.pmod(spread, F.col("h"))).otherwise(F.col("h") + F.pmod(spread, F.col("x"))).cast("int")
    met = dealt.join(sizes.where("h > 0"), ["g", "cell"]).withColumn("own", own)
    # blocks 0 .. h - 1 are at home and meet each other and the foreign ones, h .. h + x - 1; these don't meet each other
    other = F.sequence(F.lit(0), F.when(F.col("home"), F.col("h") + F.col("x") - 1).otherwise(F.col("h") - 1))
    met = met.withColumn("other", F.explode(other)).withColumn("abroad", F.greatest("own", "other") >= F.col("h"))
    met = met.select("g", "cell", "id", "v", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "abroad")

    def multiply(table: pa.Table) -> pa.Table:
        ids, own = table.column("id").to_numpy(), table.column("own").to_numpy()
        i, j, abroad = (table.column(c)[0].as_py() for c in ("i", "j", "abroad"))
        x = _matrix(table.column("v"))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        out = []
        for s in range(0, len(left), 1024):
            part = left[s : s + 1024]
            cos = x[part] @ x[right].T
            p, q = np.nonzero(cos >= threshold)
            a, b = ids[part[p]], ids[right[q]]
            keep = a < b if i == j or abroad else a != b  # a pair with a foreign row is met in both homes
            out.append((np.minimum(a, b)[keep], np.maximum(a, b)[keep], cos[p, q][keep]))
        a, b, c = (np.concatenate(z) for z in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "cosine": pa.array(c, pa.float64())})

    return met.groupBy("g", "cell", "i", "j").applyInArrow(multiply, "a long, b long, cosine double")


def keep_first(pairs: DataFrame) -> DataFrame:
    """(id) of the rows that a pass in ascending id drops: a row goes if a kept row before it is its partner; chains don't carry over.

    Rounds: rows with a kept partner before them go, rows whose partners before them have all gone are kept. Each round is written to
    the shared folder, and looks only at pairs of which both rows are still open."""
    edges = materialise(pairs.select("a", "b").distinct(), "pairs")
    dropped = edges.select(F.col("b").alias("id")).limit(0)
    while edges.take(1):
        kept = materialise(edges.select(F.col("a").alias("id")).distinct().join(edges.select(F.col("b").alias("id")).distinct(), "id", "left_anti"), "kept")
        gone = materialise(edges.join(kept, edges["a"] == kept["id"], "left_semi").select(F.col("b").alias("id")).distinct(), "gone")
        dropped = dropped.unionByName(gone)
        rest = edges.join(gone, edges["b"] == gone["id"], "left_anti").join(gone, edges["a"] == gone["id"], "left_anti")
        edges = materialise(rest, "pairs")
    return dropped


def _copies(df: DataFrame, threshold: float, id_col: str, vec_col: str) -> DataFrame:
    """(id) of rows whose vector an earlier row has as well. Their fate is that row's: whether it is kept or has a kept partner, they go.

    Rounding may bring a vector's cosine with itself just below 1, and vectors shorter than ``FLOOR`` don't reach it."""
    v = F.col(vec_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    rows = df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), norm.alias("norm"))
    rows = rows.where((F.col("norm") >= FLOOR) & F.lit(threshold <= 1 - 1e-9))
    first = rows.groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(first, "v").where("id > first").select("id")


def mark_near_duplicates(df: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """All rows with near_duplicate; the kept ones are a keep-first pass in ascending id, similarity ``threshold`` itself counts.

    Rows with one vector are compared once: all but the first go, so a group of copies of any size makes no pairs of its own."""
    fraction(threshold, "threshold")
    copies = materialise(_copies(df, threshold, id_col, vec_col), "copies")
    rest = df.join(copies.withColumnRenamed("id", "_copy"), F.col(id_col).cast("long") == F.col("_copy"), "left_anti")
    gone = keep_first(cosine_pairs(rest, threshold, id_col, vec_col)).unionByName(copies).distinct().withColumnRenamed("id", "_near")
    marked = df.join(gone, F.col(id_col).cast("long") == F.col("_near"), "left")
    return marked.withColumn("near_duplicate", F.col("_near").isNotNull()).drop("_near")


def exact_duplicates(df: DataFrame, id_col: str, content_col: str) -> DataFrame:
    """(id, first_id, is_duplicate) by SHA-256 of the content; null contents are alone."""
    keyed = df.select(F.col(id_col).alias("id"), F.sha2(F.col(content_col).cast("binary"), 256).alias("h"))
    first = keyed.where("h is not null").groupBy("h").agg(F.min("id").alias("first_id"))
    return keyed.join(first, "h", "left").select("id", F.coalesce("first_id", "id").alias("first_id"), (F.coalesce("first_id", "id") != F.col("id")).alias("is_duplicate"))

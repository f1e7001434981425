"""Approximate nearest neighbours by multiprobe cross-polytope tables, reranked exactly.

Every row goes to one bucket of each table; a query looks into the buckets of the axes nearest to it. Large buckets are split into
blocks of bounded size by a hash of the id, and their queries go to every block, so that a bucket that holds a third of all rows is
as many tasks as it has blocks. A block gives each query its best rows only, so what is merged grows with the queries. Queries that
found fewer rows than asked for, as in tables of a few rows, are compared with all rows of their width.

How many buckets a query must probe hangs on the width, the number of rows and how the vectors lie. It is measured: a few queries' true
neighbours are found among all rows, and the probes that reach them counted (``calibrate``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import crosspolytope
from .common import materialise, vectors_of

TABLES, BLOCK = 4, 4_096
#: Calibration: queries whose true neighbours are looked up, the share of these to be reached, and the most probes of a table.
SAMPLE_QUERIES, TARGET, MOST_PROBES = 256, 0.96, 4_096
MOST_BUCKETS = 1 << 18  # two rotations are only tried where all their buckets can be put in order
LEAST_COUNTED = 200  # with fewer neighbours to count, all of them have to be reached
SEND = 64  # what it costs to send a query to one more bucket, in rows compared
SLOTS = 1 << 30


def unpack(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(len(blobs), -1)


def by_width(vectors: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) of the vectors of each width."""
    width = np.array([len(v) for v in vectors])
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        x = np.stack([vectors[i] for i in at])
        scaled = x / np.abs(x).max(axis=1, keepdims=True)
        yield at, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, in double precision; equal rows give equal values wherever they stand."""
    return (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum())


def best_of_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's k best rows of a block, itself left out, ties to the smaller id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    for a in range(0, len(q), 256):
        rough = q[a : a + 256] @ unit.T / np.sqrt((q[a : a + 256] ** 2).sum(axis=1, keepdims=True))
        rough[query_ids[a : a + 256, None] == ids[None]] = -9
        edge = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(rough), -5.0)
        for i in range(len(rough)):
            at = np.flatnonzero(rough[i] >= max(edge[i] - 1e-9, -5))
            score = cosines(q[a + i], x[at])
            top = np.lexsort((ids[at], -score))[:k]
            out.append((np.full(len(top), query_ids[a + i]), ids[at[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out))  # type: ignore[return-value]


@dataclass(frozen=True)
class Plan:
    """Rotations put together in a bucket's code, probes of each table, and by the sample: the recall, and the share of all rows that
    lie in the buckets probed, rows in several tables counted as often."""

    depth: int
    probes: int
    recall: float
    share: float


def _sampled(df: DataFrame, id_col: str, count: int) -> DataFrame:
    near = F.pmod(F.xxhash64(id_col, F.lit(17)), F.lit(SLOTS)) < min(SLOTS, int(SLOTS * SAMPLE_QUERIES / max(1, count)) + 1)
    return df.where(near).orderBy(F.xxhash64(id_col, F.lit(17)), id_col).limit(SAMPLE_QUERIES)


def true_neighbours(df: DataFrame, asked: list[tuple[int, np.ndarray]], k: int, id_col: str, vec_col: str) -> list[tuple[int, np.ndarray]]:
    """(place in ``asked``, vector) of the k nearest rows of each of a few queries, compared with all rows of its width; each task keeps the k
    best of its rows."""
    by: dict[int, list[int]] = {}
    for i, (_, v) in enumerate(asked):
        by.setdefault(len(v), []).append(i)
    unit = {w: np.stack([asked[i][1] / np.linalg.norm(asked[i][1]) for i in own]) for w, own in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, bytes]]] = {}
        for batch in batches:
            rows, vectors = vectors_of(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            for at, x in by_width(vectors):
                for place, cos in zip(by.get(x.shape[1], ()), unit.get(x.shape[1], np.zeros((0, x.shape[1]))) @ x.T):
                    own = ids[rows[at]]
                    cos = np.where(own == asked[place][0], -2, cos)
                    top = np.argsort(-cos, kind="stable")[:k]
                    found = [(-float(cos[j]), int(own[j]), vectors[at[j]].tobytes()) for j in top.tolist() if cos[j] > -2]
                    best[place] = sorted({r[1]: r for r in [*best.get(place, []), *found]}.values())[:k]
        flat = [(place, *r) for place, own in best.items() for r in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], pa.float64()), pa.array([r[2] for r in flat], pa.int64()), pa.array([r[3] for r in flat], pa.binary())], names=["place", "far", "id", "vec"])

    found = df.select(id_col, vec_col).mapInArrow(run, "place int, far double, id long, vec binary").dropDuplicates(["place", "id"])
    order = Window.partitionBy("place").orderBy("far", "id")
    nearest = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("place", "vec").collect()  # SAMPLE_QUERIES * k rows at most
    return [(r["place"], np.frombuffer(r["vec"])) for r in nearest]


def needed_probes(asked: np.ndarray, place: np.ndarray, neighbours: np.ndarray, tables: int, depth: int) -> np.ndarray:
    """For each neighbour of the query at its place, the probes of each table that it takes to reach it in one of them."""
    least = np.full(len(place), np.iinfo(np.int64).max)
    for t in range(tables):
        most = min(MOST_PROBES, (2 * crosspolytope.rotated(asked[:1], 0).shape[1]) ** depth)
        probed = crosspolytope.probes(asked, t, most, depth)
        code = crosspolytope.codes(neighbours, t, depth)
        for j in range(len(place)):
            at = np.flatnonzero(probed[place[j]] == code[j])
            if len(at):
                least[j] = min(least[j], int(at[0]) + 1)
    return least


def calibrate(df: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, target: float = TARGET, id_col: str = "vec_id", vec_col: str = "embedding") -> Plan:
    """The depth and the fewest probes that reach ``target`` of the true k nearest rows of at most ``SAMPLE_QUERIES`` queries, chosen by a hash of
    the id; of the depths the one that costs less. Vectors that spread evenly take many probes, and then most rows are compared."""
    df = df.where(F.col(id_col).isNotNull())
    queries = df.where(is_query)
    sample = _sampled(queries, id_col, queries.count()).select(id_col, vec_col).toArrow()
    rows, vectors = vectors_of(sample.column(1))
    ids = sample.column(0).to_pylist()
    asked = [(int(ids[i]), v) for i, v in zip(rows.tolist(), vectors)]
    count = df.count()
    found = true_neighbours(df, asked, k, id_col, vec_col) if asked else []
    plans = []
    widest = 2 << max(0, (max((len(v) for _, v in asked), default=1) - 1).bit_length())
    for depth in (1, 2) if widest**2 <= MOST_BUCKETS else (1,):
        need: list[np.ndarray] = []
        buckets = 1
        for w in sorted({len(v) for _, v in asked}):
            own = [i for i, (_, v) in enumerate(asked) if len(v) == w]
            near = [(own.index(p), v) for p, v in found if len(v) == w]
            buckets = max(buckets, (2 * (1 << max(0, (w - 1).bit_length()))) ** depth)
            if near:
                need.append(needed_probes(np.stack([asked[i][1] for i in own]), np.array([p for p, _ in near]), np.stack([v for _, v in near]), tables, depth))
        if not need:
            return Plan(1, 1, 1.0, 0.0)
        least = np.sort(np.concatenate(need))
        target = target if len(least) >= LEAST_COUNTED else 1.0
        probes = int(least[min(len(least) - 1, int(np.ceil(target * len(least))) - 1)])
        if probes <= MOST_PROBES:
            plans.append((tables * probes * SEND + tables * probes / buckets * count, Plan(depth, probes, float((least <= probes).mean()), tables * probes / buckets)))
    return min(plans, key=lambda p: p[0])[1] if plans else Plan(1, MOST_PROBES, 1.0, float(tables))


def search(df: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, plan: Plan | None = None, block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for each row that ``is_query`` holds for, the k rows of greatest cosine found, never its
    own id; nearest first, ties to the smaller id; all rows of its width, if fewer.

    Vectors that are null, zero, empty or hold null or non-finite components, and rows without an id, take no part, neither as queries nor
    as rows; vectors of different widths don't meet. Repeated rows of one id count once. Without a ``plan``, ``calibrate`` finds one."""
    df = df.where(F.col(id_col).isNotNull())
    plan = plan or calibrate(df, is_query, k, tables, id_col=id_col, vec_col=vec_col)
    depth, probe_count = plan.depth, plan.probes
    kind = "tab int, bucket long, id long, vec binary"

    def index(n: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, vectors = vectors_of(batch.column(1))
                ids = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
                for at, unit in by_width(vectors):
                    own = ids[rows[at]]
                    blobs = pa.array([vectors[i].tobytes() for i in at], pa.binary())
                    for t in range(n):
                        code = crosspolytope.codes(unit, t, depth)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t), pa.int32()), pa.array(code, pa.int64()), pa.array(own), blobs], names=["tab", "bucket", "id", "vec"])

        return run

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = vectors_of(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            for at, unit in by_width(vectors):
                own = ids[rows[at]]
                blobs = pa.array([vectors[i].tobytes() for i in at], pa.binary())
                for t in range(tables):
                    found = crosspolytope.probes(unit, t, probe_count, depth)
                    take = np.repeat(np.arange(len(own)), found.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), t), pa.int32()), pa.array(found.ravel(), pa.int64()), pa.array(own[take]), blobs.take(pa.array(take))], names=["tab", "bucket", "id", "vec"])

    where = ["tab", "bucket", "width"]
    with_width = lambda rows: rows.withColumn("width", F.octet_length("vec"))
    rows = with_width(df.select(id_col, vec_col).mapInArrow(index(tables), kind))
    queries = with_width(df.where(is_query).select(id_col, vec_col).mapInArrow(probe, kind))
    split = rows.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))  # one row for each bucket
    left = rows.join(split, where).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    right = queries.join(split, where).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def rerank(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, v, s = best_of_block(own.column("id").to_numpy(), unpack(own.column("vec").to_pylist()), asked.column("id").to_numpy(), unpack(asked.column("vec").to_pylist()), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    def found_in(rows: DataFrame, queries: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    near = materialise(ranked(found_in(left, right, [*where, "block"])), "nearest")
    asked = with_width(df.where(is_query).select(id_col, vec_col).mapInArrow(index(1), kind))
    short = asked.join(near.where(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti").select("id", "vec", "width")
    if not short.take(1):
        return near
    every = with_width(df.select(id_col, vec_col).mapInArrow(index(1), kind)).select("id", "vec", "width")
    split = every.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    left = every.join(split, "width").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    right = short.join(split, "width").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return ranked(near.select("query_id", "vec_id", "score").unionByName(found_in(left, right, ["width", "block"])))

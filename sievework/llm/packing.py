"""Best-fit packing of tokenised documents into sequences of one length.

The plan is made from the histogram of piece lengths alone, which has at most ``capacity`` entries however many documents there
are. Pieces above a third of the capacity are matched greedily, at most two to a sequence: the longest with the longest that
still fits. Smaller ones, longest first, go to the tightest gap that holds them; equal gaps are filled as one group. The result
is a list of runs "pieces of length l, ranks lo.., k to a sequence, m sequences from number s, at place o", and each piece finds
its own run by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_ids, give_back, materialise, slices_by_bytes, text_views
from .tokens import cached_tokenizer

Run = tuple[int, int, int, int, int, int]  # length, lowest rank, pieces to a sequence, sequences, first sequence, place


def plan(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Runs that place every piece of a histogram {length: count}; lengths are 1 to ``capacity``."""
    left = {n: c for n, c in sorted(histogram.items()) if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, sequences)]
    order: list[int] = []  # gaps that have groups, ascending
    sequences = 0

    def add(gap: int, first: int, m: int) -> None:
        if gap and m:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, m))

    def place(n: int, k: int, m: int, first: int, at: int) -> None:
        runs.append((n, used[n], k, m, first, at))
        used[n] += k * m
        left[n] -= k * m

    large = [n for n in left if 3 * n > capacity]
    for n in reversed(large):
        while left[n]:
            fit = bisect.bisect_right(large, min(n, capacity - n)) - 1
            while fit >= 0 and left[large[fit]] < (2 if large[fit] == n else 1):
                fit -= 1
            if fit < 0:
                m = left[n]
                place(n, 1, m, sequences, 0)
                add(capacity - n, sequences, m)
            elif large[fit] == n:
                m = left[n] // 2
                place(n, 2, m, sequences, 0)
                add(capacity - 2 * n, sequences, m)
            else:
                other = large[fit]
                m = min(left[n], left[other])
                place(n, 1, m, sequences, 0)
                place(other, 1, m, sequences, n)
                add(capacity - n - other, sequences, m)
            sequences += m
    for n in reversed([n for n in left if 3 * n <= capacity]):
        while left[n]:
            i = bisect.bisect_left(order, n)
            if i == len(order):
                m = -(-left[n] // (capacity // n))
                add(capacity, sequences, m)
                sequences += m
                continue
            gap = order[i]
            first, m = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[i]
            k = gap // n
            full = min(m, left[n] // k)
            if full:
                place(n, k, full, first, capacity - gap)
                add(gap - k * n, first, full)
            elif m:
                rest = left[n]  # fewer than one sequence takes
                place(n, rest, 1, first, capacity - gap)
                add(gap - rest * n, first, 1)
                full = 1
            add(gap, first + full, m - full)
    return runs


def pieces_of(df: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every tokenised whole text, its ``end_id`` included: (id, piece, start, length, ids_crc32, part, nth).

    Only documents above the capacity are cut. ``nth``: how many pieces of this length came before in the same part. A null text
    counts as empty and gives one piece of one token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(path, True)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1)):
                rows = batch.slice(a, b - a)
                ids, ends = tokenizer.encode_with_end(list(text_views(rows.column(1))), end_id)
                sizes = np.diff(ends, prepend=0)
                count = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                at = (ends - sizes)[doc] + start
                crc = [crc_ids(ids[i : i + n]) for i, n in zip(at.tolist(), length.tolist())]
                by = np.argsort(length, kind="stable")
                tall = length[by]
                nth = np.empty(len(by), dtype=np.int64)
                nth[by] = np.arange(len(by)) - np.searchsorted(tall, tall) + seen[tall]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(nth, pa.int64())], names=[id_col, "piece", "start", "length", "ids_crc32", "part", "nth"])
            batch = rows = ids = None
            give_back()

    fields = [T.StructField(n, k) for n, k in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("part", T.IntegerType()), ("nth", T.LongType()))]
    return df.select(id_col, text_col).mapInArrow(run, T.StructType([df.schema[id_col], *fields]))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to rows that have length, part and nth (see ``pieces_of``); drops part and nth.

    ``pieces`` is read three times and must be stored: its parts and ranks have to stay as they are. What comes to the driver is
    the histogram, at most ``capacity`` rows; what is sent to the executors is the plan made from it. Repeated rows are packed as
    rows of their own; no rows give no rows."""
    counts = materialise(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(plan(histogram, capacity)), dtype=np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "part", "nth")
    keys = runs[:, 0] << 40 | runs[:, 1]  # ranks stay below 2^40: a million million pieces of one length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            r = runs[at]
            i = rank - r[:, 1]
            sequence, offset = r[:, 4] + i // r[:, 2], r[:, 5] + i % r[:, 2] * length
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*kept, "sequence_id", "offset"])

    schema = T.StructType([*(f for f in ranked.schema if f.name != "rank"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack: (id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(materialise(pieces_of(df, path, capacity, end_id, id_col, text_col), "pieces"), capacity).select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

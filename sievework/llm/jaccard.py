"""Exact Jaccard join of documents on word shingles.

1. Each document becomes a set of 64-bit shingle hashes; documents with equal sets become one class.
2. A pass counts how many documents have each shingle. A table of fixed size keeps the order of magnitude of the count of the
   shingles that many have; sets are ordered by it, rare first. (Any order that all sets share gives right results.)
3. A pair that is similar enough shares one of the first n - ceil(t n) + 1 shingles of both. Only these are dealt out, packed by
   ranges of the hash. Within one shingle, sets lie sorted by size, so that partners form size bands, and the place of the shingle
   bounds the overlap. Small groups give all pairs that pass; large ones give a few stars.
4. Candidates that hang together form a tile, cut into blocks by the bytes of its sets and into parts by its pairs, so that no task has more than a
   bounded number of either. In it, hashed bitmaps of one bit a shingle bound the overlap from above, and what passes is settled by
   exact intersection of sorted arrays.
5. Links join classes to components. Then the large groups are looked at again, in pairs of blocks: pairs that lie in different
   components are all looked at, others need not be. Bitmaps of a fixed width, which go with the sets, bound their overlap from above first,
   so that only pairs that may link leave the task. No link between components is lost, and groups of copies never give all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, materialise, mix64, slices_by_bytes, text_views
from .components import connected_components

WORDS = 5
SLOT_BITS = 25  # the table of counts takes 2^25 bytes at most; with fewer shingles, one byte for each that can be common
MARK_BITS = 23  # the table of the documents that candidates need takes 2^23 bits
COMMON = 8  # documents from which a shingle's count is kept
SMALL = 8  # sets of one shingle that give all their pairs at once
TILE_BYTES = 4 << 20  # of a block's sets, about
TILE_PAIRS = 4_000  # pairs of a part of two blocks, about
GROUP = 2_000  # sets of a block of a large group, about
MAP_BITS = 11  # the bitmaps that go with the sets of large groups have 2^11 bits; above some 1,500 shingles they bound less and less
SLICE_BYTES, GATHERED_BYTES = 1 << 20, 8 << 20  # texts that are hashed at once, and whose shingles are dealt out at once
HUBS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_base = 0x9E3779B97F4A7C15
_inverse = pow(_base, -1, 1 << 64)
_blank = np.zeros(256, dtype=bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_places = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, number of words of each text); A-Z count as a-z."""
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    full = ~_blank[raw]
    edge = np.diff(np.concatenate([[False], full, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    counts = np.diff(np.searchsorted(begins, bounds))
    powers = np.full(len(raw), np.uint64(_base))
    inverse = np.full(len(raw), np.uint64(_inverse))
    if len(raw):
        powers[0] = inverse[0] = 1
    with np.errstate(over="ignore"):
        running = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_codes[_lower[raw]] * np.cumprod(powers), out=running[1:])
        inverse = np.cumprod(inverse)
        return mix64((running[ends] - running[begins]) * inverse[begins] + (ends - begins).astype(np.uint64)), counts


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, an empty one has none."""
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
        for k in range(words):
            rolled += hashes[k : k + len(rolled)] * _places[k]
        rolled = mix64(rolled)
        for n in counts.tolist():
            if n >= words:
                out.append(np.unique(rolled[at : at + n - words + 1]))
            elif n:
                out.append(mix64((hashes[at : at + n] * _places[5 : 5 + n]).sum(dtype=np.uint64).reshape(1) + np.uint64(n)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += n
    return out


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """``2^bits`` bits with those of the tokens set."""
    out = np.zeros(max(1, (1 << bits) // 64), dtype=np.uint64)
    at = tokens & np.uint64((1 << bits) - 1)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def most_shared(x: np.ndarray, na, y: np.ndarray, nb) -> np.ndarray:
    """An upper bound of the overlap of sets of ``na`` and ``nb`` tokens by their bitmaps: every bit of one alone is a token the other lacks."""
    alone = lambda p, q: np.bitwise_count(p & ~q).sum(axis=-1, dtype=np.int64)
    return np.minimum(na - alone(x, y), nb - alone(y, x))


def class_of(tokens: np.ndarray) -> int:
    """A signed 63-bit number that equal sets share."""
    with np.errstate(over="ignore"):
        total = mix64(tokens ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
        return int(mix64(np.array([total * np.uint64(_base) + np.uint64(len(tokens))], dtype=np.uint64))[0] >> np.uint64(1))


def _gathered(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """The sets of a column's texts, in lists of about ``GATHERED_BYTES`` of text."""
    out, size = [], 0
    for a, b in slices_by_bytes(column, SLICE_BYTES):
        texts = list(text_views(column.slice(a, b - a)))
        out += shingle_sets(texts, words)
        size += sum(map(len, texts))
        if size >= GATHERED_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def _classes(df: DataFrame, id_col: str, text_col: str, words: int, carry: tuple[str, ...] = ()) -> DataFrame:
    own = {"n_shingles": T.LongType(), "class": T.LongType(), "map": T.BinaryType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1), SLICE_BYTES):
                rows = batch.slice(a, b - a)
                sets = shingle_sets(list(text_views(rows.column(1))), words)
                columns = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([bitmap(s, MAP_BITS).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns, *rows.columns[2:]], names=[id_col, *own, *carry])
            del batch
            give_back()

    return df.select(id_col, text_col, *carry).mapInArrow(run, T.StructType([df.schema[id_col], *(T.StructField(c, kind) for c, kind in own.items()), *(df.schema[c] for c in carry)]))


def _packed(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Rows (bucket, one blob for each column) of values dealt out by the top bits of ``keys``."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    edges = [*first.tolist(), len(bucket)]
    blobs = [pa.array([c[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()) for c in (c[order] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), *blobs], names=["bucket", *(f"c{i}" for i in range(len(columns)))])


def _packed_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField("bucket", T.LongType()), *(T.StructField(f"c{i}", T.BinaryType()) for i in range(n))])


def _column(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)


def _local(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits of a token after those of its bucket."""
    with np.errstate(over="ignore"):
        return ((tokens << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _count_table(df: DataFrame, text_col: str, words: int, total: int) -> np.ndarray:
    """Order of magnitude of the number of documents, by the top bits of the shingle; 0 below ``COMMON``."""
    slot_bits = min(SLOT_BITS, max(16, int(total // COMMON).bit_length()))
    bits = min(slot_bits, max(4, int(total / 500_000).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in _gathered(batch.column(0), words):
                tokens, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
                if len(tokens):
                    often = -(-n // 255)  # a count is one byte; what doesn't fit goes on in further rows
                    last = np.cumsum(often) - 1
                    count = np.full(int(often.sum()), 255, dtype=np.uint8)
                    count[last] = n - 255 * (often - 1)
                    tokens = np.repeat(tokens, often)
                    yield _packed(tokens, [_local(tokens, bits), count], bits)
            del batch
            give_back()

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        token, n = _column(table, "c0", "<u4"), _column(table, "c1", "u1")
        order = np.argsort(token, kind="stable")
        token = token[order]
        head = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
        token, n = token[head], np.add.reduceat(n[order].astype(np.int64), head)
        keep = n >= COMMON
        slots = np.zeros(1 << (slot_bits - bits), dtype=np.uint8)
        level = np.log2(n[keep]).astype(np.uint8)
        np.maximum.at(slots, (token[keep].astype(np.uint64) >> np.uint64(32 - (slot_bits - bits))).astype(np.int64), level)
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "c0": pa.array([slots.tobytes()], pa.binary())})

    rows = df.select(text_col).mapInArrow(deal, _packed_schema(2)).groupBy("bucket").applyInArrow(count, _packed_schema(1))
    out = np.zeros(1 << slot_bits, dtype=np.uint8)
    for r in rows.toLocalIterator():  # 2^SLOT_BITS bytes at most in all
        step = 1 << (slot_bits - bits)
        out[r["bucket"] * step : (r["bucket"] + 1) * step] = np.frombuffer(r["c0"], dtype=np.uint8)
    return out


def _passes(na, pa_, nb, pb, t_num: int, t_den: int):
    """Whether sizes and the places of the first common shingle leave enough overlap: J >= t needs o >= t (na + nb) / (1 + t)."""
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (t_den + t_num) * most >= t_num * (na + nb)


def _pairs_of_group(
    node: np.ndarray, n: np.ndarray, place: np.ndarray, t_num: int, t_den: int, component: np.ndarray | None = None, side: np.ndarray | None = None, maps: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets that share a shingle and pass the bounds; in different components, on different sides and with bitmaps that
    leave enough overlap, if given. Sorted by size: the partners of a set are a band after it."""
    order = np.argsort(n, kind="stable")
    node, n, place = node[order], n[order], place[order]
    component, side, maps = (None if x is None else x[order] for x in (component, side, maps))
    until = np.searchsorted(n, n * t_den // t_num, side="right")
    left, right = [], []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, until[i])
        if len(j):
            ok = _passes(n[i], place[i], n[j], place[j], t_num, t_den)
            if component is not None:
                ok &= component[i] != component[j]
            if side is not None:
                ok &= side[i] != side[j]
            j = j[ok]
            if maps is not None and len(j):
                j = j[(t_den + t_num) * most_shared(maps[i], n[i], maps[j], n[j]) >= t_num * (n[i] + n[j])]
            left.append(np.full(len(j), node[i]))
            right.append(node[j])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _groups(token: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.concatenate([np.flatnonzero(np.diff(token, prepend=token[:1] - 1 if len(token) else 0) != 0), [len(token)]]) if len(token) else np.zeros(1, np.int64)
    size = np.diff(edges)
    for k in np.flatnonzero(size > 1).tolist():
        yield int(edges[k]), int(edges[k + 1])


def _candidates(df: DataFrame, text_col: str, words: int, table: np.ndarray, total: int, t_num: int, t_den: int) -> DataFrame:
    """(a, b) candidates with group null, and (group, a, n, place) rows of large groups with b null."""
    spark = df.sparkSession
    bits = max(4, int(total / 1_000_000).bit_length())
    shared = spark.sparkContext.broadcast(table)  # 2^SLOT_BITS bytes at most
    slot_bits = len(table).bit_length() - 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for sets in _gathered(batch.column(0), words):
                tokens, nodes, sizes, places, seen = [], [], [], [], set()
                for s in sets:
                    n = len(s)
                    node = class_of(s) if n else None
                    if not n or node in seen:
                        continue
                    seen.add(node)
                    first = n - -(-t_num * n // t_den) + 1
                    key = level[(s >> np.uint64(64 - slot_bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | s >> np.uint64(8)
                    chosen = np.argpartition(key, first - 1)[:first]
                    chosen = chosen[np.argsort(key[chosen])]
                    tokens.append(s[chosen])
                    nodes.append(np.full(first, node))
                    sizes.append(np.full(first, n, dtype=np.int32))
                    places.append(np.arange(first, dtype=np.int32))
                if tokens:
                    token = np.concatenate(tokens)
                    yield _packed(token, [_local(token, bits), np.concatenate(nodes), np.concatenate(sizes), np.concatenate(places)], bits)
            del batch
            give_back()

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        token, node = _column(table, "c0", "<u4"), _column(table, "c1", "<i8")
        n, place = _column(table, "c2", "<i4").astype(np.int64), _column(table, "c3", "<i4").astype(np.int64)
        order = np.lexsort((node, token))
        token, node, n, place = token[order], node[order], n[order], place[order]
        once = np.ones(len(token), dtype=bool)
        once[1:] = (np.diff(token.astype(np.int64)) != 0) | (np.diff(node) != 0)  # one of equal sets
        token, node, n, place = token[once], node[once], n[once], place[once]
        pairs, large = [], []
        for x, y in _groups(token):
            g = slice(x, y)
            if y - x <= SMALL:
                pairs.append(np.stack(_pairs_of_group(node[g], n[g], place[g], t_num, t_den)))
                continue
            # the hubs depend on the sets alone, so that groups of the same sets give the same pairs
            by = np.arange(x, y)
            hubs = [x + int(np.argmin(mix64(node[g].astype(np.uint64) ^ seed))) for seed in HUBS]
            left, right = np.repeat(hubs, y - x), np.tile(by, len(hubs))
            low, high = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
            ok = (t_den * low >= t_num * high) & (left != right)
            pairs.append(np.stack([node[left[ok]], node[right[ok]]]))
            large.append((np.full(y - x, bucket << 32 | int(token[x])), node[g], n[g], place[g]))
        ab = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
        ab = np.unique(np.stack([ab.min(axis=0), ab.max(axis=0)]), axis=1) if ab.shape[1] else ab
        rows = [np.concatenate([np.zeros(0, np.int64), *(x[i] for x in large)]) for i in range(4)]
        k, m = ab.shape[1], len(rows[0])
        return pa.table({
            "a": pa.array(np.concatenate([ab[0], rows[1]]), pa.int64()),
            "b": pa.concat_arrays([pa.array(ab[1], pa.int64()), pa.nulls(m, pa.int64())]),
            "group": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(rows[0], pa.int64())]),
            "n": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(rows[2], pa.int64())]),
            "place": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(rows[3], pa.int64())]),
        })

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "group", "n", "place")])
    return materialise(df.select(text_col).mapInArrow(deal, _packed_schema(4)).groupBy("bucket").applyInArrow(meet, schema), "candidates")


def _settle(df: DataFrame, text_col: str, words: int, pairs: DataFrame, sizes: DataFrame, t_num: int, t_den: int) -> DataFrame:
    """Those of the distinct candidate pairs (a, b) that link; ``sizes``: (class, n)."""
    spark = df.sparkSession
    tiles = connected_components(pairs).withColumnRenamed("node", "class").join(sizes, "class")
    degree = pairs.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("degree"))
    blocks = tiles.groupBy("component").agg(F.ceil(F.sum("n") * 8 / TILE_BYTES).alias("blocks"))
    tiles = materialise(tiles.join(blocks, "component").join(degree, "class").select("class", F.col("component").alias("tile"), F.pmod(F.xxhash64("class"), F.col("blocks")).alias("block"), "degree"), "tiles")
    end = lambda c: tiles.select(F.col("class").alias(c), "tile", F.col("block").alias(f"block_{c}"), F.col("degree").alias(f"degree_{c}"))
    placed = pairs.join(end("a"), "a").join(end("b").drop("tile"), "b").withColumn("i", F.least("block_a", "block_b")).withColumn("j", F.greatest("block_a", "block_b"))
    # The pairs of one set that has many go to several parts, by their other sets.
    key = F.when(F.col("degree_a") < F.col("degree_b"), F.col("a")).otherwise(F.col("b"))
    parts = placed.groupBy("tile", "i", "j").agg(F.ceil(F.count(F.lit(1)) / TILE_PAIRS).alias("parts"))
    placed = placed.join(parts, ["tile", "i", "j"]).withColumn("part", F.pmod(F.xxhash64(key, F.lit(7)), F.col("parts")))
    where = ["tile", "i", "j", "part"]
    placed = materialise(placed.select("a", "b", *where), "placed")
    wanted = materialise(placed.select(F.explode(F.array("a", "b")).alias("class"), *where).distinct(), "wanted")

    # Which documents are needed is told by a bit array of fixed size; a wrong bit only costs a set that the join drops.
    def bits_of(table: pa.Table) -> pa.Table:
        slots = np.zeros((1 << MARK_BITS) >> 6, dtype=np.uint8)
        at = table.column("slot").to_numpy()
        np.bitwise_or.at(slots, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        return pa.table({"bucket": table.column("bucket")[:1], "c0": pa.array([slots.tobytes()], pa.binary())})

    slot = F.shiftright(F.col("class"), 63 - MARK_BITS)
    marks = wanted.select(slot.alias("s")).distinct().select(F.shiftright("s", MARK_BITS - 3).cast("long").alias("bucket"), F.col("s").bitwiseAND((1 << (MARK_BITS - 3)) - 1).cast("long").alias("slot"))
    table = np.zeros((1 << MARK_BITS) >> 3, dtype=np.uint8)
    step = len(table) >> 3
    for r in marks.groupBy("bucket").applyInArrow(bits_of, _packed_schema(1)).toLocalIterator():  # 2^MARK_BITS bits in all
        table[r["bucket"] * step : (r["bucket"] + 1) * step] = np.frombuffer(r["c0"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(table)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = shared.value
        for batch in batches:
            for sets in _gathered(batch.column(0), words):
                found: dict[int, bytes] = {}
                for s in sets:
                    if len(s):
                        node = class_of(s)
                        at = node >> (63 - MARK_BITS)
                        if marked[at >> 3] >> (at & 7) & 1:
                            found[node] = s.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["class", "set"])
            del batch
            give_back()

    sets = df.select(text_col).mapInArrow(sets_of, "class long, set binary").dropDuplicates(["class"])
    rows = wanted.join(sets, "class").groupBy(*where).cogroup(placed.groupBy(*where))

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs = left.column("set").to_pylist()
        index = dict(zip(left.column("class").to_pylist(), range(len(blobs))))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in blobs]
        size = np.array([len(s) for s in sets])
        out: list[tuple[int, int]] = []
        maps: dict[tuple[int, int], np.ndarray] = {}
        parent = list(range(len(sets)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for p, q in sorted(zip(right.column("a").to_pylist(), right.column("b").to_pylist())):
            i, j = index[p], index[q]
            ri, rj = find(i), find(j)
            if ri == rj:
                continue  # joined by other links of this tile
            na, nb = int(size[i]), int(size[j])
            need = -(-t_num * (na + nb) // (t_den + t_num))
            band = max(6, int(max(na, nb) - 1).bit_length())  # bitmaps of the pair's size band
            for x in (i, j):
                if (x, band) not in maps:
                    maps[x, band] = bitmap(sets[x], band)
            x, y = maps[i, band], maps[j, band]
            if most_shared(x, na, y, nb) < need:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if t_den * both >= t_num * (na + nb - both):
                out.append((p, q))
                parent[ri] = rj
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return materialise(rows.applyInArrow(check, "a long, b long"), "links")


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, t_num: int = 3, t_den: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_shingles, component_id, and the columns ``carry``) of every row; two documents link when their sets' Jaccard similarity is at least t_num / t_den.

    component_id: the smallest id that links reach, the own one included. Null or empty texts have no shingle and stay alone;
    rows of equal sets share a class and need no pairs. Ids must be integers; a row without one has a null component_id unless links reach a row
    with one. Links come as a spanning set: every two texts that link
    are in one component."""
    rows = materialise(_classes(df, id_col, text_col, words, carry), "classes")
    nodes = rows.where("class is not null").groupBy("class").agg(F.min(id_col).alias("least"))
    sizes = rows.where("class is not null").groupBy("class").agg(F.first("n_shingles").alias("n"))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    if not total:
        return rows.select(id_col, "n_shingles", F.col(id_col).cast("long").alias("component_id"), *carry)
    found = _candidates(df, text_col, words, _count_table(df, text_col, words, total), total, t_num, t_den)
    pairs = materialise(found.where("b is not null").select("a", "b").distinct(), "pairs")
    links = _settle(df, text_col, words, pairs, sizes, t_num, t_den) if pairs.take(1) else pairs
    joined = materialise(connected_components(links), "components")
    large = found.where("b is null").select("group", F.col("a").alias("node"), "n", "place").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = large.groupBy("group").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("blocks")).where("x <> y").select("group", "blocks")
    maps = rows.where("class is not null").groupBy(F.col("class").alias("node")).agg(F.first("map").alias("map"))
    large = large.join(mixed, "group").join(maps, "node")
    own = large.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def across(table: pa.Table) -> pa.Table:
        node, n, place, component, side = (table.column(c).to_numpy() for c in ("node", "n", "place", "component", "own"))
        words_of = np.frombuffer(b"".join(table.column("map").to_pylist()), dtype=np.uint64).reshape(len(node), -1)
        apart = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        a, b = _pairs_of_group(node, n, place, t_num, t_den, component, side if apart else None, words_of)
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    rest = own.select("group", "i", "j", "own", "node", "n", "place", "component", "map").groupBy("group", "i", "j").applyInArrow(across, "a long, b long").distinct()
    rest = materialise(rest.join(pairs, ["a", "b"], "left_anti"), "across")
    if rest.take(1):
        links = links.unionByName(_settle(df, text_col, words, rest, sizes, t_num, t_den))
        joined = connected_components(links)
    least = nodes.join(joined.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    roots = least.groupBy("component").agg(F.min("least").alias("root"))
    by_class = least.join(roots, "component").select("class", "root")
    return rows.join(by_class, "class", "left").select(id_col, "n_shingles", F.coalesce("root", F.col(id_col)).cast("long").alias("component_id"), *carry)

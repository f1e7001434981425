"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a smaller document, or earlier in its own.

1. Every such string has an anchor, the least hash among its grams of ``GRAM`` bytes. Equal strings have equal anchors, so a string
   whose anchor occurs once can't repeat. A pass counts anchors, packed by ranges of the hash, into a bit array of bounded size (a
   wrong bit only costs work).
2. The strings of one anchor are consecutive; the stretch of text that holds them is dealt out by the anchor's hash, once for each
   task and content. So all places of a string come together, and groups of copies come as few stretches.
3. Each group of stretches is cut into shards of bounded size. A shard's suffix array is refined as Larsson and Sadakane do: sorted by 8
   bytes, then doubled, where only groups that are still tied are sorted again. Common prefixes of neighbours are compared in full
   only where the neighbour isn't that of the place before moved by one, or that one had nothing in common; elsewhere they shrink by
   one, as Kasai et al. show.
4. Shards are merged by binary search of each shard's distinct strings in the arrays of the shards before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, materialise, mix64, slices_by_bytes, text_views

LENGTH = 100
GRAM = 32
SHARD_BYTES = 1 << 19  # a shard takes some hundred times its bytes for a moment
SLICE_BYTES = 1 << 19  # of texts read at once; their anchors take some hundred times that for a moment
MOST_TABLE_BITS = 28  # 32 MB of bits at most are sent to the executors
_base = np.uint64(0x9E3779B97F4A7C15)
_inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
PLACE_BITS = np.uint64(26)


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least hash, the first of equal ones, in each window of ``width`` hashes. Places are packed into the hashes' low bits, so
    long arrays are taken in stretches that overlap by width - 1."""
    mask = np.uint64((1 << int(PLACE_BITS)) - 1)
    stride = int(mask) + 2 - width
    out = []
    for a in range(0, len(hashes) - width + 1, stride):
        part = hashes[a : a + stride + width - 1]
        key, done = part >> PLACE_BITS << PLACE_BITS | np.arange(len(part), dtype=np.uint64), 1
        while done < width:  # sliding minimum by doubling
            step = min(done, width - done)
            key = np.minimum(key[:-step], key[step:])
            done += step
        out.append((key & mask).astype(np.int64) + a)
    return np.concatenate(out)


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor: (anchor's hash, text, first start, last start, all bytes); starts count in the joined texts."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return empty.astype(np.uint64), empty, empty, empty, raw
    n = len(raw)
    powers = np.full(n, _base)
    powers[0] = 1
    with np.errstate(over="ignore"):
        running = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_codes[raw] * np.cumprod(powers), out=running[1:])
        powers[1:] = _inverse
        hashes = mix64((running[gram:] - running[:-gram]) * np.cumprod(powers)[: n - gram + 1])
    del running, powers
    at = _least(hashes, length - gram + 1)  # one for each start 0 .. n - length
    ends = np.cumsum(size)
    doc = np.repeat(np.arange(len(texts)), size)[: len(at)]
    valid = np.arange(len(at)) + length <= ends[doc]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | first[1:]
    begins, stops = np.flatnonzero(first), np.flatnonzero(last)
    # least hashes crowd near 0; mixed once more they spread over all buckets
    return mix64(hashes[at[begins]] ^ _base), doc[begins], begins, stops, raw


def _local(hashes: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _repeated(df: DataFrame, text_col: str, total: int) -> np.ndarray:
    """Bit array, by the hash's top bits, of the anchors that occur more than once."""
    table_bits = min(MOST_TABLE_BITS, max(16, int(total).bit_length()))
    bits = min(12, max(3, int(total / (16 << 20)).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(0), SLICE_BYTES):
                h = anchors(list(text_views(batch.column(0).slice(a, b - a))))[0]
                if not len(h):
                    continue
                h.sort()
                bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                local = _local(h, bits)
                edges = [*first.tolist(), len(h)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), pa.array([local[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary())], names=["bucket", "blob"])
            del batch
            give_back()

    def count(table: pa.Table) -> pa.Table:
        give_back()  # what the group before took
        local, n = np.unique(np.frombuffer(b"".join(table.column("blob").to_pylist()), dtype="<u4"), return_counts=True)
        slot = (local[n > 1].astype(np.uint64) >> np.uint64(32 - (table_bits - bits))).astype(np.int64)
        out = np.zeros(max(1, 1 << (table_bits - bits) >> 3), dtype=np.uint8)
        np.bitwise_or.at(out, slot >> 3, np.uint8(1) << (slot & 7).astype(np.uint8))
        return pa.table({"bucket": table.column("bucket")[:1], "blob": pa.array([out.tobytes()], pa.binary())})

    kind = "bucket long, blob binary"
    table = np.zeros(1 << table_bits >> 3, dtype=np.uint8)
    step = len(table) >> bits
    for r in df.select(text_col).mapInArrow(deal, kind).groupBy("bucket").applyInArrow(count, kind).toLocalIterator():
        table[r["bucket"] * step : (r["bucket"] + 1) * step] = np.frombuffer(r["blob"], dtype=np.uint8)
    return table


def _words(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one big-endian number."""
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    pairs = padded[:-1] << np.uint64(8) | padded[1:]
    fours = pairs[:-2] << np.uint64(16) | pairs[2:]
    return (fours[:-4] << np.uint64(32) | fours[4:])[: len(raw)]


class Shard:
    """Suffix array of the strings of ``length`` bytes that start inside stretches of text.

    ``room``: bytes from each place to its stretch's end. ``order``: starts of all whole strings, sorted by the string, ties by place;
    ``prefix``: bytes that each has in common with the one before it, never counted past a stretch's end."""

    def __init__(self, raw: np.ndarray, room: np.ndarray, length: int = LENGTH):
        self.raw, self.room, self.length = raw, room, length
        self.words = _words(raw)
        self.order = self._sort()
        self.prefix = self._prefixes()

    def _sort(self) -> np.ndarray:
        at = np.flatnonzero(self.room >= 8)
        at = at[np.argsort(self.words[at], kind="stable")]
        rank = np.full(len(self.raw), -1, dtype=np.int64)  # of a group: the place of its first member
        keys = self.words[at]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(at) else np.zeros(0, dtype=np.int64)
        rank[at] = np.repeat(starts, np.diff(np.append(starts, len(at))))
        depth = 8
        while depth < self.length:
            step = min(depth, self.length - depth)
            size = np.bincount(rank[at], minlength=len(at))
            tied = np.flatnonzero(size[rank[at]] > 1)  # only these are sorted again
            own = at[tied]
            whole = self.room[own] >= depth + step
            second = np.where(whole, rank[np.minimum(own + step, len(self.raw) - 1)], -1)
            group = rank[own]
            by = np.lexsort((own, second, group))
            own, second, group = own[by], second[by], group[by]
            at[tied] = own
            new = np.ones(len(own), dtype=bool)
            new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
            heads = np.flatnonzero(new)
            rank[own] = np.repeat(tied[heads], np.diff(np.append(heads, len(own))))
            depth += step
        return at[self.room[at] >= self.length]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the texts from a and b have in common, within their stretches."""
        most = np.minimum(self.room[a], self.room[b])
        out = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            inside = out[live] < most[live]
            live, x, y = live[inside], x[inside], y[inside]
            differ = self.words[x] ^ self.words[y]
            same = differ == 0
            out[live[same]] += 8
            rest = live[~same]
            # leading zero bytes of the difference
            lead = np.zeros(len(rest), dtype=np.int64)
            left = differ[~same]
            for k in range(1, 8):
                lead += (left >> np.uint64(64 - 8 * k)) == 0
            out[rest] += lead
            live = live[same]
        return np.minimum(out, most)

    def _prefixes(self) -> np.ndarray:
        n = len(self.order)
        out = np.zeros(n, dtype=np.int64)
        if n < 2:
            return out
        before = np.full(len(self.raw), -1, dtype=np.int64)
        before[self.order[1:]] = self.order[:-1]
        places = np.flatnonzero(before >= 0)
        prior = before[places]
        moved = np.zeros(len(places), dtype=bool)  # the neighbour is that of the place before, moved by one
        moved[1:] = (np.diff(places) == 1) & (np.diff(prior) == 1) & (self.room[places[1:]] == self.room[places[:-1]] - 1) & (self.room[prior[1:]] == self.room[prior[:-1]] - 1)
        full = np.flatnonzero(~moved)
        value = np.zeros(len(places), dtype=np.int64)
        value[full] = self.common(places[full], prior[full])
        source = np.maximum.accumulate(np.where(moved, 0, np.arange(len(places))))
        value = value[source] - (places - places[source])
        past = np.flatnonzero(value < 0)  # beyond the first difference nothing follows from the place before
        value[past] = self.common(places[past], prior[past])
        at = np.zeros(len(self.raw), dtype=np.int64)
        at[places] = value
        out[1:] = at[self.order[1:]]
        return out

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of the group of equal strings of each member of ``order``, place in ``order`` of each group's first)."""
        head = self.prefix < self.length
        if len(head):
            head[0] = True
        return np.cumsum(head) - 1, np.flatnonzero(head)

    def find(self, other: "Shard", starts: np.ndarray) -> np.ndarray:
        """Whether the strings of ``other`` that start there are in this shard, by binary search."""
        low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(self.order))
        found = np.zeros(len(starts), dtype=bool)
        while True:
            live = np.flatnonzero((low < high) & ~found)
            if not len(live):
                return found
            middle = (low[live] + high[live]) // 2
            sign = self._compare(self.order[middle], other, starts[live])
            found[live[sign == 0]] = True
            less = sign < 0
            low[live[less]] = middle[less] + 1
            high[live[sign > 0]] = middle[sign > 0]

    def _compare(self, own: np.ndarray, other: "Shard", theirs: np.ndarray) -> np.ndarray:
        sign = np.zeros(len(own), dtype=np.int64)
        live = np.arange(len(own))
        offsets = [*range(0, self.length - 8, 8), self.length - 8]
        for k in offsets:
            x, y = self.words[own[live] + k], other.words[theirs[live] + k]
            sign[live] = np.where(x < y, -1, np.where(x > y, 1, 0))
            live = live[x == y]
            if not len(live):
                break
        return sign


def repeated_starts(spans: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of every string of ``length`` bytes in the stretches that also starts earlier.

    Stretches are (bytes, document, start in it); a string lies whole in its stretch. Shards are looked up in those before them."""
    order = np.lexsort((starts, docs))
    size = np.array([len(s) for s in spans], dtype=np.int64)[order]
    edges = np.flatnonzero(np.diff((np.cumsum(size) - 1) // shard_bytes, prepend=-1)).tolist()
    done: list[Shard] = []
    out_doc, out_start = [], []
    for a, b in zip(edges, [*edges[1:], len(order)]):
        own = order[a:b]
        raw = np.frombuffer(b"".join(spans[i] for i in own.tolist()), dtype=np.uint8)
        ends = np.cumsum(size[a:b])
        room = np.repeat(ends, size[a:b]) - np.arange(len(raw))
        place = np.repeat(starts[own], size[a:b]) + np.repeat(size[a:b], size[a:b]) - room
        doc = np.repeat(docs[own], size[a:b])
        shard = Shard(raw, room, length)
        group, heads = shard.groups()
        first = shard.order[heads]  # ties are sorted by place, and stretches by document and start
        seen = np.zeros(len(heads), dtype=bool)
        for earlier in done:
            rest = np.flatnonzero(~seen)
            seen[rest] = earlier.find(shard, first[rest])
        lead = first[group]
        at = shard.order
        gone = seen[group] | (doc[at] > doc[lead]) | ((doc[at] == doc[lead]) & (place[at] > place[lead]))
        out_doc.append(doc[at[gone]])
        out_start.append(place[at[gone]])
        shard.order = shard.order[heads]  # for later shards the distinct strings are enough
        del shard.prefix, shard.room
        done.append(shard)
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_doc), np.concatenate(out_start)


def _runs(doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that strings from these starts cover: (document, from, to)."""
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(doc)) - 1 if len(head) else head
    return doc[head], start[head], start[last] + length


def _documents(ids: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each row's document, by id and digest of its text; ids and digests of the numbers in order)."""
    pairs = np.empty(len(ids), dtype=[("id", np.int64), ("digest", np.int64)])
    pairs["id"], pairs["digest"] = ids, digests
    known, number = np.unique(pairs, return_inverse=True)
    return number, known["id"], known["digest"]


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, start, end): byte ranges that repeated strings cover in the text of that id and digest (xxhash64); those of one document may
    overlap or touch."""
    spark = df.sparkSession
    rows = df.where(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= LENGTH)).select(id_col, text_col, F.xxhash64(text_col).alias("digest"))
    total = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shared = spark.sparkContext.broadcast(_repeated(rows, text_col, total))  # 2^MOST_TABLE_BITS bits at most
    bits = max(4, int(total / (2 << 20)).bit_length())
    kind = "bucket long, docs binary, digests binary, starts binary, sizes binary, texts binary, gone binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        shift = np.uint64(64 - (len(table) * 8 - 1).bit_length())
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1), SLICE_BYTES):
                rows = batch.slice(a, b - a)
                number, *known = _documents(rows.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False), rows.column(2).to_numpy(zero_copy_only=False))
                texts = list(text_views(rows.column(1)))
                h, doc, begins, stops, raw = anchors(texts)
                slot = (h >> shift).astype(np.int64)
                keep = (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
                h, doc, begins, stops = h[keep], doc[keep], begins[keep], stops[keep]
                if not len(h):
                    continue
                base = np.cumsum([len(t) for t in texts]) - np.array([len(t) for t in texts])
                own, start = number[doc], begins - base[doc]
                by = np.lexsort((start, own))
                joined = raw.tobytes()
                first: dict[bytes, int] = {}
                kept, gone = [], []
                for i in by.tolist():  # of equal stretches in this batch only the earliest travels; the others are repeats
                    text = joined[begins[i] : stops[i] + LENGTH]
                    j = first.setdefault(text, i)
                    (kept if j == i else gone).append(i)
                gone = [i for i in gone if (own[i], start[i]) != (own[first[joined[begins[i] : stops[i] + LENGTH]]], start[first[joined[begins[i] : stops[i] + LENGTH]]])]
                chosen = np.array(kept + gone, dtype=np.int64)
                bucket = (h[chosen] >> np.uint64(64 - bits)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                heads = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                out: dict[str, list] = {c: [] for c in ("bucket", "docs", "digests", "starts", "sizes", "texts", "gone")}
                for x, y in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
                    group = order[x:y]
                    travel, rest = chosen[group[group < len(kept)]], chosen[group[group >= len(kept)]]
                    size = stops[travel] + LENGTH - begins[travel]
                    out["bucket"].append(int(bucket[group[0]]))
                    out["docs"].append(known[0][own[travel]].astype("<i8").tobytes())
                    out["digests"].append(known[1][own[travel]].astype("<i8").tobytes())
                    out["starts"].append(start[travel].astype("<i8").tobytes())
                    out["sizes"].append(size.astype("<i4").tobytes())
                    out["texts"].append(b"".join(joined[p : p + s] for p, s in zip(begins[travel].tolist(), size.tolist())))
                    out["gone"].append(np.stack([known[0][own[rest]], known[1][own[rest]], start[rest], start[rest] + (stops[rest] - begins[rest]) + LENGTH], axis=1).astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int64()), *(pa.array(out[c], pa.binary()) for c in list(out)[1:])], names=list(out))
            del batch
            give_back()

    def settle(table: pa.Table) -> pa.Table:
        give_back()  # what the group before took
        column = lambda c, dtype: np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=dtype)
        docs, *known = _documents(column("docs", "<i8"), column("digests", "<i8"))
        starts, sizes = column("starts", "<i8"), column("sizes", "<i4").astype(np.int64)
        text = b"".join(table.column("texts").to_pylist())
        ends = np.cumsum(sizes)
        spans = [text[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
        first: dict[bytes, int] = {}
        kept, copies = [], []
        for i in np.lexsort((starts, docs)).tolist():  # of equal stretches only the earliest is sorted; the others are repeats
            j = first.setdefault(spans[i], i)
            if j == i:
                kept.append(i)
            elif docs[i] != docs[j] or starts[i] != starts[j]:
                copies.append(i)
        doc, start = repeated_starts([spans[i] for i in kept], docs[kept], starts[kept])
        doc, start, end = _runs(doc, start, LENGTH)
        found = [np.concatenate([doc, docs[copies]]), np.concatenate([start, starts[copies]]), np.concatenate([end, starts[copies] + sizes[copies]])]
        gone = np.concatenate([column("gone", "<i8").reshape(-1, 4), np.stack([known[0][found[0]], known[1][found[0]], *found[1:]], axis=1)])
        return pa.table({c: pa.array(gone[:, i].copy(), pa.int64()) for i, c in enumerate((id_col, "digest", "start", "end"))})

    return rows.mapInArrow(deal, kind).groupBy("bucket").applyInArrow(settle, f"`{id_col}` long, digest long, start long, end long")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """(id, n_bytes, spans, kept, and the columns ``carry``) of every row: spans array of (start, end), the maximal removed byte runs; kept binary, the rest.
    If ``whole_characters``, a character that loses a byte goes as a whole.

    A null text counts as empty. Strings are judged on the input. Ids are integers; rows with the same id and text count as one
    document, get the same result, and don't make each other repeats; rows with one id and different texts are documents of their own, in the
    order of a hash of the text. A row with a null id loses nothing and makes nothing a repeat.
    A document's ranges are the only thing gathered by id, in proportion to its own length."""
    ranges = materialise(repeats(df, id_col, text_col), "repeats")
    by_doc = ranges.groupBy(F.col(id_col).alias("_id"), F.col("digest").alias("_digest")).agg(F.collect_list("start").alias("_starts"), F.collect_list("end").alias("_ends"))
    own = (F.col(id_col) == F.col("_id")) & (F.xxhash64(text_col) == F.col("_digest"))
    joined = df.select(id_col, text_col, *carry).join(by_doc, own, "left").select(id_col, text_col, "_starts", "_ends", *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for x, y in slices_by_bytes(batch.column(1)):
                rows = batch.slice(x, y - x)
                spans, kept = [], []
                for text, starts, ends in zip(text_views(rows.column(1)), rows.column(2).to_pylist(), rows.column(3).to_pylist()):
                    own: list[dict] = []
                    for s, e in sorted(zip(starts or (), ends or ())):
                        while whole_characters and s and text[s] & 0xC0 == 0x80:
                            s -= 1
                        while whole_characters and e < len(text) and text[e] & 0xC0 == 0x80:
                            e += 1
                        if own and s <= own[-1]["end"]:
                            own[-1]["end"] = max(own[-1]["end"], e)
                        else:
                            own.append({"start": s, "end": e})
                    spans.append(own)
                    parts, at = [], 0
                    for o in own:
                        parts.append(text[at : o["start"]])
                        at = o["end"]
                    kept.append(b"".join([*parts, text[at:]]))
                sizes = pa.array([len(t) for t in text_views(rows.column(1))], pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0), sizes, pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary()), *rows.columns[4:]], names=[id_col, "n_bytes", "spans", "kept", *carry])
            del batch
            give_back()

    schema = T.StructType([df.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.BinaryType()), *(df.schema[c] for c in carry)])
    return joined.mapInArrow(run, schema)

"""Removal of repeated word sequences by recompression.

A word goes if ``WINDOW`` consecutive words that cover it also start earlier: in a smaller document, or earlier in its own.

1. A round names runs of equal symbols and then pairs of neighbours, starting from words. Names are digests of what they stand for, so all
   tasks name alike; a name's bit tells whether it may be the left or the right one of a pair, so no two pairs overlap.
2. Whether a symbol is made depends on few words around it, which are noted as they grow (``low`` to ``high``). A window that holds them
   all has that symbol wherever it stands: equal windows have equal interior symbols.
3. After each Spark round a bit array of bounded size tells which names occur more than once in the corpus (a wrong bit only costs work).
   Windows with an interior symbol that is alone can't repeat; the stretches of text that hold the others are written for the next round.
4. A window that is left goes by its highest interior symbol, of several the one with the least name. Windows next to each other with one
   such symbol are a stretch. Stretches are dealt out by symbol, once for each slice of text and content, and compared as a whole by (symbol, digest of their
   words); the first occurrence of each is compared window by window with the symbol's other stretches. Symbols and words have independent
   64-bit digests, so that what counts as equal agrees in 128 bits.
5. Symbols with more than ``HOT_ROWS`` stretches aren't gathered: theirs are compared in aggregations and joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, materialise, mix64, slices_by_bytes, text_views

WINDOW = 20
ROUNDS = ((2,), (4,))  # levels that are counted in each Spark round
RUNS_BEFORE = (1, 3, 5)  # levels before whose pairs runs are named
ANCHOR_LEVEL = 4
HOT_ROWS = 1 << 20  # so many stretches of 100 bytes or so fit a task; no more than one symbol in as many rows has more
MOST_TABLE_BITS, MOST_BUCKET_BITS = 28, 18  # 32 MB of bits at most are sent to the executors
SLICE_BYTES = 1 << 20
_left, _right, _run, _base = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_inverse = np.uint64(pow(int(_base), -1, 1 << 64))


class Words:
    """The words of texts, one after another: two digests of each, and where its text begins and ends."""

    def __init__(self, texts: list[bytes]):
        self.lists = [t.split() for t in texts]  # of bytes: at \x20 and \x09-\x0D only
        flat = [w for each in self.lists for w in each]
        known: dict[bytes, int] = {}
        number = np.fromiter((known.setdefault(w, len(known)) for w in flat), dtype=np.int64, count=len(flat))
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, known)), dtype="<u8").reshape(-1, 2)
        self.name, self.code = digests[number, 0], digests[number, 1]
        self.sizes = np.array([len(w) for w in self.lists], dtype=np.int64)
        stop = np.cumsum(self.sizes)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.begin, self.end = (stop - self.sizes)[self.doc], stop[self.doc]

    @cached_property
    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            powers = np.full(len(self.code) + 1, _base)
            powers[0] = 1
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code * np.cumprod(powers)[:-1], dtype=np.uint64)])
            powers[1:] = _inverse
            return sums, np.cumprod(powers)

    def digest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words from a to before b."""
        sums, back = self._sums
        with np.errstate(over="ignore"):
            return mix64((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * _run)


class Level:
    """Symbols in order: names, the place of each one's first word, and the words that it depends on. Where it depends on what is beyond
    its text, ``low`` or ``high`` lie outside."""

    def __init__(self, name: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.name, self.at, self.low, self.high = name, at, low, high


def _beside(words: Words, s: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether the symbol before is of the same text, that one's low, the next one's high)."""
    doc = words.doc[s.at]
    before = np.zeros(len(s.at), dtype=bool)
    before[1:] = doc[1:] == doc[:-1]
    low, high = words.begin[s.at] - 1, words.end[s.at] + 1
    low[1:] = np.where(before[1:], s.low[:-1], low[1:])
    high[:-1] = np.where(before[1:], s.high[1:], high[:-1])
    return before, low, high


def named_runs(words: Words, s: Level) -> Level:
    """Runs of equal symbols become one; every symbol then depends on both neighbours, as they might have been equal."""
    if not len(s.at):
        return s
    before, low, high = _beside(words, s)
    head = ~before
    head[1:] |= s.name[1:] != s.name[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(head)) - 1
    n = (last - first + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        name = np.where(n > 1, mix64(s.name[first] ^ n * _run), s.name[first])
    return Level(name, s.at[first], low[first], high[last])


def named_pairs(words: Words, s: Level, level: int) -> Level:
    """Each left symbol before a right one becomes a pair with it."""
    if not len(s.at):
        return s
    before, low, high = _beside(words, s)
    with np.errstate(over="ignore"):
        right = mix64(s.name + np.uint64(level) * _left) >> np.uint64(63) == 1
        joined = np.zeros(len(right), dtype=bool)  # to the symbol before
        joined[1:] = before[1:] & ~right[:-1] & right[1:]
        pair = np.append(joined[1:], False)
        name = s.name.copy()
        at = np.flatnonzero(pair)
        name[at] = mix64(s.name[at] * _left + mix64(s.name[at + 1] + _right))
    new_low = np.where(right, low, s.low)
    new_high = np.where(right, s.high, high)  # of a pair: what its right one depends on
    keep = np.flatnonzero(~joined)
    return Level(name[keep], s.at[keep], new_low[keep], new_high[keep])


def levels(words: Words, most: int) -> Iterator[tuple[int, Level]]:
    """(number, symbols) of the levels 0 to ``most``. Runs aren't named before each level, as symbols then depend on more words; neighbours that are
    equal are of the same side and never pair."""
    place = np.arange(len(words.name))
    s = Level(words.name, place, place, place + 1)
    yield 0, s
    for k in range(1, most + 1):
        s = named_pairs(words, named_runs(words, s) if k in RUNS_BEFORE else s, k)
        yield k, s


def _inside(s: Level, words: Words) -> np.ndarray:
    """Symbols that some window determines."""
    return np.flatnonzero((s.high - s.low <= WINDOW) & (s.low >= words.begin[s.at]) & (s.high <= words.end[s.at]))


def _salted(name: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(name + np.uint64(level + 1) * _right)


def shared_names(df: DataFrame, counted: tuple[int, ...], total: int) -> np.ndarray:
    """Bit array, by the top bits, of the names of those levels that occur more than once."""
    table_bits = min(MOST_TABLE_BITS, max(16, int(total).bit_length()))
    bits = min(MOST_BUCKET_BITS, table_bits - 3, max(3, int(total / (16 << 20)).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(0), SLICE_BYTES):
                words = Words(list(text_views(batch.column(0).slice(a, b - a))))
                found = [_salted(s.name[_inside(s, words)], k) for k, s in levels(words, max(counted)) if k in counted]
                h, n = np.unique(np.concatenate(found), return_counts=True)
                h = np.repeat(h, np.minimum(n, 2))  # two tell as much as many
                bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                local = ((h << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
                edges = [*first.tolist(), len(h)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), pa.array([local[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary())], names=["bucket", "blob"])
            del batch
            give_back()

    def count(table: pa.Table) -> pa.Table:
        local, n = np.unique(np.frombuffer(b"".join(table.column("blob").to_pylist()), dtype="<u4"), return_counts=True)
        slot = local[n > 1] >> np.uint32(32 - (table_bits - bits))
        out = np.zeros(1 << (table_bits - bits), dtype=np.uint8)
        out[slot] = 1
        return pa.table({"bucket": table.column("bucket")[:1], "blob": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})

    kind = "bucket long, blob binary"
    table = np.zeros(1 << table_bits >> 3, dtype=np.uint8)
    step = len(table) >> bits
    for r in df.select("text").mapInArrow(deal, kind).groupBy("bucket").applyInArrow(count, kind).toLocalIterator():
        table[r["bucket"] * step : (r["bucket"] + 1) * step] = np.frombuffer(r["blob"], dtype=np.uint8)
    return table


def _alive(words: Words, table: np.ndarray, counted: tuple[int, ...]) -> np.ndarray:
    """Starts of windows all of whose interior symbols of those levels are shared."""
    shift = np.uint64(64 - (len(table) * 8 - 1).bit_length())
    change = np.zeros(len(words.name) + WINDOW + 1, dtype=np.int32)
    for k, s in levels(words, max(counted)):
        if k in counted:
            at = _inside(s, words)
            slot = (_salted(s.name[at], k) >> shift).astype(np.int64)
            alone = at[table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 0]
            np.add.at(change, np.maximum(s.high[alone] - WINDOW, words.begin[s.at[alone]]), 1)
            np.add.at(change, s.low[alone] + 1, -1)
    place = np.arange(len(words.name))
    return np.flatnonzero((np.cumsum(change)[: len(place)] == 0) & (place + WINDOW <= words.end))


def _stretches_of(words: Words, alive: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) places in ``alive`` of windows that follow each other in one text (and have one ``group``)."""
    new = np.ones(len(alive), dtype=bool)
    new[1:] = (np.diff(alive) != 1) | (words.doc[alive[1:]] != words.doc[alive[:-1]])
    if group is not None:
        new[1:] |= group[1:] != group[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(alive)) - 1 if len(first) else first


def _round(rows: DataFrame, counted: tuple[int, ...], size: int) -> DataFrame:
    """The stretches of text (id, digest, start, text) that hold windows which may repeat, as far as names of these levels tell."""
    shared = rows.sparkSession.sparkContext.broadcast(shared_names(rows, counted, size))  # 2^MOST_TABLE_BITS bits at most

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(3), SLICE_BYTES):
                part = batch.slice(a, b - a)
                words = Words(list(text_views(part.column(3))))
                alive = _alive(words, shared.value, counted)
                first, last = _stretches_of(words, alive)
                doc, x, y = words.doc[alive[first]], alive[first], alive[last] + WINDOW
                inner = x - words.begin[x] if len(x) else x
                texts = [b" ".join(words.lists[d][i : i + n]) for d, i, n in zip(doc.tolist(), inner.tolist(), (y - x).tolist())]
                start = part.column(2).to_numpy(zero_copy_only=False)[doc] + inner
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(texts, pa.binary())], names=["id", "digest", "start", "text"])
            del batch
            give_back()

    return rows.mapInArrow(keep, "id long, digest long, start long, text binary")


def _anchors(words: Words, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, place) of the highest interior symbol of each window, of several the one with the least salted name, and of equal ones the first."""
    name, place = np.zeros(len(alive), dtype=np.uint64), np.zeros(len(alive), dtype=np.int64)
    for k, s in levels(words, ANCHOR_LEVEL):
        if not len(s.at):
            continue
        salted = _salted(s.name, k)
        first, stop = np.searchsorted(s.low, alive), np.searchsorted(s.high, alive + WINDOW, side="right")
        fits = np.flatnonzero(first < stop)
        first, stop = first[fits], stop[fits]
        best = first.copy()
        for step in range(1, int((stop - first).max(initial=0))):
            at = np.minimum(first + step, stop - 1)
            best = np.where(salted[at] < salted[best], at, best)
        name[fits] = salted[best]
        place[fits] = s.at[best] * (ANCHOR_LEVEL + 1) + k
    return name, place


def _merged(own: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of one text that touch, as one; ends ascend with starts."""
    by = np.lexsort((end, start, text, own))
    own, text, start, end = own[by], text[by], start[by], end[by]
    head = np.ones(len(by), dtype=bool)
    head[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(by)) - 1 if len(first) else first
    return own[first], text[first], start[first], end[last]


def _firsts(place: tuple[np.ndarray, ...], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are the first of their two keys, in order; rows that are later ones). A row at the same place as the first isn't later."""
    own, text, start = place
    by = np.lexsort((start, text, own, b, a))
    same = np.zeros(len(by), dtype=bool)
    same[1:] = (a[by[1:]] == a[by[:-1]]) & (b[by[1:]] == b[by[:-1]])
    lead = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
    again = (own[by] != own[lead]) | (text[by] != text[lead]) | (start[by] != start[lead])
    return np.sort(by[~same]), by[same & again]


STRETCHES = "symbol long, id long, digest long, start long, end long, windows binary"  # end: of ranges that are repeats already
RANGES = "id long, digest long, start long, end long"


def _stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows by their interior symbol, with the digests of their windows. Of equal ones in a slice the first travels; the others
    are repeats already, and come as merged ranges without a symbol."""
    for batch in batches:
        for a, b in slices_by_bytes(batch.column(3), SLICE_BYTES):
            part = batch.slice(a, b - a)
            words = Words(list(text_views(part.column(3))))
            alive = np.flatnonzero(np.arange(len(words.name)) + WINDOW <= words.end)
            if not len(alive):
                continue
            name, symbol = _anchors(words, alive)
            first, last = _stretches_of(words, alive, symbol)
            x, y = alive[first], alive[last] + WINDOW
            doc, keys = words.doc[x], (name[first], words.digest(x, y))
            own, text, start = (part.column(i).to_numpy(zero_copy_only=False)[doc] for i in range(3))
            start = start + x - words.begin[x]
            new, later = _firsts((own, text, start), *keys)
            gone = _merged(*(v[later] for v in (own, text, start, start + y - x)))
            windows = words.digest(alive, alive + WINDOW).astype("<u8")
            none = [None] * len(gone[0])
            columns = [pa.array([*keys[0][new].astype(np.int64).tolist(), *none], pa.int64())]
            columns += [pa.array(np.concatenate([v[new], g]), pa.int64()) for v, g in zip((own, text, start), gone)]
            columns.append(pa.array([*[None] * len(new), *gone[3].tolist()], pa.int64()))
            columns.append(pa.array([*(windows[i : j + 1].tobytes() for i, j in zip(first[new].tolist(), last[new].tolist())), *none], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["symbol", "id", "digest", "start", "end", "windows"])
        del batch
        give_back()


def _settled(table: pa.Table) -> pa.Table:
    """Ranges of all stretches of some symbols that are repeats, as a whole or window by window. What has the same windows is the same stretch."""
    symbol, own, text, start = (table.column(c).to_numpy() for c in ("symbol", "id", "digest", "start"))
    blobs = table.column("windows").to_pylist()
    n = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
    known: dict[bytes, int] = {}
    content = np.fromiter((known.setdefault(b, len(known)) for b in blobs), dtype=np.int64, count=len(blobs))
    new, later = _firsts((own, text, start), symbol, content)
    window = np.frombuffer(b"".join(blobs[i] for i in new.tolist()), dtype="<u8")
    row = np.repeat(new, n[new])
    at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n[new]) - n[new], n[new])
    again = _firsts((own[row], text[row], at), symbol[row], window)[1]
    end = start + n + WINDOW - 1
    both = [np.concatenate([v[later], w[again]]) for v, w in ((own, own[row]), (text, text[row]), (start, at), (end, at + WINDOW))]
    return pa.table([pa.array(v, pa.int64()) for v in _merged(*both)], names=["id", "digest", "start", "end"])


def _settled_by_joins(stretches: DataFrame) -> DataFrame:
    """The same without gathering a symbol's stretches."""
    place = F.struct("id", "digest", "start")
    n = (F.octet_length("windows") / 8).cast("int")
    firsts = materialise(stretches.groupBy("symbol", "windows").agg(F.min(place).alias("first")), "firsts")
    later = stretches.join(firsts, ["symbol", "windows"]).where(place > F.col("first")).select("id", "digest", "start", (F.col("start") + n + WINDOW - 1).alias("end"))
    each = firsts.select("symbol", "first", "windows", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    at = F.struct("first.id", "first.digest", (F.col("first.start") + F.col("k")).alias("start"))
    each = materialise(each.select("symbol", F.substring("windows", F.col("k") * 8 + 1, F.lit(8)).alias("window"), at.alias("at")), "windows")
    least = each.groupBy("symbol", "window").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return later.unionByName(each.join(least, ["symbol", "window"]).where("at > least").select("at.id", "at.digest", "at.start", (F.col("at.start") + WINDOW).alias("end")))


def _hot(stretches: DataFrame) -> DataFrame:
    """(symbol) of those with more than ``HOT_ROWS`` stretches, counted one by one only where all of a symbol's first 16 bits together have so many."""
    head = F.shiftrightunsigned("symbol", 48)
    many = stretches.groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select("head")
    counted = stretches.withColumn("head", head).join(F.broadcast(many), "head", "left_semi").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))  # 2^16 rows at most
    return materialise(counted.where(F.col("n") > HOT_ROWS).select("symbol"), "hot")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, start, end): ranges of words that repeated windows cover, of the text of that id and digest; they may overlap."""
    rows = df.where(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= 2 * WINDOW - 1))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest"), F.lit(0).cast("long").alias("start"), F.col(text_col).cast("binary").alias("text"))
    for number, counted in enumerate(ROUNDS):
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        rows = _round(rows, counted, size)
        if number + 1 < len(ROUNDS):
            rows = materialise(rows, "round", "zstd")
    found = materialise(rows.mapInArrow(_stretched, STRETCHES), "stretches", "zstd")
    gone = found.where("symbol is null").select("id", "digest", "start", "end")
    stretches = found.where("symbol is not null")
    stretches = stretches.select("symbol", "id", "digest", "start", "windows")
    hot = _hot(stretches)
    buckets = max(1, stretches.count() // (1 << 16))
    cold = stretches.join(F.broadcast(hot), "symbol", "left_anti")  # one symbol in HOT_ROWS rows at most
    settled = cold.groupBy(F.pmod(F.xxhash64("symbol"), F.lit(buckets)).alias("bucket")).applyInArrow(_settled, RANGES)
    out = gone.unionByName(settled)
    if hot.take(1):
        out = out.unionByName(_settled_by_joins(stretches.join(F.broadcast(hot), "symbol", "left_semi")))
    return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans, kept) of every row: spans array of (start, end), the maximal runs of removed words; kept binary, the other words
    with one space between them.

    Words are what stands between spaces, tabs and line ends, byte by byte; a null text has none. Windows are judged on the input.
    Ids are integers. Rows with one id and the same text count as one document and don't make each other repeats; rows with one id and
    different texts are documents of their own, in the order of a hash of the text. A row with a null id loses nothing and makes
    nothing a repeat. What is gathered by document is in proportion to its own length."""
    ranges = materialise(repeats(df, id_col, text_col), "repeats")
    by_doc = ranges.groupBy("id", "digest").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    own = df.select(F.col(id_col).alias("own"), F.col(text_col).alias("text"))
    joined = own.join(by_doc, (F.col("own") == F.col("id")) & (F.xxhash64("text") == F.col("digest")), "left").select("own", "text", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for x, y in slices_by_bytes(batch.column(1)):
                part = batch.slice(x, y - x)
                sizes, spans, kept = [], [], []
                for text, starts, ends in zip(text_views(part.column(1)), part.column(2).to_pylist(), part.column(3).to_pylist()):
                    words, own, rest, at = text.split(), [], [], 0
                    for s, e in sorted(zip(starts or (), ends or ())):
                        if own and s <= own[-1]["end"]:
                            own[-1]["end"] = max(own[-1]["end"], e)
                        else:
                            own.append({"start": s, "end": e})
                    for o in own:
                        rest += words[at : o["start"]]
                        at = o["end"]
                    sizes.append(len(words))
                    spans.append(own)
                    kept.append(b" ".join(rest + words[at:]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())], names=[id_col, "n_words", "spans", "kept"])
            del batch
            give_back()

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(run, schema)

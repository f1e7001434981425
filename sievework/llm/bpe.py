"""Byte-level BPE encoding and decoding without regular expressions.

Text is turned into code points, and code points into symbols by one table lookup: classes, with white space and apostrophes told
apart by what follows them. The pattern is then a small automaton over symbols. Each symbol is a transition function on its states;
functions are composed over blocks of code points, the blocks' functions by an associative scan, and each block is walked from the
state that the scan gives it, all blocks side by side. A table tells for state and symbol whether a piece starts. Pieces then go
through a bounded cache in front of rank-ordered pair merging. Every token keeps the byte offset of its end, by which decoding
scatters the vocabulary's bytes to their places.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Numbers, int_lists, slices_by_bytes, text_views

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The endings that the pattern splits off after an apostrophe, longest first.
ENDINGS = ["re", "ve", "ll", "s", "t", "m", "d"]
CACHE_ENTRIES = 300_000
NONE = 1 << 60


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of each code point, from the general categories L* and N* and White_Space."""
    import regex

    table = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            a, b = m.start(), m.end()
            where = np.arange(a, b)
            table[where + np.where(where >= 0xD800, 0x800, 0)] = kind
    table[WHITE_SPACE] = SPACE
    return table


# Symbols: the classes; white space that the next white space follows or that ends a text; the last of a run before something else, as
# a plain space (it belongs to what follows) or not; an apostrophe with an ending of one or two letters after it.
RUN, GLUE, LAST, ONE, TWO = 3, 4, 5, 6, 7
# States: what comes next starts a piece; inside a run of letters, numbers, others or white space; after a plain space that belongs
# to what follows; one or two letters of an ending are still to come.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_RUN, AFTER_SPACE, LAST_LETTER, FIRST_LETTER = range(8)
BLOCK = 32  # groups of four symbols that a block has


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(next state by symbol and state, whether a piece starts there, state after four symbols by these and the state before)."""
    inside = {OTHER: IN_OTHERS, LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, RUN: IN_RUN}
    step, begins = np.zeros((8, 8), dtype=np.uint8), np.ones((8, 8), dtype=bool)
    for symbol in range(8):
        for state in range(8):
            if state in (LAST_LETTER, FIRST_LETTER):  # letters of an ending, which the symbol of its apostrophe has vouched for
                step[symbol, state], begins[symbol, state] = (FREE if state == LAST_LETTER else LAST_LETTER), False
            elif symbol in inside:
                step[symbol, state] = inside[symbol]
                begins[symbol, state] = state != inside[symbol] and not (state == AFTER_SPACE and symbol != RUN)
            elif symbol in (GLUE, LAST):
                step[symbol, state] = AFTER_SPACE if symbol == GLUE else FREE
            elif state in (IN_OTHERS, AFTER_SPACE):  # no ending where the apostrophe starts no piece
                step[symbol, state], begins[symbol, state] = IN_OTHERS, False
            else:
                step[symbol, state] = LAST_LETTER if symbol == ONE else FIRST_LETTER
    four = np.empty((4096, 8), dtype=np.uint8)
    for state in range(8):
        now = np.full(4096, state, dtype=np.uint8)
        for shift in (9, 6, 3, 0):
            now = step[np.arange(4096) >> shift & 7, now]
        four[:, state] = now
    return step.ravel(), begins.ravel(), four.ravel()


def symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = len(points)
    out = class_table()[points]
    blank = out == SPACE
    at = np.flatnonzero(blank[:-1] & ~blank[1:])
    last = np.zeros(n, dtype=bool)
    last[starts[1:] - 1] = True
    at = at[~last[at]]  # a run of white space that reaches its text's end is a piece as it is
    out[at] = np.where(points[at] == 0x20, GLUE, LAST)
    quotes = np.flatnonzero(points[:-1] == 0x27)
    if len(quotes):
        limit = np.append(starts[1:], n)[np.searchsorted(starts, quotes, side="right") - 1]
        for ending in ENDINGS:
            fits = (quotes + len(ending) < limit) & (out[quotes] == OTHER)
            for j, ch in enumerate(ending):
                fits &= points[np.minimum(quotes + 1 + j, n - 1)] == ord(ch)
            out[quotes[fits]] = ONE if len(ending) == 1 else TWO
    return out


def piece_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions in ``points`` at which a piece starts; ``starts`` holds each text's first position (of texts that aren't empty).

    Pieces never cross a text's start: the automaton gets a symbol before each text that leaves no state but the first."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    step, begins, four = automaton()
    own = np.insert(symbols(points, starts), starts, LAST)
    width = 4 * BLOCK
    padded = np.zeros(-(-len(own) // width) * width, dtype=np.uint8)
    padded[: len(own)] = own
    rows = padded.reshape(-1, 4)
    fours = (rows[:, 0].astype(np.uint16) << 9 | rows[:, 1].astype(np.uint16) << 6 | rows[:, 2] << 3 | rows[:, 3]).reshape(-1, BLOCK).astype(np.int32) << 3
    # Each block's function, by composing its groups' functions; columns are the states before.
    function = np.tile(np.arange(8, dtype=np.uint8), (len(fours), 1))
    for k in range(BLOCK):
        function = four[fours[:, k, None] | function]
    # Associative scan over blocks: after the round of distance d, a row holds the function of its last 2 d blocks.
    distance = 1
    while distance < len(function):
        before = function[:-distance]
        function = np.concatenate([function[:distance], np.take_along_axis(function[distance:], before, axis=1)])
        distance *= 2
    state = np.concatenate([np.zeros(1, dtype=np.uint8), function[:-1, FREE]])
    entry = np.empty(fours.shape, dtype=np.uint8)
    for k in range(BLOCK):
        entry[:, k] = state
        state = four[fours[:, k] | state]
    state = entry.ravel()
    out = np.empty(rows.shape, dtype=bool)
    for k in range(4):
        key = rows[:, k] << 3 | state
        out[:, k] = begins[key]
        state = step[key]
    kept = np.ones(len(own), dtype=bool)
    kept[starts + np.arange(len(starts))] = False
    return np.flatnonzero(out.ravel()[: len(own)][kept])


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank is merged first, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n > 48:
        return _merge_long(piece, ranks)
    cuts = list(range(n + 1))
    none = 1 << 60
    get = ranks.get
    order = [get(piece[i : i + 2], none) for i in range(n - 1)]
    while order:
        low = min(order)
        if low == none:
            break
        i = order.index(low)
        del cuts[i + 1]
        del order[i]
        if i < len(order):
            order[i] = get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            order[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n, for very long pieces."""
    n = len(piece)
    right = list(range(1, n + 1))  # start -> end of the part
    left = list(range(-1, n - 1))  # start -> start of the part before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or right[i] >= n or right[right[i]] != end:
            continue
        gone = right[i]
        alive[gone] = False
        right[i] = end
        if end < n:
            left[end] = i
            if (r := ranks.get(piece[i : right[end]])) is not None:
                heapq.heappush(heap, (r, i, right[end]))
        if (b := left[i]) >= 0 and (r := ranks.get(piece[b:end])) is not None:
            heapq.heappush(heap, (r, b, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : right[i]]])
        i = right[i]
    return out


def pieces_of_texts(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(pieces of all texts, how many each text has, byte at which each text begins and ends among all)."""
    joined = b"".join(texts)
    points = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), dtype="<u4")
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    at = np.zeros(len(points) + 1, dtype=np.int64)  # byte offset of each code point
    np.cumsum(width, out=at[1:])
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    starts = np.searchsorted(at, begins[sizes > 0])
    cuts = at[piece_starts(points, starts)]
    counts = np.searchsorted(cuts, ends) - np.searchsorted(cuts, begins)
    edges = cuts.tolist()
    return [joined[a:b] for a, b in zip(edges, [*edges[1:], len(joined)])], counts, begins, ends


class Codec:
    """Encoder and decoder over one file of ranks (lines of base64 bytes and rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        pairs = {(x, y): r for w, r in self.ranks.items() for i in range(1, len(w)) if (x := self.ranks.get(w[:i])) is not None and (y := self.ranks.get(w[i:])) is not None}
        keys = np.array([x << 20 | y for x, y in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(pairs.values()), dtype=np.int64)[order]
        self.numbers = Numbers(CACHE_ENTRIES)
        self.store = np.zeros(0, dtype=np.uint32)
        self.store_at, self.store_n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def _merge_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """merge_piece() for many pieces at once: each step merges every piece's pair of lowest rank, leftmost first."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        waiting: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = np.array([whole], dtype=np.uint32)
            elif len(piece) > 48:
                out[k] = np.array(merge_piece(piece, self.ranks), dtype=np.uint32)
            else:
                waiting.setdefault(-(-len(piece) // 4) * 4, []).append(k)
        for width, rows in waiting.items():
            m = len(rows)
            raw = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in rows), dtype=np.uint8).reshape(m, width)
            size = np.array([len(pieces[k]) for k in rows])
            ids = np.full((m, width + 1), -1, dtype=np.int64)
            ids[:, :-1] = np.where(np.arange(width) < size[:, None], self.single[raw], -1)
            after = np.tile(np.arange(1, width + 2), (m, 1))
            ahead = np.tile(np.arange(-1, width), (m, 1))
            rank = np.full((m, width + 1), NONE, dtype=np.int64)
            both = ids[:, 1:] >= 0
            rank[:, :-1][both] = self._rank_of(ids[:, :-1][both], ids[:, 1:][both])
            r = np.arange(m)
            while True:
                j = rank[r].argmin(axis=1) if len(r) < m else rank.argmin(axis=1)
                low = rank[r, j]
                on = low < NONE
                r, j, low = r[on], j[on], low[on]
                if not len(r):
                    break
                k = after[r, j]
                n = after[r, k]
                ids[r, j] = low
                ids[r, k] = -1
                rank[r, k] = NONE
                after[r, j] = n
                ok = n <= width
                ahead[r[ok], n[ok]] = j[ok]
                nxt = np.where(ok, ids[r, np.minimum(n, width)], -1)
                rank[r, j] = NONE
                w = nxt >= 0
                rank[r[w], j[w]] = self._rank_of(low[w], nxt[w])
                p = ahead[r, j]
                w = p >= 0
                rank[r[w], p[w]] = self._rank_of(ids[r[w], p[w]], low[w])
            alive = ids >= 0
            flat = ids[alive].astype(np.uint32)
            for k, part in zip(rows, np.split(flat, np.cumsum(alive.sum(axis=1))[:-1])):
                out[k] = part
        return out

    def _pieces(self, slots: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each piece)."""
        which = self.numbers.numbered(slots)
        if self.numbers.fresh:
            found = self._merge_many(self.numbers.fresh)
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            self.store_at = np.concatenate([self.store_at, len(self.store) + np.cumsum(sizes) - sizes])
            self.store_n = np.concatenate([self.store_n, sizes])
            self.store = np.concatenate([self.store, *found])
        count = self.store_n[which]
        ends = np.cumsum(count)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.store_at[which] - (ends - count), count)
        ids = self.store[take]
        stay = self.numbers.settle()
        if stay < len(self.store_n):
            self.store_at, self.store_n = self.store_at[:stay], self.store_n[:stay]
            self.store = self.store[: int(self.store_at[-1] + self.store_n[-1])].copy() if stay else self.store[:0]
        return ids, count

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, end of each text among them, byte offset of each token's end in its text)."""
        slots, _, begins, ends = pieces_of_texts(texts)
        ids, _ = self._pieces(slots)
        token_ends = np.cumsum(self.lengths[ids])  # in the joined bytes
        text_ends = np.searchsorted(token_ends, ends, side="right")
        text_ends = np.where(ends > 0, text_ends, 0)
        offsets = token_ends - np.repeat(begins, np.diff(text_ends, prepend=0))
        return ids, text_ends, offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        """Bytes of the ids: each token's bytes are scattered to the place before its offset (a running sum of lengths, if not given)."""
        if not len(ids):
            return b""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        within = np.arange(ends[-1])
        out = np.empty(len(within) if offsets is None else int(offsets[-1]), dtype=np.uint8)
        place = within if offsets is None else within + np.repeat(offsets - ends, size)
        out[place] = self.bytes[within + np.repeat(self.places[ids] - (ends - size), size)]
        return out.tobytes()


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: (id, ids array<int>, offsets array<int>: the byte offset at which each token ends).

    A null text counts as empty and gives two empty arrays. Rows are independent: repeated rows give repeated results, other
    columns are not read. ``path`` must exist on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1)):
                part = batch.slice(a, b - a)
                ids, ends, offsets = c.encode(list(text_views(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), int_lists(ids.astype(np.int32), ends), int_lists(offsets.astype(np.int32), ends)], names=[id_col, "ids", "offsets"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", offsets_col: str | None = "offsets") -> DataFrame:
    """Bytes of every id list, placed by the offsets that ``encode`` kept, or by the tokens' lengths where ``offsets_col`` is None: (id, ids,
    decoded binary). A null or empty list gives empty bytes; offsets must rise by the lengths of their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        numbers = lambda x: x.values.to_numpy(zero_copy_only=False).astype(np.int64)
        for batch in batches:
            lists = batch.column(1)
            places = batch.column(2) if offsets_col else [None] * batch.num_rows
            out = [c.decode(numbers(x), numbers(y) if offsets_col else None) if x.is_valid else b"" for x, y in zip(lists, places)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(out, type=pa.binary())], names=[id_col, "ids", "decoded"])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    return df.select(id_col, ids_col, *([offsets_col] if offsets_col else [])).mapInArrow(run, schema)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode again by the offsets kept, and digest both: (id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Nulls and empty texts have no token and the digests of no bytes; repeated rows give repeated results; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1)):
                ids, ends, offsets = c.encode(list(text_views(batch.column(1).slice(a, b - a))))
                sizes, left, right = np.diff(ends, prepend=0), [], []
                for end, n in zip(ends.tolist(), sizes.tolist()):
                    own = ids[end - n : end]
                    left.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    right.append(hashlib.sha256(c.decode(own, offsets[end - n : end])).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(left, pa.string()), pa.array(right, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return df.select(id_col, text_col).mapInArrow(run, schema)

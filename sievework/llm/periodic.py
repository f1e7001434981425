"""Periodic runs of words by a harmonic grid of longest common extensions.

A run is a stretch of words that are equal to those ``period`` words later, as long as it can be, and at least ``EXPONENT`` periods long.

1. The words of a batch's documents get numbers. One suffix array over all of them, in which documents never mix, is refined by doubling
   (only suffixes that are still tied are sorted again); a second one is that of the reversed words.
2. Common prefixes of neighbours are compared in full only where the words before differ; elsewhere they are one less than those of the
   place before. Minima over ranges of them are longest common extensions, forwards and, in the reversed array, backwards.
3. For each period p the places jp and (j+1)p are compared. Equal words ``EXPONENT`` - 1 periods long hold that many multiples of p in a
   row, so every (``EXPONENT`` - 1)-th j is enough. Extensions both ways give the whole stretch.
4. A stretch found with several periods has the smallest as its period: it is long enough that any other one is a multiple.

All of it happens within a document; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Numbers, give_back, slices_by_bytes, text_views

EXPONENT, LEAST = 4, 6
BLOCK = 16
AT_ONCE = 1 << 20  # places of the grid in memory at a time
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


class RangeMinimum:
    """Least value of any range: in blocks of ``BLOCK`` values from both ends, and by doubling over the blocks' minima."""

    def __init__(self, values: np.ndarray):
        blocks = max(1, -(-len(values) // BLOCK))
        self.values = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        self.values[: len(values)] = values
        square = self.values.reshape(blocks, BLOCK)
        self.head = np.minimum.accumulate(square, axis=1).ravel()
        self.tail = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [square.min(axis=1)]
        while 2 << len(self.levels) - 1 <= blocks:
            below, step = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of the values a .. b (both included, a <= b)."""
        out = np.empty(len(a), dtype=np.int32)
        x, y = a // BLOCK, b // BLOCK
        same = np.flatnonzero(x == y)
        best = self.values[a[same]]
        for k in range(1, BLOCK):
            best = np.minimum(best, self.values[np.minimum(a[same] + k, b[same])])
        out[same] = best
        other = np.flatnonzero(x != y)
        out[other] = np.minimum(self.tail[a[other]], self.head[b[other]])
        wide = other[y[other] - x[other] > 1]
        first, n = x[wide] + 1, y[wide] - x[wide] - 1
        level = np.frexp(n.astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            low = np.minimum(self.levels[k][first[at]], self.levels[k][first[at] + n[at] - (1 << k)])
            out[wide[at]] = np.minimum(out[wide[at]], low)
        return out


class Extensions:
    """Longest common extensions within documents. ``words``: numbers; ``ends``: the end of each place's document."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.words, self.ends = words, ends
        order = self._sorted()
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.least = RangeMinimum(self._prefixes(order))

    def _sorted(self) -> np.ndarray:
        n = len(self.words)
        key = self.ends * (int(self.words.max()) + 1) + self.words if n else self.words
        order = np.argsort(key, kind="stable")
        key = key[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else np.zeros(0, dtype=np.int64)
        rank = np.empty(n, dtype=np.int64)  # of a group: the place of its first member
        rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
        tied, depth = np.arange(n), 1
        while True:
            size = np.bincount(rank[order[tied]], minlength=1) if len(tied) else np.zeros(1, dtype=np.int64)
            tied = tied[size[rank[order[tied]]] > 1]
            if not len(tied):
                return order
            own = order[tied]
            after = own + depth
            second = np.where(after < self.ends[own], rank[np.minimum(after, n - 1)] + 1, 0)  # what ends comes first
            group = rank[own]
            by = np.argsort(group * (n + 1) + second, kind="stable")
            own, second, group = own[by], second[by], group[by]
            order[tied] = own
            heads = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])]))
            rank[own] = np.repeat(tied[heads], np.diff(np.append(heads, len(own))))
            depth *= 2

    def _prefixes(self, order: np.ndarray) -> np.ndarray:
        n = len(order)
        out = np.zeros(n, dtype=np.int32)
        if n < 2:
            return out
        before = np.full(n, -1, dtype=np.int64)
        before[order[1:]] = order[:-1]
        before[(before >= 0) & (self.ends[before] != self.ends)] = -1
        place = np.arange(n)
        # the word before is the same in both, and in the same document
        follows = (before > 0) & (place > 0)
        follows[1:] &= (self.ends[1:] == self.ends[:-1]) & (self.words[before[1:] - 1] == self.words[:-1]) & (self.ends[before[1:] - 1] == self.ends[1:])
        full = np.flatnonzero(~follows)
        value = np.zeros(n, dtype=np.int64)
        has = full[before[full] >= 0]
        value[has] = self._common(has, before[has])
        source = np.maximum.accumulate(np.where(follows, 0, place))
        value = value[source] - (place - source)
        out[self.rank] = np.maximum(value, 0)
        return out

    def _common(self, a: np.ndarray, b: np.ndarray, steps: int = 32) -> np.ndarray:
        """Words in common from a and from b on, compared one by one, and the few long ones in pieces that double."""
        most = self.ends[a] - np.maximum(a, b)
        out = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        for k in range(steps):
            live = live[most[live] > k]
            live = live[self.words[a[live] + k] == self.words[b[live] + k]]
            out[live] = k + 1
        for i in live.tolist():
            x, y, done, step = int(a[i]), int(b[i]), steps, 64
            while done < most[i]:
                m = min(step, int(most[i]) - done)
                differ = np.flatnonzero(self.words[x + done : x + done + m] != self.words[y + done : y + done + m])
                if len(differ):
                    done += int(differ[0])
                    break
                done, step = done + m, step * 2
            out[i] = done
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common from a and from b on, of different places of one document."""
        x, y = self.rank[a], self.rank[b]
        return self.least(np.minimum(x, y) + 1, np.maximum(x, y)).astype(np.int64)


def _grid(sizes: np.ndarray, stride: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place in it, period) of the grid over documents of so many words, at most about ``AT_ONCE`` at a time."""
    periods = sizes // EXPONENT
    doc = np.repeat(np.arange(len(sizes)), periods)
    p = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    count = (sizes[doc] - p - 1) // (stride * p) + 1
    total = np.cumsum(count)
    cuts = np.flatnonzero(np.diff((total - 1) // AT_ONCE, prepend=-1)).tolist() if len(doc) else []
    for a, b in zip(cuts, [*cuts[1:], len(doc)]):
        n = count[a:b]
        period = np.repeat(p[a:b], n)
        yield np.repeat(doc[a:b], n), (np.arange(len(period)) - np.repeat(np.cumsum(n) - n, n)) * stride * period, period


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period."""
    stop = np.cumsum(sizes)
    base = stop - sizes
    ends = np.repeat(stop, sizes)
    forward = Extensions(words, ends)
    backward = Extensions(words[::-1], np.repeat((len(words) - base)[::-1], sizes[::-1]))
    found = []
    for doc, x, p in _grid(sizes, EXPONENT - 1):
        x = x + base[doc]
        hit = np.flatnonzero(words[x] == words[x + p])
        doc, x, p = doc[hit], x[hit], p[hit]
        ahead = forward(x, x + p)
        inner = np.flatnonzero(x > base[doc])
        behind = np.zeros(len(x), dtype=np.int64)
        behind[inner] = backward(len(words) - x[inner], len(words) - (x[inner] + p[inner]))  # from the words before x and x + p
        start, length = x - behind, behind + p + ahead
        whole = length >= np.maximum(LEAST, EXPONENT * p)
        found.append(np.stack([doc, start, length, p])[:, whole])
    doc, start, length, p = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    by = np.lexsort((p, length, start))
    doc, start, length, p = doc[by], start[by], length[by], p[by]
    first = np.ones(len(by), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, p = doc[first], start[first], length[first], p[first]
    by = np.lexsort((p, start))
    return doc[by], start[by] - base[doc[by]], length[by], p[by]


def _batch(texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int, int]]], list[bytes]]:
    lists = [t.split() for t in texts]  # of bytes: at \x20 and \x09-\x0D only
    sizes = np.array([len(w) for w in lists], dtype=np.int64)
    words = Numbers(1 << 62).numbered([w for each in lists for w in each])
    doc, start, length, period = find_runs(words, sizes)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    runs, kept = [], []
    for i, each in enumerate(lists):
        a, b = edges[i], edges[i + 1]
        runs.append(list(zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())))
        if a < b:
            gone = np.zeros(len(each) + 1, dtype=np.int64)
            np.add.at(gone, start[a:b] + period[a:b], 1)
            np.add.at(gone, start[a:b] + length[a:b], -1)
            each = [each[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        kept.append(b" ".join(each))
    return sizes.tolist(), runs, kept


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs array of (start, length, period), kept binary) of every row.

    Words are what stands between spaces, tabs and line ends. Runs come by start and period; ``kept`` has, one space between them, the
    words that no run contains after its first period. A null or empty text has no words and no runs. Repeated rows get the same result
    each, null ids as well; texts that aren't UTF-8 are taken byte by byte. Other columns are not looked at."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1), 1 << 20):
                part = batch.slice(a, b - a)
                sizes, found, kept = _batch(list(text_views(part.column(1))))
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.array([r for f in found for r in f], dtype=np.int64).reshape(-1, 3)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], RUN.names)).cast(kind)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), lists, pa.array(kept, pa.binary())], names=[id_col, "n_words", "runs", "kept"])
            del batch
            give_back()

    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("kept", T.BinaryType())])
    return df.select(id_col, text_col).mapInArrow(each, schema)

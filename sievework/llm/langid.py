"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, by the forward algorithm; pieces don't cross words, so a text's log-probability is the sum over its
words, and each distinct word is scored once. The piece probabilities are fitted by expectation maximisation on the word counts
of a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Numbers, forget, give_back, mix64, sent_text, slices_by_bytes, text_views, whole_rows
from .sampling import bounded_rows

#: Documents of each language that the model is fitted on, at most about.
SAMPLE_DOCS = 400
ROUNDS = 4
#: Characters of a piece, the word mark included; a vocabulary with longer ones is refused.
LONGEST = 16
#: Longer runs of letters are scored with a window over the last places only, and scaled on the way.
WORD_CHARS = 40
#: Letters scored at once, times languages.
SCORED_AT_ONCE = 400_000
#: Bytes of texts read at once.
SLICE_BYTES = 1 << 20
CACHE_ENTRIES = 200_000
SLOT_BITS = 20
_letters = regex.compile(r"\p{L}+")
_base = np.uint64(0x9E3779B97F4A7C15)


def words_of(chunk: bytes) -> list[str]:
    """The runs of letters (general category L) of a piece of text, in lower case, marked as word starts."""
    return ["▁" + run.lower() for run in _letters.findall(chunk.decode("utf-8", "replace"))]


def vocabulary(path: str) -> list[str]:
    """The distinct pieces, in lower case, of letters with or without the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    found = sorted(p for p in pieces if regex.fullmatch("▁?\\p{L}*", p) and p)
    if max(map(len, found), default=0) > LONGEST:
        raise ValueError(f"a piece of {path} has more than {LONGEST} characters")
    return found


@dataclass
class Lattice:
    """All places of pieces in a list of words: edge e spans start..end of word ``word``; number -1 is an unknown character."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    longest: int
    count: int
    length: np.ndarray

    def by_end(self) -> list[np.ndarray]:
        order = np.argsort(self.end, kind="stable")
        return np.split(order, np.searchsorted(self.end[order], np.arange(1, self.longest + 1)))[1:]


class Pieces:
    """Looks up pieces in words by hash."""

    def __init__(self, pieces: list[str]):
        self.hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        slots = (self.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.size = len(pieces)
        order = np.argsort(slots, kind="stable")
        self.order, self.slots = order, np.searchsorted(slots[order], np.arange((1 << SLOT_BITS) + 1))
        self.deepest = int(np.diff(self.slots).max(initial=0))
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def _hash(piece: str) -> int:
        codes = mix64(np.frombuffer(piece.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1))
        running, power = np.zeros(1, dtype=np.uint64), np.uint64(1)
        with np.errstate(over="ignore"):
            for code in codes:
                running += code * power
                power = power * (_base | np.uint64(1))
            return int(mix64(running + np.uint64(len(piece)))[0])

    def lattice(self, words: list[str]) -> Lattice:
        joined = "".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        length = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), length)
        within = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        room = length[word] - within
        # hashes relative to the start of each substring, by Horner's rule over its length
        codes = mix64(points.astype(np.uint64) + np.uint64(1))
        running = np.zeros(len(points), dtype=np.uint64)
        power = np.uint64(1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        covered = np.zeros(len(points), dtype=bool)
        at = np.arange(len(points))
        with np.errstate(over="ignore"):
            for n in range(1, self.longest + 1):
                at = at[room[at] >= n]
                if not len(at):
                    break
                running[at] += codes[at + n - 1] * power
                power = power * (_base | np.uint64(1))
                h = mix64(running[at] + np.uint64(n))
                slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                for depth in range(self.deepest):
                    i = self.slots[slot] + depth
                    ok = i < self.slots[slot + 1]
                    piece = self.order[np.where(ok, i, 0)]
                    hit = ok & (self.hashes[piece] == h)
                    if hit.any():
                        found.append((at[hit], np.full(int(hit.sum()), n), piece[hit]))
                        if n == 1:
                            covered[at[hit]] = True
        rest = np.flatnonzero(~covered)
        found.append((rest, np.ones(len(rest), dtype=np.int64), np.full(len(rest), -1)))
        p, n, piece = (np.concatenate(x) for x in zip(*found))
        return Lattice(word[p], within[p], within[p] + n, piece, int(length.max(initial=0)), len(words), length)


def forward(lat: Lattice, logs: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Log-probability of each word under each column of ``logs`` (pieces x languages), summed over all segmentations."""
    k = logs.shape[1]
    value = np.where((lat.piece >= 0)[:, None], np.exp(logs[np.maximum(lat.piece, 0)]), np.exp(unknown)[None])
    alpha = np.zeros((lat.longest + 1, lat.count, k))
    alpha[0] = 1.0
    for end, edges in enumerate(lat.by_end(), 1):
        w = lat.word[edges]
        flow = alpha[lat.start[edges], w] * value[edges]
        for c in range(k):
            alpha[end, :, c] = np.bincount(w, weights=flow[:, c], minlength=lat.count)
    out = alpha[lat.length, np.arange(lat.count)]
    return np.log(np.maximum(out, 1e-300))


def forward_long(lat: Lattice, logs: np.ndarray, unknown: np.ndarray, longest: int) -> np.ndarray:
    """The same for words of any length: only the last ``longest`` places are kept, and values are scaled before they get too small."""
    k = logs.shape[1]
    value, miss = np.exp(logs), np.exp(unknown)
    window = np.zeros((longest + 1, lat.count, k))
    window[0] = 1.0
    scale, out = np.zeros((lat.count, k)), np.zeros((lat.count, k))
    for end, edges in enumerate(lat.by_end(), 1):
        w, piece = lat.word[edges], lat.piece[edges]
        flow = window[lat.start[edges] % (longest + 1), w] * np.where((piece >= 0)[:, None], value[np.maximum(piece, 0)], miss[None])
        now = np.zeros((lat.count, k))
        np.add.at(now, w, flow)
        window[end % (longest + 1)] = now
        low = (now < 1e-150) & (now > 0)
        if low.any():
            window[:, low] *= 1e150
            scale[low] -= 150 * np.log(10)
        done = np.flatnonzero(lat.length == end)
        out[done] = np.log(np.maximum(window[end % (longest + 1), done], 1e-300)) + scale[done]
    return out


def _fit(lat: Lattice, counts: np.ndarray, size: int, rounds: int) -> tuple[np.ndarray, float]:
    """Piece log-probabilities of one language by expectation maximisation over all segmentations of its words."""
    known = lat.piece >= 0
    theta = np.bincount(lat.piece[known], weights=counts[lat.word[known]], minlength=size) + 0.01
    unknown = 1e-6
    ends = lat.by_end()
    starts_order = np.argsort(lat.start, kind="stable")
    starts = np.split(starts_order, np.searchsorted(lat.start[starts_order], np.arange(lat.longest)))[1:]
    for _ in range(rounds):
        theta = theta / theta.sum()
        value = np.where(known, theta[np.maximum(lat.piece, 0)], unknown)
        alpha = np.zeros((lat.longest + 1, lat.count))
        alpha[0] = 1
        for end, edges in enumerate(ends, 1):
            alpha[end] = np.bincount(lat.word[edges], weights=alpha[lat.start[edges], lat.word[edges]] * value[edges], minlength=lat.count)
        total = np.maximum(alpha[lat.length, np.arange(lat.count)], 1e-300)
        beta = np.zeros((lat.longest + 1, lat.count))
        beta[lat.length, np.arange(lat.count)] = 1
        for start in range(lat.longest - 1, -1, -1):
            edges = starts[start]
            beta[start] += np.bincount(lat.word[edges], weights=beta[lat.end[edges], lat.word[edges]] * value[edges], minlength=lat.count)
        expected = counts[lat.word] * alpha[lat.start, lat.word] * value * beta[lat.end, lat.word] / total[lat.word]
        theta = np.bincount(lat.piece[known], weights=expected[known], minlength=size) + 0.01
    return np.log(theta / theta.sum()), float(np.log(unknown))


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    logs: np.ndarray  # pieces x languages
    unknown: np.ndarray


def fit(df: DataFrame, path: str, lang_col: str = "lang", key: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample_docs`` labelled rows of each language. Rows without text or label don't count;
    without any labelled row the model knows no language."""
    rows = bounded_rows(df.where(F.col(text_col).isNotNull()), lang_col, key, sample_docs, None)
    counts: dict[str, Counter] = {}
    for r in rows.select(lang_col, F.split(F.col(text_col), r"\s+").alias("w")).select(lang_col, F.explode("w").alias("w")).groupBy(lang_col, "w").count().toLocalIterator():
        own = counts.setdefault(r[0], Counter())
        for word in words_of(r["w"].encode()):
            for i in range(0, len(word), WORD_CHARS):  # in the sample, long runs in parts
                own[word[i : i + WORD_CHARS]] += r["count"]
    pieces = vocabulary(path)
    found, logs, unknown = Pieces(pieces), [], []
    languages = sorted(x for x in counts if counts[x])
    for language in languages:
        own = counts[language]
        theta, miss = _fit(found.lattice(list(own)), np.array(list(own.values()), dtype=float), len(pieces), ROUNDS)
        logs.append(theta)
        unknown.append(miss)
    return Model(languages, pieces, np.array(logs).T.reshape(len(pieces), len(languages)), np.array(unknown))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.pieces)
        self.numbers = Numbers(CACHE_ENTRIES)
        self.values = np.zeros((0, len(self.model.languages)))
        self.lettered = np.zeros(0, dtype=bool)

    def _look_up(self, chunks: list[bytes]) -> None:
        words = [words_of(c) for c in chunks]
        each = np.array([len(w) for w in words], dtype=np.int64)
        value = np.zeros((len(chunks), len(self.model.languages)))
        flat = [x for w in words for x in w]
        owner = np.repeat(np.arange(len(chunks)), each)
        length = np.array([len(x) for x in flat], dtype=np.int64)
        at_once = max(1, SCORED_AT_ONCE // max(1, value.shape[1]))
        for long in (False, True):
            own = np.flatnonzero((length > WORD_CHARS) == long)
            own = own[np.argsort(length[own], kind="stable")]
            cuts = np.flatnonzero(np.diff(np.cumsum(length[own]) // at_once, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                lattice = self.pieces.lattice([flat[i] for i in own[a:b].tolist()])
                if long:
                    scores = forward_long(lattice, self.model.logs, self.model.unknown, self.pieces.longest)
                else:
                    scores = forward(lattice, self.model.logs, self.model.unknown)
                for c in range(value.shape[1]):
                    value[:, c] += np.bincount(owner[own[a:b]], weights=scores[:, c], minlength=len(chunks))
        self.values = np.concatenate([self.values, value])
        self.lettered = np.concatenate([self.lettered, each > 0])

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(best language's number or -1, its share of the probability) of each text."""
        chunks: list[bytes] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            found = text.split()
            counts[i] = len(found)
            chunks += found
        which = self.numbers.numbered(chunks)
        if self.numbers.fresh:
            self._look_up(self.numbers.fresh)
        k = len(self.model.languages)
        values, has_letters = self.values, self.lettered
        stay = self.numbers.settle()
        if stay < len(values):
            self.values, self.lettered = values[:stay].copy(), has_letters[:stay].copy()
        doc = np.repeat(np.arange(len(texts)), counts)
        lettered = np.bincount(doc, weights=has_letters[which], minlength=len(texts)) > 0
        if not k:
            return np.full(len(texts), -1), np.zeros(len(texts))
        total = np.stack([np.bincount(doc, weights=values[which, c], minlength=len(texts)) for c in range(k)], axis=1)
        best = total.argmax(axis=1)
        share = 1 / np.exp(np.clip(total - total.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
        return np.where(lettered, best, -1), np.where(lettered, share, 0.0)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, lang_pred, score): the likeliest language of every whole text and its posterior share, 0 to 1; if ``whole``, a struct ``row``
    of all columns stands in the id's place.

    ``und`` with score 0 where the text is null or has no letter, or the model knows no language. Equal scores go to the language
    first in alphabetical order. Only the text decides; repeated rows give repeated results."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # pieces x languages numbers: bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(shared.value)
        names = np.array([*scorer.model.languages, "und"], dtype=object)
        for batch in batches:
            texts = sent_text(batch, text_col, whole)
            for a, b in slices_by_bytes(texts, SLICE_BYTES):
                best, share = scorer.score(list(text_views(texts.slice(a, b - a))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names[best], pa.string()), pa.array(share, pa.float64())], names=[sent[0].name, "lang_pred", "score"])
            del batch, texts
            give_back()

    rows, sent = whole_rows(df, id_col, text_col, whole)
    return rows.mapInArrow(run, T.StructType([*sent, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))

"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist for documents only. A document is toxic if any of its tokens is, and which ones are is left open: the field is fitted on
the probability that it gives to the documents' labels, which is exact, as the path without a toxic token is one path:

    P(clean) = exp(score of that path) / Z.

So a clean document pushes all its tokens' marginals down, and a toxic one pushes them up in proportion to themselves, by P(clean) / P(toxic):
the tokens that explain the label win. Tokens have features of their word, its beginning and end, the letters in it, its shape and length, and
of the words beside it, in hashed slots. Forward-backward marginals give the offending places, and a logistic model over
their aggregates the document's score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Numbers, forget, give_back, sent_text, slices_by_bytes, text_views, whole_rows
from .sampling import bounded_rows

#: Labelled documents of either kind that the model is fitted on, at most about, and the bytes of their texts.
SAMPLE_DOCS, SAMPLE_BYTES = 1_500, 32 << 20
SLOTS = 1 << 17  # of hashed features
STEPS, RATE, RIDGE = 30, 0.08, 2e-5
CACHE_ENTRIES = 100_000
SLICE_BYTES = 1 << 19  # of texts read at once
_letters = re.compile(r"[^\W\d_]+")
_blank = np.zeros(256, dtype=bool)
_blank[[9, 10, 11, 12, 13, 32]] = True


def word_of(chunk: bytes) -> str:
    return "".join(_letters.findall(chunk.decode("utf-8", "replace"))).lower()


def unlike(texts: list[bytes]) -> np.ndarray:
    """Rows of a sorted sample without its copies and near copies: those whose least three-word hashes nobody before had."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for i, text in enumerate(texts):
        words = text.split()
        hashes = {zlib.crc32(b" ".join(words[k : k + 3])) for k in range(max(len(words) - 2, 1))}
        marks = {(k, min(h * m & 0xFFFFFFFF for h in hashes)) for k, m in enumerate((1, 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35))}
        if not marks & seen:
            kept.append(i)
        seen |= marks
    return np.array(kept, dtype=np.int64)


_shapes = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else 46 for c in range(256))
_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_others = bytes(c for c in range(128) if not (65 <= c <= 90 or 97 <= c <= 122))
_runs = re.compile(rb"(.)\1+", re.DOTALL)


def token_slots(token: bytes) -> tuple[list[int], int]:
    """(slots of a token's own features, slot of its word as a neighbour): hashes of its word, the word's first and last three bytes and all fours
    of its first fifteen, its shape and its length, each kind with a start of its own."""
    word = token.translate(_lower, _others) if token.isascii() else word_of(token).encode()
    crc, n = zlib.crc32, len(word)
    own = [crc(word, 1), crc(word[:3], 2), crc(word[-3:], 3), crc(_runs.sub(rb"\1", token[:24].translate(_shapes)), 4), crc(b"%d" % min(n, 12), 5)]
    own += [crc(word[i : i + 4], 6) for i in range(min(n - 3, 12))]
    return [h % SLOTS for h in own], crc(word, 7) % SLOTS


@dataclass
class Model:
    slots: np.ndarray  # weights of the hashed features
    sides: np.ndarray  # 2 x slots: of the words before and after
    bias: float
    moves: np.ndarray  # 2 x 2 log-weights of transitions
    document: np.ndarray  # of the document features


class Reader:
    """Tokens of texts and the log-odds of their emissions; what depends on the token alone is cached."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers = Numbers(CACHE_ENTRIES)
        self.own = np.zeros((3, 0))  # by the token itself, as the word before, as the word after
        self.closes = np.zeros(0, dtype=bool)

    def read(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, their count in each text, first token of each chain, log-odds, where tokens begin in the joined texts)."""
        tokens, counts, begins = split(texts)
        which = self.numbers.numbered(tokens)
        if self.numbers.fresh:
            new = [self._weights(self.numbers.fresh[i : i + 4096]) for i in range(0, len(self.numbers.fresh), 4096)]  # bounds what lists take
            new = np.concatenate(new, axis=1)
            self.own = np.concatenate([self.own, new], axis=1)
            self.closes = np.concatenate([self.closes, np.array([t[-1:] in b".!?" for t in self.numbers.fresh], dtype=bool)])
        value, closes = self.own[:, which], self.closes[which]
        stay = self.numbers.settle()
        self.own, self.closes = self.own[:, :stay], self.closes[:stay]
        starts = chain_starts(counts, closes)
        return tokens, counts, starts, self.model.bias + value[0] + beside(value[1], starts, 1) + beside(value[2], starts, -1), begins


    def _weights(self, tokens: list[bytes]) -> np.ndarray:
        kinds = [token_slots(t) for t in tokens]
        size = np.array([len(own) for own, _ in kinds])
        side = np.array([s for _, s in kinds])
        own = np.add.reduceat(self.model.slots[np.array([s for own, _ in kinds for s in own])], np.cumsum(size) - size)
        return np.stack([own, self.model.sides[0, side], self.model.sides[1, side]])


def split(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(tokens of all texts, their count in each, where they begin in the texts joined by one byte)."""
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    full = ~_blank[raw]
    begins = np.flatnonzero(full & np.concatenate([[True], ~full[:-1]])) if len(raw) else np.zeros(0, dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return joined.split(), np.diff(np.searchsorted(begins, edges)), begins


def chain_starts(counts: np.ndarray, closes: np.ndarray) -> np.ndarray:
    """Chains are sentences, however long; they never cross documents."""
    first = np.zeros(len(closes), dtype=bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    first[1:] |= closes[:-1]
    return np.flatnonzero(first)


def beside(value: np.ndarray, starts: np.ndarray, step: int) -> np.ndarray:
    """The value of the token before (step 1) or after (-1) in the chain, 0 at its ends."""
    out = np.roll(value, step)
    if len(out):
        out[starts if step == 1 else np.append(starts[1:], len(out)) - 1] = 0
    return out


def marginals(odds: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of state 1 at every token; ``odds``: log-odds of its emissions; chains begin at ``starts``.

    With two states, forward and backward values need only their ratio; chains advance side by side, longest first."""
    n = len(odds)
    if not n:
        return np.zeros(0)
    size = np.diff(np.append(starts, n))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    e = np.exp(np.clip(odds, -30, 30))
    m = np.exp(moves)
    forward, backward = np.empty(n), np.empty(n)
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    ratio = np.ones(len(starts))
    for t in range(longest):
        k = active[t]
        at = starts[:k] + t
        if t:
            r = ratio[:k]
            ratio[:k] = e[at] * (m[0, 1] + r * m[1, 1]) / (m[0, 0] + r * m[1, 0])
        else:
            ratio[:k] = e[at]
        ratio[:k] = np.clip(ratio[:k], 1e-200, 1e200)
        forward[at] = ratio[:k]
    ratio = np.ones(len(starts))
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        inner = active[t + 1] if t + 1 < longest else 0
        if inner:
            x = e[at[:inner] + 1] * ratio[:inner]
            ratio[:inner] = (m[1, 0] + m[1, 1] * x) / (m[0, 0] + m[0, 1] * x)
        backward[at] = ratio[:k]
    joint = forward * backward
    return joint / (1 + joint)


def fields(odds: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(marginals, pairs, log Z - score of the all-clean path) of every chain: the marginal of state 1 at each token, the probabilities of the
    four transitions into each token (zero at a chain's start), and what each chain adds to -log P(clean)."""
    p = marginals(odds, starts, moves)
    forward = _forward(odds, starts, moves)
    n, m = len(odds), np.exp(moves)
    inside = np.ones(n, dtype=bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    # P(y_t = 1 | y_{t-1} = s) needs the backward ratio at t: marginal odds over the forward ratio
    b = np.clip(p[at] / np.maximum(1 - p[at], 1e-12) / forward[at], 1e-200, 1e200)
    x = np.exp(np.clip(odds[at], -30, 30)) * b
    up0, up1 = m[0, 1] * x / (m[0, 0] + m[0, 1] * x), m[1, 1] * x / (m[1, 0] + m[1, 1] * x)
    q = p[at - 1]
    pairs = np.zeros((4, n))
    pairs[:, at] = (1 - q) * (1 - up0), (1 - q) * up0, q * (1 - up1), q * up1
    # alpha_t(0) = alpha_{t-1}(0) (m00 + r m10): the all-clean path takes m00 at each step
    step = np.zeros(n)
    step[at] = np.log((m[0, 0] + forward[at - 1] * m[1, 0]) / m[0, 0])
    last = np.append(starts[1:], n) - 1
    step[last] += np.log1p(forward[last])
    return p, pairs, np.add.reduceat(step, starts) if len(starts) else np.zeros(0)


def _forward(odds: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    n = len(odds)
    if not n:
        return np.zeros(0)
    size = np.diff(np.append(starts, n))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    e, m = np.exp(np.clip(odds, -30, 30)), np.exp(moves)
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
    out, ratio = np.empty(n), np.ones(len(starts))
    for t in range(int(size[0])):
        at = starts[: active[t]] + t
        r = ratio[: active[t]]
        out[at] = ratio[: active[t]] = np.clip(e[at] * ((m[0, 1] + r * m[1, 1]) / (m[0, 0] + r * m[1, 0]) if t else 1.0), 1e-200, 1e200)
    return out


class Examples:
    """Training documents as arrays: token types with their slots, chains, documents."""

    def __init__(self, texts: list[bytes], labels: np.ndarray):
        tokens, self.counts, _ = split(texts)
        numbers = Numbers(1 << 62)
        self.type = numbers.numbered(tokens)
        kinds = [token_slots(t) for t in numbers.fresh]
        size = np.array([len(own) for own, _ in kinds], dtype=np.int64)
        self.slot = np.array([s for own, _ in kinds for s in own], dtype=np.int64)
        self.of = np.repeat(np.arange(len(kinds)), size)
        self.side = np.array([b for _, b in kinds], dtype=np.int64)
        self.starts = chain_starts(self.counts, np.array([t[-1:] in b".!?" for t in numbers.fresh], dtype=bool)[self.type] if len(tokens) else np.zeros(0, dtype=bool))
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.labels = labels

    def odds(self, model: Model) -> np.ndarray:
        own = np.bincount(self.of, weights=model.slots[self.slot], minlength=len(self.side))[self.type]
        return model.bias + own + sum(beside(model.sides[i][self.side][self.type], self.starts, step) for i, step in ((0, 1), (1, -1)))

    def gradient(self, model: Model) -> tuple[float, list[np.ndarray]]:
        """(log-likelihood of the labels, its gradient by slots, sides, bias and moves), exactly."""
        p, pairs, away = fields(self.odds(model), self.starts, model.moves)
        chain_doc = self.doc[self.starts] if len(self.starts) else np.zeros(0, dtype=np.int64)
        clean = -np.bincount(chain_doc, weights=away, minlength=len(self.labels))  # log P(clean)
        toxic = np.log(-np.expm1(np.minimum(clean, -1e-12)))
        pull = np.where(self.labels == 1, np.exp(np.minimum(clean - toxic, 30)), -1.0)  # of each document on its tokens
        g = pull[self.doc] * p
        by_type = np.bincount(self.type, weights=g, minlength=len(self.side))
        slots = np.bincount(self.slot, weights=by_type[self.of], minlength=SLOTS)
        # what a token pulls falls on the word before it and the word after it
        beside_it = [np.bincount(self.type, weights=beside(g, self.starts, -step), minlength=len(self.side)) for step in (1, -1)]
        sides = np.stack([np.bincount(self.side, weights=b, minlength=SLOTS) for b in beside_it])
        inside = pairs.sum(axis=0) > 0
        pairs[0, inside] -= 1  # the all-clean path's transitions
        moves = (pairs * pull[self.doc]).sum(axis=1).reshape(2, 2)
        value = float(np.where(self.labels == 1, toxic, clean).sum())
        return value, [slots, sides, np.array(g.sum()), moves]


def fit_field(examples: Examples, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> Model:
    """Weights of greatest likelihood of the documents' labels (with a ridge), by Adam on the exact gradient. At first all tokens of a kind are
    alike and seldom toxic; staying in a state is likelier than leaving it."""
    n = max(1, len(examples.labels))
    start = -np.log(max(2.0, len(examples.type) / n))
    parts = [np.zeros(SLOTS), np.zeros((2, SLOTS)), np.array(start), np.array([[0.0, 0.0], [0.0, 0.0]])]
    first, second = [np.zeros_like(x) for x in parts], [np.zeros_like(x) for x in parts]
    for step in range(1, steps + 1):
        model = Model(parts[0], parts[1], float(parts[2]), parts[3], np.zeros(5))
        found = examples.gradient(model)[1]
        for i, g in enumerate(found):
            g = g / n - ridge * parts[i]
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.99 * second[i] + 0.01 * g**2
            parts[i] = parts[i] + rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6)
    return Model(parts[0], parts[1], float(parts[2]), parts[3], np.zeros(5))


def document_features(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Aggregates of the marginals of each document: whether any token is toxic, how many are, their share."""
    doc = np.repeat(np.arange(len(counts)), counts)
    none = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(counts))
    total = np.bincount(doc, weights=p, minlength=len(counts))
    top = np.zeros(len(counts))
    np.maximum.at(top, doc, p)
    return np.stack([np.ones(len(counts)), 1 - np.exp(none), top, np.log1p(total), np.log1p(1000 * total / np.maximum(counts, 1))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * 0.01 * np.eye(x.shape[1]) + 1e-6 * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * len(y) * 0.01 * w)
    return w


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample_docs`` labelled documents of either kind, and of their texts on at most ``SAMPLE_BYTES``, each kind having half; rows with a null
    label or text don't count, repeated rows count once, and a document with both labels counts as toxic. Without both kinds every document
    scores the share of toxic labels."""
    one_label = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias(label_col))
    chosen = bounded_rows(one_label, label_col, id_col, sample_docs)
    rows = documents.select(id_col, text_col).where(F.col(text_col).isNotNull()).join(F.broadcast(chosen), id_col)  # about twice the sample's size at most
    order = F.xxhash64(F.col(id_col), F.lit(5))
    pairs, size = [], {0: 0, 1: 0}
    for r in rows.select(text_col, label_col, F.col(id_col).alias("_id")).dropDuplicates(["_id", text_col]).orderBy(order, "_id").select(text_col, label_col).toLocalIterator():
        text, label = r[0].encode(), int(r[1])
        if size[label] + len(text) <= SAMPLE_BYTES // 2:
            pairs.append((text, label))
            size[label] += len(text)
        elif min(size.values()) > SAMPLE_BYTES // 2 - (1 << 16):
            break
    pairs.sort()
    pairs = [pairs[i] for i in unlike([p[0] for p in pairs])]  # a group of copies says no more than one of them
    texts, y = [p[0] for p in pairs], np.array([p[1] for p in pairs], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(SLOTS), np.zeros((2, SLOTS)), -30.0, np.zeros((2, 2)), np.array([np.log((share + 1e-6) / (1 - share + 1e-6)), 0, 0, 0, 0]))
    examples = Examples(texts, y)
    model = fit_field(examples)
    p = marginals(examples.odds(model), examples.starts, model.moves)
    model.document = _logistic(document_features(p, examples.counts), y.astype(float))
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, score, predicted, spans) of every whole text: score 0 to 1, predicted = score >= 0.5, spans: array of (start, end), the
    byte offsets of runs of tokens with a marginal of at least one half. If ``whole``, a struct ``row`` of all columns stands in the id's
    place.

    A null text counts as empty; an empty one gets the score of a document without toxic tokens and no spans. Only the text decides."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # three numbers a slot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = shared.value
        reader = Reader(model)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            column = sent_text(batch, text_col, whole)
            for a, b in slices_by_bytes(column, SLICE_BYTES):
                texts = list(text_views(column.slice(a, b - a)))
                tokens, counts, starts, odds, begins = reader.read(texts)
                p = marginals(odds, starts, model.moves)
                value = 1 / (1 + np.exp(-np.clip(document_features(p, counts) @ model.document, -30, 30)))
                hit = p >= 0.5
                doc = np.repeat(np.arange(len(texts)), counts)
                base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
                spans: list[list[dict]] = [[] for _ in texts]
                last = -2
                for i in np.flatnonzero(hit).tolist():
                    own = spans[doc[i]]
                    end = int(begins[i] - base[doc[i]]) + len(tokens[i])
                    if own and i == last + 1:
                        own[-1]["end"] = end
                    else:
                        own.append({"start": int(begins[i] - base[doc[i]]), "end": end})
                    last = i
                columns = [pa.array(value, pa.float64()), pa.array((value >= 0.5).astype(np.int32), pa.int32()), pa.array(spans, pa.list_(span))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], names=[sent[0].name, "score", "predicted", "spans"])
            del batch, column
            give_back()

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    rows, sent = whole_rows(df, id_col, text_col, whole)
    return rows.mapInArrow(run, T.StructType([*sent, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", spans)]))

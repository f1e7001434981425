"""Cached tokenisation with the ``tokenizers`` library: texts are cut where the tokenizer always cuts too, and each distinct
piece goes through the library once."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from .bpe import pieces_of_texts
from .common import Numbers, kept

CACHE_ENTRIES = 300_000
TOGETHER = 2_000
#: ASCII marks; a run of them at the end of a word, after an ASCII letter, is cut off by the tokenizer too.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
Ids = tuple[np.ndarray, np.ndarray]  # ids of all pieces, number of ids of each


class _Store:
    """Cache of ids by piece in front of ``fill``."""

    def __init__(self, fill: Callable[[list[bytes]], Ids]):
        self.fill, self.numbers = fill, Numbers(CACHE_ENTRIES)
        self.flat = np.zeros(0, dtype=np.uint32)
        self.at, self.n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def get(self, pieces: list[bytes]) -> Ids:
        which = self.numbers.numbered(pieces)
        if self.numbers.fresh:
            ids, size = self.fill(self.numbers.fresh)
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
            self.n = np.concatenate([self.n, size])
            self.flat = np.concatenate([self.flat, ids])
        count = self.n[which]
        ends = np.cumsum(count)
        out = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[which] - (ends - count), count)]
        stay = self.numbers.settle()
        if stay < len(self.n):
            self.at, self.n = self.at[:stay].copy(), self.n[:stay].copy()
            self.flat = self.flat[: int(self.at[-1] + self.n[-1])].copy()
        return out, count


class CachedTokenizer:
    """``drops_space``: the tokenizer drops white space, ignores case and cuts between letters and marks, so texts are cut there;
    otherwise it is one that cuts by the pattern of ``bpe.piece_starts``. As in the library, the string of a special token in a text
    gives that token: such a text goes through the library as a whole."""

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain, self.joined = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.between, self.between_id = "<|endoftext|>", self.plain.token_to_id("<|endoftext|>")
        self.special = [t.content.encode() for t in self.joined.get_added_tokens_decoder().values()]
        self.drops_space = drops_space
        self.inner = _Store(self._encode)
        self.outer = _Store(self._from_parts) if drops_space else self.inner

    def _from_parts(self, words: list[bytes]) -> Ids:
        parts: list[bytes] = []
        count = np.ones(len(words), dtype=np.int64)
        for i, word in enumerate(words):
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem[-1:].isalpha():
                parts += (stem.lower(), word[len(stem) :])
                count[i] = 2
            else:
                parts.append(word.lower())
        ids, size = self.inner.get(parts)
        return ids, np.add.reduceat(size, np.cumsum(count) - count)

    def _encode(self, pieces: list[bytes]) -> Ids:
        """Many pieces in one call: a special token that no ordinary text gives keeps them apart."""
        plain = [p.decode() for p in pieces]
        flat, sizes = [], []
        for i in range(0, len(plain), TOGETHER):
            some = plain[i : i + TOGETHER]
            if any("<|" in p for p in some):
                coded = [e.ids for e in self.plain.encode_batch_fast(some, add_special_tokens=False)]
                flat += [np.array(x, dtype=np.uint32) for x in coded]
                sizes.append(np.array(list(map(len, coded)), dtype=np.int64))
                continue
            ids = np.array(self.joined.encode_batch_fast([self.between.join(some) + self.between], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = ids == self.between_id
            flat.append(ids[~ends])
            sizes.append(np.diff(np.flatnonzero(ends), prepend=-1) - 1)
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text among them)."""
        apart = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if apart:
            rest = set(apart)
            ids, ends = self._encode_ordinary([b"" if i in rest else t for i, t in enumerate(texts)])
            own = np.split(ids, ends[:-1]) if len(ends) else []
            for i in apart:
                own[i] = np.array(self.joined.encode(texts[i].decode(), add_special_tokens=False).ids, dtype=np.uint32)
            return np.concatenate(own), np.cumsum([len(x) for x in own])
        return self._encode_ordinary(texts)

    def _encode_ordinary(self, texts: list[bytes]) -> Ids:
        if self.drops_space:
            pieces: list[bytes] = []
            counts = []
            for text in texts:
                found = text.split()
                counts.append(len(found))
                pieces += found
        else:
            pieces, counts, _, _ = pieces_of_texts(texts)
        ids, count = self.outer.get(pieces)
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, ends[np.cumsum(counts, dtype=np.int64)]

    def encode_with_end(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` after each text."""
        ids, ends = self.encode(texts)
        after = ends + np.arange(1, len(ends) + 1)
        out = np.full(len(ids) + len(ends), end_id, dtype=np.uint32)
        keep = np.ones(len(out), dtype=bool)
        keep[after - 1] = False
        out[keep] = ids
        return out, after


@kept
@lru_cache(maxsize=4)
def cached_tokenizer(path: str, drops_space: bool) -> CachedTokenizer:
    return CachedTokenizer(path, drops_space)

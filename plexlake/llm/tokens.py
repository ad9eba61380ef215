"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words.

No token of the vocabulary spans a space or a line feed, and none of its normaliser's steps
looks across them, so the ids of a text are those of its words in order. Words repeat;
each worker keeps the ids of those it has met.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
from tokenizers import Tokenizer, normalizers

from plexlake.llm import words

WORD_BYTES = words.byte_set(b" \n")
CACHE_BITS = 21
# A run of Latin letters and the signs behind it: split there by the vocabulary's own pattern,
# the letters are in composed form, and lower case maps them one by one. An apostrophe may
# start a contraction, so it is left to the tokenizer, as is everything else.
_PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|(.*))$", re.MULTILINE)


class Runs:
    """Ids of runs of letters or signs, end to end in one array; number 0 is the empty run."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.size = 1

    def add(self, ids: np.ndarray, counts: np.ndarray) -> range:
        """Numbers of new runs."""
        n = len(counts)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.size + n > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.first[self.size : self.size + n] = self.used + np.cumsum(counts) - counts
        self.count[self.size : self.size + n] = counts
        self.used += len(ids)
        self.size += n
        return range(self.size - n, self.size)


class WordTokenizer:
    def __init__(self, path: str, cache_bits: int = CACHE_BITS):
        self.tokenizer = Tokenizer.from_file(path)
        self.lean = Tokenizer.from_file(path)
        self.lean.normalizer = normalizers.Sequence([])  # for runs that are normalised already
        with open(path) as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.closes = np.zeros(max(vocabulary.values()) + 2, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache_bits = cache_bits
        self.clear()

    def clear(self) -> None:
        self.index = words.HashIndex(self.cache_bits)
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.n_words = 0
        self.runs = Runs()

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn_slowly(self, texts: list[str]) -> range:
        found = [self._slow(t) for t in texts]
        return self.runs.add(np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))

    def _learn_letters(self, runs: list[str]) -> None:
        """Runs of lower-case letters, many at a time: the last token of each closes it."""
        for at in range(0, len(runs), 512):
            part = runs[at : at + 512]
            ids = np.array(self.lean.encode(" ".join(part), add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            numbers = self.runs.add(ids, np.diff(ends, prepend=0)) if len(ends) == len(part) else self._learn_slowly(part)
            self.runs.number.update(zip(part, numbers))

    def encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, end to end, and how many each has. Words hold no line feed."""
        if len(self.runs.number) > 1 << (self.cache_bits - 2) or self.runs.used > 1 << (self.cache_bits + 2):
            self.runs = Runs()
        found = _PLAIN.findall("\n".join(texts))
        letters, signs = [f[0].lower() for f in found], [f[1] for f in found]
        number = self.runs.number
        self._learn_letters([r for r in dict.fromkeys(letters) if r not in number])
        new = [r for r in dict.fromkeys(signs) if r not in number]
        if new:
            number.update(zip(new, self._learn_slowly(new)))
        at = np.zeros((len(texts), 2), np.int64)
        at[:, 0] = [number[r] for r in letters]
        at[:, 1] = [number[r] for r in signs]
        others = [i for i, f in enumerate(found) if f[2]]
        if others:
            at[others, 0] = self._learn_slowly([found[i][2] for i in others])
        counts = self.runs.count[at.ravel()]
        return self.runs.pool[words.gather_runs(self.runs.first[at.ravel()], counts)], counts.reshape(-1, 2).sum(axis=1)

    def _add(self, hashes: np.ndarray, texts: list[str]) -> None:
        ids, counts = self.encode_words(texts)
        total, n = len(ids), len(counts)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.n_words + n > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.pool[self.used : self.used + total] = ids
        self.first[self.n_words : self.n_words + n] = self.used + np.cumsum(counts) - counts
        self.count[self.n_words : self.n_words + n] = counts
        self.index.insert(hashes, np.arange(self.n_words, self.n_words + n, dtype=np.int32))
        self.used += total
        self.n_words += n

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, end to end, and how many each text has."""
        starts, ends = words.word_spans(data, offsets, WORD_BYTES)
        hashes = words.span_hashes(data, starts, ends)
        hashes[hashes == 0] = 1
        if self.index.size + min(len(hashes), len(self.index.keys) // 4) > len(self.index.keys) // 2:
            self.clear()
        at = self.index.find(hashes)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new, where = np.unique(hashes[unknown], return_index=True)
            if self.index.size + len(new) > len(self.index.keys) // 4 * 3:  # one slice alone with so many words
                return self._encode_uncached(data, offsets)
            raw = data.tobytes()
            spans = unknown[where]
            self._add(new, [raw[s:e].decode() for s, e in zip(starts[spans].tolist(), ends[spans].tolist())])
            at[unknown] = self.index.find(hashes[unknown])
        counts = self.count[at]
        ids = self.pool[words.gather_runs(self.first[at], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])
        borders = upto[words.per_text(starts, offsets)]
        return ids, np.diff(borders)

    def _encode_uncached(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        ids = [self._slow(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        return np.concatenate(ids), np.array([len(i) for i in ids], np.int64)


def shared_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so its cache serves all tasks that run there."""
    return words.per_process(f"tokenizer {path}", lambda: WordTokenizer(path))


def crc32(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each range of ids as little-endian unsigned 32-bit integers."""
    view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    pairs = zip((starts * 4).tolist(), (ends * 4).tolist())
    return np.fromiter((zlib.crc32(view[a:b]) for a, b in pairs), np.int64, len(starts))


def append_id(ids: np.ndarray, counts: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """``last`` behind the ids of every text."""
    return np.insert(ids, np.cumsum(counts), last), counts + 1

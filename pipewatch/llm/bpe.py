"""Byte-pair encoding and decoding by speculation and verification.

Every distinct word is first cut greedily into the longest vocabulary entries. That guess is the
exact encoding if and only if each adjacent pair of tokens is compatible: merging the bytes of the
two tokens gives the same two tokens back. The check undoes the merges at the border, the latest
first, and looks for a merge across it that would have come earlier; it runs over all pairs of all
words of a batch at once. Only words with a failing pair are merged exactly.

A tokenizer is the ``tokenizers`` JSON of a byte-level BPE model without normaliser. Defined
results: NULL text counts as empty and gives no ids; an added token inside a text is its id;
rows, ids and key values that repeat are encoded each for itself; very long texts are split whole, a
bounded slice at a time; an empty table gives an empty one; other columns, of any name, are not touched.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, functions as F

# The fixed pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words whose ids a worker remembers, twice: when there are more, those not met since the last time go.
REMEMBERED = 250_000
# Bytes up to which a word is merged by looking at all its pairs each time.
SHORT = 24
# Characters of a text, and of a group of texts, that are split at a time.
SLICE = 1 << 18

_NEVER = np.int64(1) << 40
_NO_RANK = 1 << 40


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    stands = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stands[b] for b in range(256)]


class SpeculativeBpe:
    """Encodes and decodes with one vocabulary; made once per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE tokenizer without normaliser is needed")
        as_byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.bytes_of = {i: bytes(as_byte[c] for c in token) for token, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.longest = max(map(len, self.id_of))
        size = max(self.bytes_of) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = (model["vocab"][t] for t in (a, b, a + b))
            if self.rank[z] >= 0:
                raise ValueError("a token that two merges make cannot be verified by its parts")
            self.merge[x, y] = rank, z
            self.rank[z], self.left[z], self.right[z] = rank, x, y
        self.size = size
        keys = np.array([x * size + y for x, y in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([r for r, _ in self.merge.values()], np.int64)[order], _NEVER)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.words = regex.compile(PATTERN)
        self.border = regex.compile(r"(?<=\S)\s")
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- speculation ---------------------------------------------------------

    def greedy(self, word: bytes) -> list[int]:
        ids, at, end, id_of = [], 0, len(word), self.id_of
        while at < end:
            stop = min(end, at + self.longest)
            while (found := id_of.get(word[at:stop])) is None:
                stop -= 1
            ids.append(found)
            at = stop
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether their joined bytes encode to just these two."""
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), _NEVER)
        while len(live):
            keys = a * self.size + b
            at = np.searchsorted(self.pair_keys, keys)
            crossing = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)
            bad = crossing < limit
            good[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            # Of equal merges the left one is made first, so it is undone last.
            undo_left = ra > rb
            limit = np.where(undo_left, ra, rb + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return good

    # -- exact merging -------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first; longer words with a heap, so that they stay quick."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) <= SHORT:
            return self._merged_short(ids)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(*self.merge[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
        heap = [(rank, i, new, x, y) for rank, new, i, x, y in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
            for p in (before[i], i):
                if p >= 0 and after[p] < len(ids):
                    pair = ids[p], ids[after[p]]
                    if pair in self.merge:
                        rank, made = self.merge[pair]
                        heapq.heappush(heap, (rank, p, made, *pair))
        return [i for i in ids if i >= 0]

    def _merged_short(self, ids: list[int]) -> list[int]:
        merge, none = self.merge.get, (_NO_RANK, -1)
        pairs = [merge(p, none) for p in zip(ids, ids[1:])]
        while pairs and (best := min(pairs))[0] < _NO_RANK:
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = merge((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = merge((ids[i], ids[i + 1]), none)
        return ids

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        guesses = [self.greedy(w) for w in words]
        flat = np.fromiter((i for g in guesses for i in g), np.int64)
        owner = np.repeat(np.arange(len(words)), [len(g) for g in guesses])
        inside = owner[1:] == owner[:-1]
        pairs, place = np.unique(flat[:-1][inside] * self.size + flat[1:][inside], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[place]
        for w in np.unique(owner[1:][inside][~good]):
            guesses[w] = self.merged(words[w])
        return guesses

    # -- texts ---------------------------------------------------------------

    def _slices(self, text: str) -> Iterator[str]:
        """Parts of a text that no word crosses: cut before white space that follows none."""
        start = 0
        while len(text) - start > SLICE and (cut := self.border.search(text, start + SLICE)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def _ids_of(self, parts: list[list[str]]) -> list[bytes]:
        """Ids of lists of words, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = []
        for word in {w for words in parts for w in words if w not in known}:
            if (ids := older.get(word)) is None:
                new.append(word)
            else:
                known[word] = ids
        for word, ids in zip(new, self.encode_words([w.encode() for w in new])):
            known[word] = np.array(ids, "<u4").tobytes()
        return [b"".join([known[w] for w in words]) for words in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[list[bytes], int, list[str]]] = []
        held = 0

        def settle() -> None:
            for (own, at, _), ids in zip(waiting, self._ids_of([w for _, _, w in waiting])):
                own[at] = ids
            waiting.clear()

        for own, text in zip(out, texts):
            pieces = self.added_pattern.split(text) if self.added_pattern and "<" in text else [text]
            for piece in pieces:
                if piece in self.added:
                    own.append(np.array([self.added[piece]], "<u4").tobytes())
                    continue
                for part in self._slices(piece):
                    waiting.append((own, len(own), self.words.findall(part)))
                    own.append(b"")
                    held += len(part)
                    if held > SLICE:
                        settle()
                        held = 0
        settle()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _loaded(path: str) -> SpeculativeBpe:
    return SpeculativeBpe(path)


def bpe_encode(text: Column, path: str) -> Column:
    """Ids of a text as little-endian unsigned 32-bit numbers (binary); NULL counts as empty.

    ``path`` is a file that every executor has at the same place.
    """

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _loaded(path)
        for texts in batches:
            yield pd.Series(bpe.encode(texts.fillna("").tolist()), dtype=object)

    return encode(text)


def bpe_decode(ids: Column, path: str) -> Column:
    """The text of ids made by :func:`bpe_encode`; NULL counts as no ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _loaded(path)
        for rows in batches:
            yield pd.Series([bpe.decode(x or b"") for x in rows], dtype=object)

    return decode(ids)


def bpe_round_trip(text: Column, path: str) -> Column:
    """``ids`` as of :func:`bpe_encode` and ``decoded``, the text that they decode to, in one pass."""

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _loaded(path)
        for texts in batches:
            ids = bpe.encode(texts.fillna("").tolist())
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([bpe.decode(x) for x in ids], dtype=object)})

    return both(text)

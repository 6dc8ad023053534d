"""Benchmark passages in documents, found by SimHash over item-sized windows.

A document matches an item if some window of as many words as the item has a
weighted similarity of ``similarity`` or more with it: the shared five-word
shingles over all of both, each weighted by how often it occurs.

The items are the bounded side. They are read in blocks of a few megabytes, and
each block meets all documents without a shuffle; all blocks stay in the plan, so the
whole benchmark has to fit into the driver and every worker. In a pass, every window
that shares enough shingles with some item to reach the similarity gets a fingerprint;
this saves fingerprints and loses nothing, because a similarity implies it. From the
fingerprint a multi-index over eight blocks of bits proposes all items within the radius:
two fingerprints within it differ by at most ``radius // 8`` bits in some block, so none
is missed. Proposed items are verified on the words themselves.

Words are runs of letters, digits and underscores, lower-cased. A document
shorter than an item is one window. Items of fewer words than a shingle, null
and empty items match nothing. Null and empty documents match nothing. Repeated
rows, of either side, are matched alike. An empty benchmark matches nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import lru_cache
from itertools import combinations
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8, fingerprints differ by about 10 of 64 bits, with a
# deviation of 3; four deviations and more are allowed for.
RADIUS = 23
BLOCK_BYTES = 4 << 20

MATCHES = ("item_id ARRAY<LONG>, first_word ARRAY<LONG>, n_words ARRAY<LONG>, "
           "similarity ARRAY<DOUBLE>")
_WORD = re.compile(r"\w+")
_FILTER_BITS = 20


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def shingle_hashes(words: Sequence[str], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles, for use within one process."""
    count = len(words) - shingle + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    single = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(count, np.uint64)
    for i in range(shingle):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + single[i:i + count]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def window_fingerprints(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """SimHash of the windows of ``count`` shingles that start at ``first``."""
    low, high = int(first.min()), int(first.max()) + count
    octets = hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    total = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[first - low + count] - total[first - low]
    return np.packbits(2 * ones > count, axis=1, bitorder="little").view("<u8").ravel()


class HammingIndex:
    """All of a set of fingerprints within a radius of a given one."""

    def __init__(self, fingerprints: np.ndarray, radius: int = RADIUS):
        self.fingerprints, self.radius = fingerprints.astype(np.uint64), radius
        octets = fingerprints.astype("<u8").view(np.uint8).reshape(-1, 8)
        self.block = [{int(value): np.flatnonzero(octets[:, b] == value)
                       for value in np.unique(octets[:, b])} for b in range(8)]
        self.masks = [sum(1 << bit for bit in bits) for size in range(radius // 8 + 1)
                      for bits in combinations(range(8), size)]

    def near(self, fingerprint: int) -> np.ndarray:
        found = [self.block[b][value] for b in range(8) for mask in self.masks
                 if (value := (fingerprint >> (8 * b) & 255) ^ mask) in self.block[b]]
        if not found:
            return np.empty(0, np.int64)
        rows = np.unique(np.concatenate(found))
        differing = np.bitwise_count(self.fingerprints[rows] ^ np.uint64(fingerprint))
        return rows[differing <= self.radius]


def similarity_of(a: Sequence[str], b: Sequence[str], shingle: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of the shingles of two word sequences."""
    left, right = (Counter(tuple(words[i:i + shingle]) for i in range(len(words) - shingle + 1))
                   for words in (a, b))
    whole = sum((left | right).values())
    return sum((left & right).values()) / whole if whole else 0.0


class Items:
    """A block of benchmark items, indexed by shingle and by fingerprint."""

    def __init__(self, texts: tuple[str | None, ...], shingle: int, similarity: float,
                 radius: int):
        self.shingle, self.similarity = shingle, similarity
        self.words = [words_of(text) for text in texts]
        hashes = [shingle_hashes(words, shingle) for words in self.words]
        self.counts = [len(h) for h in hashes]
        usable = [i for i, h in enumerate(hashes) if len(h)]
        flat = np.concatenate([hashes[i] for i in usable]) if usable else np.empty(0, np.uint64)
        owner = np.repeat(usable, [self.counts[i] for i in usable]) if usable else []
        pairs = np.unique(np.rec.fromarrays([flat, owner], names="h,i")) if usable else None
        self.hashes, self.first = (np.unique(pairs["h"], return_index=True) if usable
                                   else (flat, np.empty(0, np.int64)))
        self.owner = pairs["i"] if usable else np.empty(0, np.int64)
        self.last = np.append(self.first[1:], len(self.owner)) if usable else self.first
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self._slot(self.hashes)] = True
        # One multi-index per window size.
        self.index = {}
        for size in {self.counts[i] for i in usable}:
            rows = [i for i in usable if self.counts[i] == size]
            marks = np.concatenate([window_fingerprints(hashes[i], np.array([0]), size)
                                    for i in rows])
            self.index[size] = (rows, HammingIndex(marks, radius))

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def shared(self, hashes: np.ndarray) -> dict[int, np.ndarray]:
        """Per item, the places of a document whose shingle the item has."""
        places = np.flatnonzero(self.maybe[self._slot(hashes)])
        if not len(places):
            return {}
        at = np.minimum(np.searchsorted(self.hashes, hashes[places]), len(self.hashes) - 1)
        real = self.hashes[at] == hashes[places]
        found: dict[int, list[int]] = {}
        for place, entry in zip(places[real].tolist(), at[real].tolist(), strict=True):
            for item in self.owner[self.first[entry]:self.last[entry]].tolist():
                found.setdefault(item, []).append(place)
        return {item: np.array(p) for item, p in found.items()}

    def windows(self, places: np.ndarray, item: int, total: int) -> tuple[np.ndarray, int]:
        """Starts of the windows with enough shared shingles, and their shingles."""
        count = min(self.counts[item], total)
        need = max(1, ceil(self.similarity * (count + self.counts[item])
                           / (1 + self.similarity) - 1e-9))
        if len(places) < need:
            return np.empty(0, np.int64), count
        begin, end = places[:len(places) - need + 1], places[need - 1:]
        fits = end - begin < count
        low = np.maximum(end[fits] - count + 1, 0)
        high = np.minimum(begin[fits], total - count)
        starts = [np.arange(a, b + 1) for a, b in zip(low, high, strict=True)]
        return np.unique(np.concatenate(starts or [np.empty(0, np.int64)])), count

    def matches(self, text: str | None, every_window: bool = False
                ) -> list[tuple[int, int, int, float]]:
        """Matched items ``(item, first word, words, similarity)``, the best window of each.

        Windows are worth a fingerprint where they share enough shingles with some item of
        their size; ``every_window`` asks for all of them and gives the same. Which items a
        window may match, the multi-index proposes from its fingerprint alone.
        """
        words = words_of(text)
        hashes = shingle_hashes(words, self.shingle)
        if not len(hashes) or not len(self.hashes):
            return []
        asked: dict[int, list[np.ndarray]] = {}
        if every_window:
            asked = {size: [np.arange(len(hashes) - min(size, len(hashes)) + 1)]
                     for size in self.index}
        else:
            for item, places in self.shared(hashes).items():
                starts, _ = self.windows(places, item, len(hashes))
                if len(starts):
                    asked.setdefault(self.counts[item], []).append(starts)
        best: dict[int, tuple[float, int, int]] = {}
        for size, chosen in asked.items():
            rows, index = self.index[size]
            count = min(size, len(hashes))
            starts = np.unique(np.concatenate(chosen))
            for start, mark in zip(starts.tolist(), window_fingerprints(
                    hashes, starts, count).tolist(), strict=True):
                window = words[start:start + count + self.shingle - 1]
                for item in {rows[i] for i in index.near(mark)}:
                    value = similarity_of(window, self.words[item], self.shingle)
                    best[item] = max(best.get(item, (0.0, 0, 0)), (value, -start, count))
        return sorted((item, -start, count + self.shingle - 1, value)
                      for item, (value, start, count) in best.items()
                      if value >= self.similarity)


@lru_cache(maxsize=4)
def _items(texts: tuple, shingle: int, similarity: float, radius: int) -> Items:
    return Items(texts, shingle, similarity, radius)


def _match(ids: list, texts: tuple, shingle: int, similarity: float, radius: int,
           text: Column) -> Column:
    @F.pandas_udf(MATCHES)
    def matched(values: pd.Series) -> pd.DataFrame:
        items = _items(texts, shingle, similarity, radius)
        rows = [items.matches(value) for value in values]
        return pd.DataFrame({
            "item_id": [[ids[m[0]] for m in row] for row in rows],
            "first_word": [[m[1] for m in row] for row in rows],
            "n_words": [[m[2] for m in row] for row in rows],
            "similarity": [[m[3] for m in row] for row in rows]})
    found = matched(text)
    return F.arrays_zip(*[found[name].alias(name) for name in
                          ("item_id", "first_word", "n_words", "similarity")])


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, output: str = "matches",
                      shingle: int = SHINGLE, similarity: float = SIMILARITY,
                      radius: int = RADIUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The table with an array of matches per document.

    Each match has ``item_id, first_word, n_words, similarity``. Items are
    collected in blocks of about ``block_bytes`` of text; all blocks stay in the plan,
    so the driver and every worker hold the whole benchmark.
    """
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / block_bytes))
    found = docs.withColumn(output, F.array().cast(
        "array<struct<item_id:bigint,first_word:bigint,n_words:bigint,similarity:double>>"))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy(
            "item_id", "text").collect()
        if rows:
            found = found.withColumn(output, F.concat(output, _match(
                [row["item_id"] for row in rows], tuple(row["text"] for row in rows),
                shingle, similarity, radius, F.col("text"))))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that match no item; columns stay as they are."""
    found = "_benchmark_matches"
    return benchmark_matches(docs, benchmark, found).filter(F.size(found) == 0).drop(found)

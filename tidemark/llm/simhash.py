"""Shingles of short texts and the near-duplicate test that goes with them; their 64-bit SimHash."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE = 5
SIMILARITY = 0.8
#: Bits in which two fingerprints may differ, and the tables, a block of bits each, of which they then share one.
RADIUS = 3
TABLES = RADIUS + 1


@lru_cache(1 << 18)
def _bits(feature: str) -> np.ndarray:
    return np.unpackbits(np.array([xxhash.xxh64_intdigest(feature)], np.uint64).view(np.uint8)).astype(np.int32) * 2 - 1


def simhash(words: list[str]) -> int:
    """The fingerprint of a text's words, as a signed 64-bit number; 0 for no words."""
    if not words:
        return 0
    total = np.sum([_bits(w) for w in words], axis=0)
    return int(np.packbits(total > 0).view(np.int64)[0])


def shingles(words: list[str], size: int = SHINGLE) -> list[str]:
    """All distinct runs of `size` words; a shorter text is its own single shingle."""
    return list(dict.fromkeys(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))))


def prefix(grams: Column, similarity: float = SIMILARITY) -> Column:
    """array<bigint>: the first of the shingles in the order of their hashes.

    As many as can be missing from another text's, and one: two texts of at least `similarity` always have one of these in common.
    """
    kept = F.size(grams) - F.ceil(F.size(grams) * F.lit(similarity) - F.lit(1e-9)) + 1
    return F.slice(F.array_sort(F.transform(grams, lambda g: F.xxhash64(g))), F.lit(1), kept.cast("int"))


#: What the hash of a shingle's word is multiplied with at each place.
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _Hashes(dict):
    """The hashes of words, each made once; emptied when it holds MOST_HASHES."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_HASHES:
            self.clear()
        return self.setdefault(word, xxhash.xxh64_intdigest(word))


MOST_HASHES = 1 << 18
_hashes = _Hashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def prefixes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): what `prefix` is for the shingles of many texts at once.

    A text is a run of `hashes` (of words), given by its start and its length of one word at least;
    runs may overlap. The hash of a shingle is a sum over its words by their places. The texts'
    prefixes come one after another, counts says how long each is.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = np.maximum(lengths - SHINGLE + 1, 1)
    firsts = np.cumsum(runs) - runs
    owner = np.repeat(np.arange(len(starts)), runs)
    n = max(0, len(hashes) - SHINGLE + 1)
    total = np.zeros(len(hashes), np.uint64)
    for i, place in enumerate(PLACES):
        total[:n] += hashes[i : i + n] * np.uint64(place)
    values = total[np.arange(len(owner)) - firsts[owner] + starts[owner]]
    for size in range(1, SHINGLE):  # texts that are a single shorter shingle
        at = np.flatnonzero(lengths == size)
        values[firsts[at]] = sum(hashes[starts[at] + i] * np.uint64(PLACES[i]) for i in range(size))
    few = len(starts) <= 1 << 16
    if few:  # by text and the first 48 bits, which nearly always settles the order
        key = owner.astype(np.uint64) << np.uint64(48) | values >> np.uint64(16)
        order = np.argsort(key)
        key, ordered = key[order], values[order]
        few = not np.any((key[1:] == key[:-1]) & (ordered[1:] != ordered[:-1]))
    if not few:
        order = np.lexsort((values, owner))
        ordered = values[order]
    owner = owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])
    ordered, owner = ordered[new], owner[new]
    distinct = np.bincount(owner, minlength=len(starts))
    kept = distinct - np.ceil(distinct * similarity - 1e-9).astype(np.int64) + 1
    return ordered[np.arange(len(owner)) - (np.cumsum(distinct) - distinct)[owner] < kept[owner]].view(np.int64), kept


def prefix_hashes(words: list[str], similarity: float = SIMILARITY) -> list[int]:
    """`prefixes` of one text."""
    return prefixes(word_hashes(words), np.array([0]), np.array([len(words)]), similarity)[0].tolist() if words else []


def near(grams_a: Column, grams_b: Column, similarity: float = SIMILARITY) -> Column:
    """Jaccard similarity of the shingles at least `similarity`."""
    shared = F.size(F.array_intersect(grams_a, grams_b))
    return shared / (F.size(grams_a) + F.size(grams_b) - shared) >= similarity


def block_keys(fp: Column) -> Column:
    """array<struct<no, block>>: the fingerprint's block for each table; fingerprints within RADIUS bits agree in one."""
    width = 64 // TABLES
    return F.array(*[F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("block")) for i in range(TABLES)])


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))

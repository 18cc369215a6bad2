"""Sets of word shingles as sorted arrays of 64-bit hashes, many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Cuts texts into words (A-Z lowered, split at ASCII white space) and
    gives each text's distinct runs of ``width`` words; a shorter text is one
    run, a text without words has none. Hashes of words already met are kept,
    up to ``keep`` of them."""

    def __init__(self, width: int, keep: int = 300_000):
        self.width, self.keep = width, keep
        self.index: dict[bytes, int] = {}
        self.hashes = np.empty(0, dtype=np.uint64)

    def _word_hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [t.lower().split() for t in texts]  # of bytes: ASCII letters and white space only
        if len(self.index) > self.keep:
            self.index, self.hashes = {}, self.hashes[:0]
        new = [w for w in dict.fromkeys(w for ws in found for w in ws) if w not in self.index]
        if new:
            base = len(self.index)
            self.index.update(zip(new, range(base, base + len(new))))
            fresh = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in new), dtype=np.uint64, count=len(new))
            self.hashes = np.concatenate([self.hashes, fresh])
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        get = self.index.__getitem__
        at = np.fromiter((i for ws in found for i in map(get, ws)), dtype=np.int64, count=int(counts.sum()))
        return self.hashes[at], counts

    def sets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes of all texts, and how many each has."""
        words, counts = self._word_hashes(texts)
        begin = np.cumsum(counts) - counts
        runs = np.where(counts >= self.width, counts - self.width + 1, 0)
        owner = np.repeat(np.arange(len(texts)), runs)
        first = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(begin, runs)
        value = np.full(len(first), np.uint64(self.width))
        for k in range(self.width):
            value = mix(value * _ODD + words[first + k])
        short = np.flatnonzero((counts > 0) & (counts < self.width))
        if len(short):  # the whole sequence as one run
            one = np.array([self._chain(words[begin[i]:begin[i] + counts[i]]) for i in short], dtype=np.uint64)
            owner, value = np.concatenate([owner, short]), np.concatenate([value, one])
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        return value[new], np.bincount(owner[new], minlength=len(texts))

    def _chain(self, words: np.ndarray) -> np.uint64:
        value = np.array([len(words)], dtype=np.uint64)
        for w in words:
            value = mix(value * _ODD + w)
        return value[0]


def digests(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A signed 64-bit digest of every set; of the empty set 0."""
    ends = np.cumsum(counts)
    raw = np.ascontiguousarray(values)
    return np.array([xxhash.xxh3_64_intdigest(raw[e - c:e].tobytes()) if c else 0 for e, c in zip(ends, counts)],
                    dtype=np.uint64).view(np.int64)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def pair_hash(a: np.ndarray, b) -> np.ndarray:
    return mix(a * _ODD2 + b)

"""Word shingles and MinHash signatures in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
CACHED = 500_000


class WordHashes(dict):
    """64-bit hashes of words, each computed once per batch of texts."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def normal_words(text: str) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return text.lower().encode().split()


def shingle_hashes(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; fewer words make one run, none makes none."""
    if len(hashes) > CACHED:
        hashes.clear()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(size, n)
    mixed = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : n - width + 1 + i]
        mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


class MinHash:
    """Minima of universal hash functions (multiply, add, keep the high half)."""

    def __init__(self, functions: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 2**63, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, functions, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of minima per set, as unsigned 32-bit; all ones for an empty set."""
        out = np.full((len(sets), len(self.a)), 2**32 - 1, np.uint32)
        filled = [n for n, s in enumerate(sets) if len(s)]
        at = 0
        while at < len(filled):
            # About a hundred thousand shingles at a time stay in the cache.
            end, size = at, 0
            while end < len(filled) and (size == 0 or size + len(sets[filled[end]]) <= 100_000):
                size += len(sets[filled[end]])
                end += 1
            these = filled[at:end]
            flat = np.concatenate([sets[n] for n in these])
            first = np.cumsum([0] + [len(sets[n]) for n in these[:-1]])
            for f, (a, b) in enumerate(zip(self.a, self.b)):
                out[these, f] = np.minimum.reduceat(flat * a + b, first) >> np.uint64(32)
            at = end
        return out

"""64-bit hashes of words and of what is made of them, vectorised with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Hashes of words; remembers so many of them per worker."""

    def __init__(self, most: int = 500_000):
        self.most = most
        self.known: dict[str, int] = {}

    def of(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.most:
                self.known = {}
            digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            found = self.known[word] = int.from_bytes(digest, "little")
        return found

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.of, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours, in order."""
    n = len(hashes) - width + 1
    total = np.full(n, width, np.uint64)
    for at in range(width):
        total = mixed(total * STEP + hashes[at : n + at])
    return total

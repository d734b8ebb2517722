"""Word shingles of a text as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class ShingleHasher:
    """Sorted distinct shingle hashes of texts; remembers word hashes (bounded)."""

    def __init__(self, words: int = SHINGLE_WORDS, remember: int = 200_000):
        self.words, self.remember = words, remember
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        if len(self.known) >= self.remember:
            self.known.clear()
        value = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        """A-Z in lower case, words between ASCII white space; with fewer words
        than a shingle has, the whole sequence is one."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        get, new = self.known.get, self._word
        hashes = np.fromiter((get(w) or new(w) for w in words), np.uint64, len(words))
        size = min(self.words, len(words))
        count = len(words) - size + 1
        code = np.full(count, np.uint64(size))
        for j in range(size):
            code = code * _MULTIPLIER + hashes[j:j + count]
        code ^= code >> np.uint64(31)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        code ^= code >> np.uint64(29)
        return np.unique(code)

"""Word hashes of whole texts, computed by NumPy over the code points."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-known 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes the words (lower-cased runs of letters, digits and underscores) of texts; one a worker."""

    _one: "WordHasher | None" = None

    def __init__(self):
        self.in_word = np.zeros(0x110000, bool)
        self.in_word[[c for c in range(0x110000) if chr(c).isalnum()]] = True
        self.in_word[ord("_")] = True
        self.up = self.down = np.ones(1, np.uint64)

    @classmethod
    def get(cls) -> "WordHasher":
        cls._one = cls._one or cls()
        return cls._one

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def words(self, text: str) -> np.ndarray:
        """A hash for each word: differences of a running polynomial, shifted to the word's own start."""
        return self.words_and_endings(text)[0]

    def words_and_endings(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each word, and 16 bits of one for its last two characters."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(codes):
            return np.zeros(0, np.uint64), np.zeros(0, np.int32)
        inside = np.zeros(len(codes) + 2, bool)
        inside[1:-1] = self.in_word[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        self._powers(len(codes) + 1)
        running = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.down[:len(codes)], out=running[1:])
        last = codes[end - 1].astype(np.uint64) * np.uint64(0x110000) + codes[np.maximum(end - 2, start)]
        return mix((running[end] - running[start]) * self.up[start]), (mix(last) >> np.uint64(48)).astype(np.int32)

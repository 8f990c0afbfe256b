"""Words and hashed word shingles of texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
CACHE = 250_000
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64
)


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z in lower case (other letters keep their case)."""
    return text.encode().lower().split()


class WordHashes(dict):
    """64-bit hash of each word, kept between texts; emptied when it has grown to ``CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Hash of each run of ``words`` words in order; of the whole sequence where it is shorter."""
    if not len(hashes):
        return hashes
    n = max(len(hashes) - words + 1, 1)
    out = np.full(n, min(words, len(hashes)), np.uint64)
    for i in range(min(words, len(hashes))):
        out = (out ^ hashes[i : i + n]) * _FACTORS[i % 5]
        out ^= out >> np.uint64(29)
    return out

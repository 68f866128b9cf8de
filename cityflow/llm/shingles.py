"""Word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from cityflow.llm.common import mix

WORDS_KEPT = 300_000
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word seen; forgets all when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at bytes 20 and 09-0D; other bytes of UTF-8 are part of words."""
    return text.lower().split()


def shingle_set(text: bytes, size: int, seen: WordHashes) -> np.ndarray:
    """Distinct hashes of `size` consecutive words, sorted; of all words if there are fewer;
    none without words. Equal hashes count as equal shingles (64 bits)."""
    found = words(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(seen.__getitem__, found), np.uint64, n)
    width = min(size, n)
    value = ids[: n - width + 1].copy()
    for k in range(1, width):
        value *= STEP
        value += ids[k : n - width + 1 + k]
    return np.unique(mix(value + np.uint64(width if width < size else 0)))

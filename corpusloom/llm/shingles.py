"""Hashed word shingles of whole texts, with numpy inside Arrow batches."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)
STEP = 0x9E3779B97F4A7C15
CACHED_WORDS = 150_000


class WordHashes(dict):
    """64-bit hash per word; forgets all words when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; ``bytes.split`` cuts at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser, in place."""
    values ^= values >> SHIFT
    values *= MIX_A
    values ^= values >> SHIFT
    values *= MIX_B
    values ^= values >> SHIFT
    return values


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words; the whole text if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    length = min(length, n)
    total = np.full(n - length + 1, length, np.uint64)
    for i in range(length):
        total *= np.uint64(STEP)
        total += hashes[i : n - length + 1 + i]
    return mixed(total)


def shingle_set(text: str | None, length: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(runs(word_hashes(words_of(text), cache), length))


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()

"""Normalised words and 64-bit word and shingle hashes over whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

#: A-Z to a-z; ASCII letters, digits and all bytes of other characters stay; other ASCII bytes end a word.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

_M = np.uint64


def folded_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def hash_words(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter(map(h, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> _M(32))
    x = x * _M(0xD6E8FEB86659FD93)
    x ^= x >> _M(32)
    x *= _M(0xD6E8FEB86659FD93)
    x ^= x >> _M(32)
    return x


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles; of the whole sequence if it has fewer words; none for no words."""
    if len(word_hashes) == 0:
        return word_hashes
    n = min(n, len(word_hashes))
    size = len(word_hashes) - n + 1
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out = (out ^ word_hashes[i:i + size]) * _M(0x9E3779B97F4A7C15)
        out ^= out >> _M(29)
    return mix(out + _M(n))

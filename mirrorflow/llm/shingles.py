"""Hashed word shingles and MinHash signatures of texts, in numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = 4096  # shingles hashed at once: bounds the memory of a very long text


class _WordCodes(dict):
    """Word to 64-bit hash; forgets all it knows when it grows too large."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_codes = _WordCodes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a text.

    Words are runs of anything but space and the characters 9 to 13, with A-Z lowered. A text with
    fewer words than ``size`` is one shingle; a null text or one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_codes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(size, len(words))):
        rolled = rolled * _MULTIPLIER + codes[j : j + n]
    if len(words) < size:
        rolled = rolled + np.uint64(len(words))
    return np.unique(_mixed(rolled))


def _family(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, k, dtype=np.uint64)


def signature(shingles: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """MinHash signature: for each of ``k`` hash functions the least value over the set, 32 bits."""
    factors, shifts = _family(k, seed)
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _STEP):
        part = shingles[start : start + _STEP, None] * factors[None, :] + shifts[None, :]
        least = np.minimum(least, part.min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """True if the Jaccard similarity of two sorted distinct arrays is at least ``percent`` / 100."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def texts_of(column: Iterable) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in column]

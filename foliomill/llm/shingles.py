"""Word shingles as sets of 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from foliomill.llm.common import Remembered, mixed, utf8, word_windows

WIDTH = 5
_BASE = np.uint64(0x9E6C63D0876A9A47)

_known = Remembered(xxhash.xxh64_intdigest)


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z in lower case."""
    words = utf8(text).lower().split()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingles; the whole sequence as one if it is shorter; none without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < WIDTH:
        return mixed(word_windows(words, len(words), _BASE) + np.uint64(len(words)))
    return np.unique(word_windows(words, WIDTH, _BASE))


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union; nothing is similar to an empty set."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)

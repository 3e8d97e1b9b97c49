"""Sets of hashed word shingles."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from trailmark.llm.common import held

# Bound of the hashed words a worker remembers; results do not depend on it.
MEMO_WORDS = 500_000

_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = made
        return made


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixer; each seed permutes the numbers in its own way."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0xD6E8FEB86659FD93) % 2**64)
    x = (x ^ (x >> np.uint64(32))) * _C
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, A-Z in lower case. A text of
    fewer words is one run of all it has; a text without words has none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(held("shingles", _Words).__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    made = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        made = mix(made * _A + hashes[i : i + len(made)])
    made.sort()
    return made[np.concatenate([[True], made[1:] != made[:-1]])]


def set_key(shingles: np.ndarray) -> bytes:
    """Names a set: equal sets have equal keys."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()

"""Word shingles of a text as hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42


def shingle_hashes(text: bytes | None, shingle: int, distinct: bool = False) -> np.ndarray:
    """XXH64 (seed 42) of a UTF-8 text's word shingles in order; A-Z count as a-z. No words: no hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    elif shingle == 1:
        parts = words
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x, SEED) for x in (set(parts) if distinct else parts)], dtype=np.uint64)

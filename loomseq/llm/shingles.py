"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42


def shingle_hashes(text: str, words_each: int) -> np.ndarray:
    """XXH64 of each space-joined shingle of the text's words, A-Z lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= words_each:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = [0, *ends[: n - words_each].tolist()]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words_each - 1 :] - 1).tolist())), np.uint64, n - words_each + 1)

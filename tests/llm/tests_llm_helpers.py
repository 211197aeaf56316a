"""Naive fingerprints and groups, for several tests."""

import numpy as np
import xxhash


def fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(fps, radius):
    """Smallest row of each row's component, by comparing every two."""
    fps = np.array(fps, np.uint64)
    root = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    while True:
        new = np.where(near, root[None, :], len(fps)).min(1)
        if (new == root).all():
            return root
        root = new

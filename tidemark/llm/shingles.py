"""Hashed word shingles, min-hash signatures and bit sketches, computed per Arrow batch with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles of `width` words.

    Words are runs of other than ASCII white space, A-Z lower-cased. A text of fewer words is one shingle of all
    of them; null and empty texts have none.
    """
    split = [[] if t is None else t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = [len(w) for w in split]
    flat = [x for w in split for x in w]
    h = pd.util.hash_array(np.array(flat, dtype=object), categorize=False).astype(np.uint64) if flat else np.zeros(0, np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        for n in counts:
            w = h[at : at + n]
            at += n
            k = min(width, n)
            if not n:
                yield w
                continue
            s = np.full(n - k + 1, np.uint64(k))
            for j in range(k):
                s = mix(s * _ODD + w[j : n - k + 1 + j])
            yield np.unique(s)


def coefficients(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2**63, count, dtype=np.uint64)


def minhashes(s: np.ndarray, odd: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """For each function x -> (x * odd + plus) >> 32 the greatest value over the set, which serves as well as the least."""
    out = np.empty(len(odd), np.uint32)
    hi = s
    with np.errstate(over="ignore"):
        for j in range(len(odd)):
            out[j] = (hi * odd[j] + plus[j]).max() >> np.uint64(32)
    return out


def bit_sketch(m: np.ndarray) -> np.ndarray:
    """One bit of each min-hash, packed into signed 64-bit words."""
    with np.errstate(over="ignore"):
        bits = (mix(m.astype(np.uint64) * _ODD) >> np.uint64(17)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()

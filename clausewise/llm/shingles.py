"""Word shingles of many texts at once, as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
#: Fixed odd factors of the hashes.
BASE = 0x9E3779B97F4A7C15
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                steps = np.full(1 << (n - 1).bit_length(), factor, np.uint64)
                steps[0] = 1
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word, letters A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[data] * up, dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingles, ascending; fewer words than that make one shingle, no words make none."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    k = min(words, len(hashes))
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - k + 1, np.uint64)
        for i in range(k):
            total = mix(total * np.uint64(BASE) + hashes[i : len(hashes) - k + 1 + i])
        total += np.uint64(len(hashes) if len(hashes) < words else 0)
    return np.unique(total)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum()) if len(b) else 0

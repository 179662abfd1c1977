"""Minimal perfect hashing of 64-bit keys by cascading bitmaps.

Level by level, the keys that are alone in their place set its bit; the others go on to the next, smaller level. A
key's value is the number of set bits before its own, so n keys have the values 0 to n - 1. The bitmaps take
some four bits a key.
"""

from __future__ import annotations

import numpy as np

from gondola.llm import words as W

SPACE = 2.0


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = W.mix(keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64))
    return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> dict[str, np.ndarray]:
    """The hash of distinct keys: `sizes` of the levels, their `words`, bits `before` each word, and the `keys` by value."""
    sizes, words, rest = [], [], keys
    while len(rest):
        size = 64 * -(-int(SPACE * len(rest)) // 64)
        at = _place(rest, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        rest = rest[~alone[at]]
    flat = np.concatenate([np.empty(0, np.uint64), *words])
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(flat), dtype=np.int64)])[:-1]
    found = {"sizes": np.array(sizes, dtype=np.int64), "words": flat, "before": before}
    held = np.empty_like(keys)
    held[_values(found, keys)] = keys
    return found | {"keys": held}


def _values(found: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), dtype=np.int64)
    left, start = np.arange(len(keys)), 0
    for level, size in enumerate(found["sizes"].tolist()):
        if not len(left):
            break
        at = _place(keys[left], level, size)
        word, bit = found["words"][start + (at >> 6)], (at & 63).astype(np.uint64)
        hit = (word >> bit & np.uint64(1)).astype(bool)
        below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        out[left[hit]] = found["before"][start + (at[hit] >> 6)] + np.bitwise_count(below)
        left, start = left[~hit], start + size // 64
    return out


def find(found: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The value of each key; -1 for a key that is not in the set."""
    if not len(found["keys"]):
        return np.full(len(keys), -1, dtype=np.int64)
    values = _values(found, keys)
    return np.where(found["keys"][values] == keys, values, -1)

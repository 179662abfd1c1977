"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

A column's UTF-8 buffer is scanned once for all of its texts: byte classes give the word
boundaries, a polynomial over the bytes gives 64-bit word hashes, and the same polynomial over
word hashes gives hashes of windows. Two equal words or windows always have equal hashes; two
different ones agree with a chance of about 2**-64 per pair.

Arrays are cut into runs of whole texts of at most `CHUNK` bytes (one longer text is a run of its
own), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

#: Bytes that part words: blank and 9 to 13.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that part words: all of ASCII but digits and small letters (taken after lower-casing).
NOT_ALPHANUMERIC = np.zeros(256, dtype=bool)
NOT_ALPHANUMERIC[:0x80] = True
NOT_ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(kind: str, count: int) -> np.ndarray:
    """The first `count` powers of the base ("up") or of its inverse ("down")."""
    known = _powers.get(kind)
    if known is None or len(known) < count:
        size = 1 << max(16, int(count - 1).bit_length())
        known = np.full(size, _BASE if kind == "up" else _BACK, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers.clear() if size > 1 << 24 else None  # one very long text leaves no table behind
        _powers[kind] = known
    return known[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums modulo 2**64 of values times rising powers of the base, from 0 on."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers("up", len(values)), out=out[1:])
    return out


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash for each `width` successive values (64-bit), at the position of the first."""
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = _sums(values)
    return mix((sums[width:] - sums[:-width]) * powers("down", count) + np.uint64(width))


@dataclass
class Words:
    """The words of a run of texts: `first[i]:first[i+1]` are those of text i."""

    data: np.ndarray  # the bytes, after lower-casing if asked for
    starts: np.ndarray  # of each word, in data
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # of the texts, in data
    at: int  # the run's first text in its column

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    @cached_property
    def hashes(self) -> np.ndarray:
        sums = _sums(self.data.astype(np.uint64) + np.uint64(1))
        lengths = (self.ends - self.starts).astype(np.uint64)
        down = powers("down", len(self.data) + 1)
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (lengths << np.uint64(32)))

    @cached_property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    wide = pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8), at


def runs(column: pa.Array, parting: np.ndarray = BLANKS, lower: bool = True) -> Iterator[Words]:
    """The words of a text column, in runs of whole texts. Nulls and blank texts have no words."""
    if not len(column):
        return
    data, at = _buffers(column)
    low = 0
    while low < len(at) - 1:
        high = max(low + 1, int(np.searchsorted(at, at[low] + CHUNK, side="right")) - 1)
        yield _scan(data[at[low] : at[high]], at[low : high + 1] - at[low], parting, lower, low)
        low = high


def _scan(data: np.ndarray, at: np.ndarray, parting: np.ndarray, lower: bool, low: int) -> Words:
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(parting[data], out=inside[1:-1])
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    joint = at[1:-1]  # a word ends where its text does
    joint = joint[(joint > 0) & (joint < len(data))]
    met = joint[inside[joint] & inside[joint + 1]]
    begins[met] = True
    stops[met] = True
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops), np.searchsorted(starts, at), at, low)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of its first word) of each window of `width` words inside one text."""
    hashes = window_hashes(words.hashes, width)
    if not len(hashes):
        return hashes, np.empty(0, dtype=np.int64)
    owner = words.owner
    whole = owner[: len(hashes)] == owner[width - 1 :]
    return hashes[whole], np.flatnonzero(whole)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles of each text, by text and then hash.

    A text with fewer words than `width`, but some, has its whole sequence as one shingle.
    """
    hashes, position = windows(words, width)
    owner = words.owner[position]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        more = np.empty(len(short), dtype=np.uint64)
        for k, text in enumerate(short):
            more[k] = window_hashes(words.hashes[words.first[text] : words.first[text + 1]], int(counts[text]))[0]
        hashes, owner = np.concatenate([hashes, more]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]

"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of bytes other than space and 0x09-0x0D, which are exactly the words
`[^\\x20\\x09-\\x0D]+` of the text. Lower-casing changes A-Z alone. A word's fingerprint is 64 bits: a
polynomial over its bytes modulo 2^64, taken from prefix sums, then mixed. Nothing loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that one slice holds, if it holds more than one text; bounds a task's memory.
SLICE_BYTES = 1 << 20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64; kept for the life of the worker, grown on demand."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n, SLICE_BYTES) + 1, np.uint64(base & _MASK))
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Texts:
    """Some neighbouring rows of a batch: their bytes end to end, and where each text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in slices of at most `limit` bytes or one text; null is empty."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = offsets[first], offsets[last]
        yield Texts(first, data[low:high], offsets[first : last + 1] - low)
        first = last


@dataclass
class Words:
    """The words of a slice in order: bounds in `data`, row within the slice, fingerprint.

    `first_of[i]` is the number of words before row i, so row i has words first_of[i]:first_of[i+1].
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first_of: np.ndarray
    prefix: np.ndarray

    def hashes(self, length: int | None = None) -> np.ndarray:
        """Fingerprints of the words, or of their first `length` bytes (whole shorter words)."""
        end = self.end if length is None else np.minimum(self.end, self.start + length)
        raw = (self.prefix[end] - self.prefix[self.start]) * powers(_INVERSE, len(self.data))[self.start]
        return mix(raw)


def words(texts: Texts, lower: bool = True) -> Words:
    """Split a slice into words."""
    data = LOWER[texts.data] if lower else texts.data
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    starts = texts.offsets[:-1]
    starts = starts[starts < texts.offsets[1:]]  # of texts that aren't empty
    begins[starts] = inside[starts]
    lasts = texts.offsets[1:][texts.offsets[:-1] < texts.offsets[1:]] - 1
    ends[lasts] = inside[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first_of = np.searchsorted(start, texts.offsets)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[: len(data)], out=prefix[1:])
    row = np.repeat(np.arange(len(texts)), np.diff(first_of))
    return Words(data, start, end, row, first_of, prefix)


def one_hash(word: bytes) -> int:
    """The fingerprint of one word, as Words.hashes gives it."""
    raw = sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(word)) & _MASK
    return int(mix(np.array([raw], np.uint64))[0])


def shingles(found: Words, size: int) -> list[np.ndarray]:
    """Of each row, the sorted distinct fingerprints of its `size`-word shingles.

    A row with fewer words has its whole sequence as one shingle; without words it has none.
    """
    h = found.hashes()
    n = len(h) - size + 1
    wide = np.full(max(n, 0), size, np.uint64)
    for j in range(size if n > 0 else 0):
        wide = mix(wide + h[j : n + j])
    out = []
    for a, b in zip(found.first_of[:-1].tolist(), found.first_of[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(wide[a : b - size + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                one = mix(one + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out

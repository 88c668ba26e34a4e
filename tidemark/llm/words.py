"""Words of many texts at once, as 64-bit hashes, in numpy.

Texts arrive as Arrow strings: one buffer of UTF-8 bytes and offsets.  A-Z is
lowered by a table, word borders are found by comparing neighbouring bytes, and
all words are hashed from prefix sums of a polynomial.  Equality of words (and
of n-grams of words) is equality of these 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Text bytes handled at a time; a longer text is handled alone.
SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Separators of whitespace words: fixed values of the contracts.
WHITESPACE = np.zeros(256, dtype=bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True
# Separators of letter-and-digit words: ASCII other than 0-9, a-z (and A-Z, lowered).
NOT_WORD = np.zeros(256, dtype=bool)
NOT_WORD[0x00:0x30] = NOT_WORD[0x3A:0x61] = NOT_WORD[0x7B:0x80] = True


class _Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
            for a, base in ((up, _BASE), (down, _BASE_INV)):
                a[0] = 1
                k = 1
                while k < size:
                    a[k:2 * k] = a[:k] * U64(pow(base, k, 1 << 64))
                    k *= 2
            self.up, self.down = up, down
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's last steps)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def cuts_by(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes sum to about ``limit``; a larger row stands alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes."""
    return cuts_by(np.diff(offsets_of(texts)), limit)


def offsets_of(texts: pa.Array) -> np.ndarray:
    wide = texts.type in (pa.large_string(), pa.large_binary())
    kind = np.int64 if wide else np.int32
    if len(texts) == 0:
        return np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if texts.null_count:  # a null text counts as empty
        sizes = np.where(np.asarray(texts.is_valid()), np.diff(off), 0)
        if sizes.sum() != off[-1] - off[0]:
            raise ValueError("null strings with bytes")
    return off


def lowered_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with A-Z lowered, and offsets from 0."""
    off = offsets_of(texts)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]
    return _LOWER[raw], off - off[0]


def spans(data: np.ndarray, off: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its
    first word (one more entry than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~separators[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: pa.Array, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each text's first index into them."""
    data, off = lowered_bytes(texts)
    starts, ends, at = spans(data, off, separators)
    return hashes(data, starts, ends), at


def hash_words(words: list[str], separators: np.ndarray) -> np.ndarray:
    """Hashes of given single words."""
    h, at = word_hashes(pa.array(words, pa.string()), separators)
    if len(h) != len(words):
        raise ValueError("not single words")
    return h


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive entries (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out += h[k:len(h) - n + 1 + k] * U64(pow(_BASE, 2 * k + 3, 1 << 64))
    return mix(out)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start+1, ... of the given lengths."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(starts - (ends - counts), counts)
    return out

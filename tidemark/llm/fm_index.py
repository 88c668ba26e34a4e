"""FM-index of a sequence of integer symbols, in numpy.

Suffix array by prefix doubling (only tied suffixes are sorted again), its
Burrows-Wheeler transform in a wavelet matrix with rank counts, and suffix
positions sampled at every SAMPLE-th place of the sequence.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import ragged

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; its last symbol is 0 and occurs once."""
    n = len(text)
    bits = max(int(text.max()).bit_length(), 1)
    depth = max(62 // bits, 1)
    padded = np.concatenate([text.astype(np.int64), np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = (key << bits) | padded[k:k + n]
    sa = np.argsort(key)
    key = key[sa]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    # a suffix's rank is the place where its group of equals begins
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n, np.int64)
    rank[sa] = group
    single = new & np.concatenate([new[1:], [True]])
    tied = np.flatnonzero(~single)
    while len(tied):
        at = sa[tied]
        after = np.minimum(at + depth, n - 1)  # beyond the end: the end symbol's rank, 0
        order = np.argsort(rank[at] * (n + 1) + rank[after])
        at = at[order]
        first, second = rank[at], rank[after[order]]
        sa[tied] = at
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank[at] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]]
        single = new & np.concatenate([new[1:], [True]])
        tied = tied[~single]
        depth *= 2
    return sa


class FMIndex:
    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.levels = max(int(text.max()).bit_length(), 1)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=(1 << self.levels)))])
        self.zeros: list[np.ndarray] = []  # per level: zero bits among the first i
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            one = ((row >> level) & 1).astype(bool)
            count = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=count[1:], dtype=np.int32)
            self.zeros.append(count)
            row = np.concatenate([row[~one], row[one]])
        marked = sa % SAMPLE == 0
        self.marked = marked
        self.mark_rank = np.cumsum(marked, dtype=np.int32)
        self.places = sa[marked].astype(np.int64)

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row of ``symbol`` plus its rank among the first ``at`` rows."""
        start = np.zeros(len(at), np.int64)
        for count, level in zip(self.zeros, range(self.levels - 1, -1, -1)):
            zero = ((symbol >> level) & 1) == 0
            low, first = count[at], count[start]
            total = count[-1]
            at = np.where(zero, low, total + at - low)
            start = np.where(zero, first, total + start - first)
        return self.before[symbol] + at - start

    def _symbol(self, row: np.ndarray) -> np.ndarray:
        """The symbol before the suffix of each row."""
        out = np.zeros(len(row), np.int64)
        for count in self.zeros:
            zero = count[row + 1] > count[row]
            out = 2 * out + ~zero
            row = np.where(zero, count[row], count[-1] + row - count[row])
        return out

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows lo..hi of the suffixes that begin with each phrase.  Row k of
        ``phrases`` holds ``sizes[k]`` symbols, aligned to the right."""
        n = len(self.marked)
        lo, hi = np.zeros(len(sizes), np.int64), np.full(len(sizes), n, np.int64)
        width = phrases.shape[1]
        for k in range(width):
            live = np.flatnonzero((sizes > k) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - k]
            absent = symbol >> self.levels > 0
            hi[live[absent]] = lo[live[absent]]
            live, symbol = live[~absent], symbol[~absent]
            lo[live], hi[live] = self._step(symbol, lo[live]), self._step(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes at these rows."""
        out = np.empty(len(rows), np.int64)
        todo, row, walked = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            there = self.marked[row]
            out[todo[there]] = self.places[self.mark_rank[row[there]] - 1] + walked
            todo, row = todo[~there], row[~there]
            row = self._step(self._symbol(row), row)
            walked += 1
        return out

    def find(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and place of every occurrence."""
        lo, hi = self.search(phrases, sizes)
        count = hi - lo
        return np.repeat(np.arange(len(sizes)), count), self.locate(ragged(lo, count))

"""Canonical length-limited Huffman codes, and their bit streams, in numpy."""

from __future__ import annotations

import numpy as np

# Longest code unless more ids are used than it can tell apart: a decoding table
# has 2 ** (longest code) entries.
MAX_BITS = 16
# Ids between two recorded bit offsets.
CHECKPOINT_IDS = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts, by
    package-merge; one symbol alone gets length 1.  Zero counts get 0."""
    used = np.flatnonzero(counts > 0)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << max_bits:
        raise ValueError("more symbols than codes")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    n = len(used)
    # Each level merges the symbols with pairs of the level below.  To read the
    # solution back, a level keeps how many of its first k items are symbols.
    levels = []
    below = np.zeros(0, np.int64)
    for _ in range(max_bits):
        items = np.concatenate([weight, below])
        order = np.argsort(items, kind="stable")
        levels.append(np.concatenate([[0], np.cumsum(order < n)]))
        items = items[order]
        pairs = len(items) // 2
        below = items[0:2 * pairs:2] + items[1:2 * pairs:2]
    take = 2 * n - 2
    for symbols in reversed(levels):
        k = int(symbols[take])
        out[used[:k]] += 1
        take = 2 * (take - k)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol): the lengths alone define them."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    if not len(order):
        return codes
    size = lengths[order].astype(np.int64)
    top = int(size[-1])
    filled = np.cumsum(1 << (top - size)) - (1 << (top - size))
    codes[order] = filled >> (top - size)
    return codes


class Codec:
    """Codes and decoding table of given lengths."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.bits = max(int(lengths.max(initial=1)), 1)
        # bytes that a code can touch, wherever in a byte it begins
        self.reach = (self.bits + 14) // 8
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.step = np.ones(1 << self.bits, np.uint8)
        order = np.flatnonzero(lengths)
        order = order[np.argsort(lengths[order], kind="stable")]
        spread = 1 << (self.bits - self.lengths[order])
        held = int(spread.sum())
        self.symbol[:held] = np.repeat(order, spread)
        self.step[:held] = np.repeat(self.lengths[order], spread)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all documents' ids, each document from a whole byte on;
        bytes of each document; bit offsets (from the document's first byte) of
        ids 0, CHECKPOINT_IDS, ... of each; and how many offsets each has."""
        size = self.lengths[ids]
        if len(size) and not size.min():
            raise ValueError("an id without a code")
        ends = np.concatenate([[0], np.cumsum(size)])
        first = np.concatenate([[0], np.cumsum(counts)])
        base = ends[first[:-1]]
        doc_bytes = (ends[first[1:]] - base + 7) // 8
        byte_at = np.cumsum(doc_bytes) - doc_bytes
        pos = ends[:-1] + np.repeat(8 * byte_at - base, counts)
        buf = np.zeros(int(doc_bytes.sum()) + self.reach, np.uint32)
        if len(ids):
            word = self.codes[ids].astype(self._word()) << (8 * self.reach - (pos & 7) - size).astype(self._word())
            at = pos >> 3
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            word, at = np.add.reduceat(word, cut), at[cut]
            for k in range(self.reach):
                buf[at + k] += ((word >> (8 * (self.reach - 1 - k))) & 0xFF).astype(np.uint32)
        marks = (counts + CHECKPOINT_IDS - 1) // CHECKPOINT_IDS
        of = np.repeat(np.arange(len(counts)), marks)
        k = np.arange(int(marks.sum())) - np.repeat(np.cumsum(marks) - marks, marks)
        offsets = pos[first[:-1][of] + k * CHECKPOINT_IDS] - 8 * byte_at[of]
        return buf[:-self.reach].astype(np.uint8), doc_bytes, offsets, marks

    def _word(self) -> type:
        return np.uint32 if self.reach <= 4 else np.uint64

    def decode(self, data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of the stretches that begin at the bit ``offsets`` and hold
        ``counts`` ids each; all stretches advance together."""
        out = np.zeros(int(counts.sum()), np.uint32)
        if not len(out):
            return out
        kind = self._word()
        words = np.zeros(len(data) + 1, kind)
        for k in range(self.reach):  # the bytes from each place on, as one number
            tail = data[k:]
            words[:len(tail)] |= tail.astype(kind) << kind(8 * (self.reach - 1 - k))
        order = np.argsort(-counts, kind="stable")
        pos, left = offsets[order].astype(np.int64), counts[order]
        to = (np.cumsum(counts) - counts)[order]
        live = len(left) - np.searchsorted(left[::-1], np.arange(1, left[0] + 1))
        mask = kind((1 << self.bits) - 1)
        for k in range(int(left[0])):
            n = int(live[k])
            p = pos[:n]
            window = (words[p >> 3] >> (8 * self.reach - self.bits - (p & 7)).astype(kind)) & mask
            out[to[:n] + k] = self.symbol[window]
            p += self.step[window]
        return out

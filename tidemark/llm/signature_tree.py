"""Signature trees over token sets, and their dual traversal, in numpy.

A set's signature is a bitmap of its hashed tokens.  Leaves hold single sets
ordered by size; a node holds the OR of its children's bitmaps, the range of
their sizes and their largest slack (tokens beyond set bits, as tokens share
bits).  The overlap of any set below one node with any below another is at most
the common bits of the two bitmaps plus the smaller slack; a pair of nodes whose
bound misses the overlap that the similarity asks for is dropped.
"""

from __future__ import annotations

import numpy as np

BITS = 2048
FANOUT = 4
# Bitmaps compared at a time.
PAIRS = 1 << 15


class SignatureTree:
    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sets], np.int64)
        lead = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        # similar sizes, and within them equal smallest tokens, share nodes
        self.order = np.lexsort((lead, np.frexp(sizes.astype(float))[1]))
        rows = np.repeat(np.arange(len(sets)), sizes[self.order])
        token = np.concatenate([sets[i] for i in self.order]) if len(sets) else np.zeros(0, np.uint64)
        bit = (token * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
        cells = np.zeros((len(sets), BITS), bool)
        cells[rows, bit] = True
        maps = np.packbits(cells, axis=1).view(np.uint64)
        low = sizes[self.order]
        slack = low - cells.sum(axis=1)
        # levels from the leaves up; children of node k are FANOUT*k ...
        self.levels = [(maps, low, low, slack)]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, slack = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.maximum.reduceat(slack, cut)))


def _kept(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which node pairs may hold sets of similarity num / den or more."""
    (maps_a, low_a, high_a, slack_a), (maps_b, low_b, high_b, slack_b) = a, b
    keep = (den * high_a[i] >= num * low_b[j]) & (den * high_b[j] >= num * low_a[i])
    at = np.flatnonzero(keep)
    for k in range(0, len(at), PAIRS):
        part = at[k:k + PAIRS]
        x, y = i[part], j[part]
        common = np.bitwise_count(maps_a[x] & maps_b[y]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(slack_a[x], slack_b[y])
        # overlap * (num + den) >= num * (size + size)
        keep[part] = most * (num + den) >= num * (low_a[x] + low_b[y])
    return keep


def candidates(a: SignatureTree, b: SignatureTree | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Set numbers of the pairs that the dual traversal cannot rule out; with
    ``b`` None, pairs of different sets of ``a``, each once."""
    own = b is None
    b = a if own else b
    depth = max(len(a.levels), len(b.levels))
    la = a.levels + [a.levels[-1]] * (depth - len(a.levels))
    lb = b.levels + [b.levels[-1]] * (depth - len(b.levels))
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(depth - 1, -1, -1):
        keep = _kept(la[level], lb[level], i, j, num, den)
        i, j = i[keep], j[keep]
        if level == 0 or not len(i):
            break
        i, j = _children(i, j, level < len(a.levels), level < len(b.levels), len(la[level - 1][1]), len(lb[level - 1][1]))
        if own:
            upper = i <= j
            i, j = i[upper], j[upper]
    if own:
        i, j = i[i != j], j[i != j]
    return a.order[i], b.order[j]


def _children(i: np.ndarray, j: np.ndarray, down_a: bool, down_b: bool, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(FANOUT)
    ci = (i[:, None] * FANOUT + k) if down_a else i[:, None]
    cj = (j[:, None] * FANOUT + k) if down_b else j[:, None]
    ci, cj = np.broadcast_arrays(ci[:, :, None], cj[:, None, :])
    ci, cj = ci.reshape(-1), cj.reshape(-1)
    there = (ci < n_a) & (cj < n_b)
    return ci[there], cj[there]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common entries of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Forest:
    """Union of linked nodes; the smaller number leads."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def link(sets: list[np.ndarray], labels: list, left: np.ndarray, right: np.ndarray | None, num: int, den: int) -> Forest:
    """Joins sets (and sets of one label) that are linked directly or through
    others: the sets numbered ``left`` among themselves, or with those of
    ``right``.  Pairs already joined are not compared."""
    forest, seen = Forest(len(sets)), {}
    for k, label in enumerate(labels):
        forest.join(seen.setdefault(label, k), k)
    a = SignatureTree([sets[k] for k in left])
    b = None if right is None else SignatureTree([sets[k] for k in right])
    i, j = candidates(a, b, num, den)
    for x, y in zip(left[i].tolist(), (left if right is None else right)[j].tolist()):
        if forest.find(x) != forest.find(y):
            common = overlap(sets[x], sets[y])
            if den * common >= num * (len(sets[x]) + len(sets[y]) - common):
                forest.join(x, y)
    return forest

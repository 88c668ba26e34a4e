"""Hard negatives against a search of all pairs."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import hard_negatives as N
from tidemark.llm.common import written

DDL = "vec_id long, embedding array<float>, label int, ids string, low int, tile int"


def table(spark, rows):
    return written(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL).coalesce(2), "given-vectors")


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95, scale=256):
    known = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(scale * float(np.float32(x))) for x in v]
        known[i] = min(known.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, v) in known.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in known.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if known[i][0] == label][:positives]:
            fits = [i for i in order if known[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:negatives])]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in N.mine_hard_negatives(df, **options).collect())


def clustered(rng, n, labels, size=8, copies=0):
    centres = [[rng.gauss(0, 0.4) for _ in range(size)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]
    return rows + [(n + i, rows[0][1], i % 2) for i in range(copies)]


def test_places_follow_the_curve():
    """Neighbours on the curve are neighbours in space, and every cell has one place."""
    side = 8
    cells = np.array([(x, y) for x in range(side) for y in range(side)])
    order = sorted(zip(N.hilbert_places(cells, 3), map(tuple, cells.tolist())))
    assert len({p for p, _ in order}) == side * side
    assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for (_, a), (_, b) in zip(order, order[1:]))
    cube = np.array([(x, y, z) for x in range(4) for y in range(4) for z in range(4)])
    walk = [c for _, c in sorted(zip(N.hilbert_places(cube, 2), cube.tolist()))]
    assert all(sum(abs(p - q) for p, q in zip(a, b)) == 1 for a, b in zip(walk, walk[1:]))


def test_bounds_hold_for_every_vector_of_a_block():
    rng = np.random.default_rng(1)
    q, b = rng.integers(-300, 300, (20, 16)), rng.integers(-300, 300, (50, 16))
    least, most = N.score_bounds(np.maximum(q, 0), np.minimum(q, 0), b.min(axis=0)[None], b.max(axis=0)[None])
    s = q @ b.T
    assert (least[:, 0] <= s.min(axis=1)).all() and (most[:, 0] >= s.max(axis=1)).all()


@pytest.mark.parametrize("every, labels, copies", [(50, 3, 0), (7, 2, 300), (1, 4, 5)])
def test_against_all_pairs(spark, every, labels, copies):
    """Small blocks and tiles, so that many are made, pruned and joined again."""
    rows = clustered(random.Random(every), 400 if every > 1 else 150, labels, copies=copies)
    want = brute(rows, every=every)
    assert mined(table(spark, rows), every=every, block=16, tile=20, held=200) == want != []


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Far clusters: the windows of an anchor meet few blocks, and the answer is whole."""
    read = []
    written_ = N.written

    def watch(df, name):
        out = written_(df, name)
        if name == "blocks-to-read":
            read.append(out.count())
        elif name == "vector-blocks":
            read.append(out.count())
        return out

    monkeypatch.setattr(N, "written", watch)
    rng = random.Random(4)
    rows = []
    for i in range(2000):
        k = i % 8
        rows.append((i, [float(np.float32((3.0 if j == k else 0.0) + rng.gauss(0, 0.02))) for j in range(8)], rng.randrange(2)))
    assert mined(table(spark, rows), every=400, block=32) == brute(rows, every=400)
    blocks, same, other = read
    assert blocks >= 60 and same < blocks and other < blocks


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = clustered(random.Random(8), 120, 2)
    odd = [(50, None, 1), (51, [1.0, None], 1), (52, [nan, 1.0], 0), (53, [inf, 1.0], 0), (54, [0.5, 0.5], None), (None, [0.5, 0.5], 1),
           (55, [], 1), (100, [0.5], 0), (-50, [0.3] * 12, 0), (56, [0.25] * 8, 1), (56, [0.25] * 8, 1), (0, [-0.2] * 8, 1), (0, [0.2] * 8, 0)]
    rows = [r for r in good if r[0] not in {0, 50, 51, 52, 53, 54, 55, 56, 100}] + odd
    df = table(spark, rows)
    assert mined(df) == brute(rows) != []
    assert mined(df.limit(0)) == []
    assert mined(df.filter("label is null")) == []
    assert mined(table(spark, [(0, [1.0], 1)])) == []
    assert mined(table(spark, [(0, [-1.0], 1), (1, [1.0], 1), (2, [0.9], 0)])) == []


def test_large_components_are_exact_or_refused(spark):
    rows = [(i, [float(np.float32(x)) for x in (3e4 * (i % 7) + i, 1e4 * (i % 5), -2e3 * i)], i % 2) for i in range(60)]
    assert mined(table(spark, rows), every=10) == brute(rows, every=10) != []
    with pytest.raises(ValueError, match="64 bits"):
        N.mine_hard_negatives(table(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)]))

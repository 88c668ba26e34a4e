"""Periodic runs against a search over all periods."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import crc
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries as Q
from tidemark.llm.common import written
from tidemark.llm.periodic_runs import _found, find_runs, run_digests, runs_of

SF = "/root/testdata/sf0.001"


def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if w[p:] == w[:len(w) - p])


def plain_runs(w, least=12):
    """All runs by trying every period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least and smallest_period(w[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out)


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


def planted(doc_id, words):
    h, n = crc(doc_id), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([2, 5, 12]))
def test_runs_of_short_alphabets(words, least):
    assert runs_of(words, least) == plain_runs(words, least)


@pytest.mark.parametrize("words", [
    list("abcabcabcabcab"), ["x"] * 200, list("abaababaabaababaababaabaababaabaab"), list("aabaabaabaab" * 3 + "c" + "aab" * 9),
    [str(i) for i in range(40)] * 2, [str(i % 7) for i in range(50)] + ["z"] + [str(i % 11) for i in range(60)]])
def test_runs_of_known_shapes(words):
    assert runs_of(words) == plain_runs(words)


def test_texts_at_once_are_searched_as_each_alone():
    """Repeats within, across and far apart in texts, with odd white space."""
    rng = random.Random(5)
    texts = []
    for k in range(300):
        words = [rng.choice("abcdefgh") * rng.choice([1, 1, 2]) for _ in range(rng.randint(0, 80))]
        if k % 3 == 0 and words:
            a, p = rng.randrange(len(words)), rng.randint(1, 15)
            words = words[:a] + (words[a:a + p] * 9)[:rng.randint(1, 90)] + words[a:]
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t\r\n", "\x0b"]) for w in words))
    n, runs, collapsed = _found(pa.array(texts), 12)
    for t, size, got, kept in zip(texts, n, runs, collapsed):
        words = split(t)
        assert size == len(words)
        assert [(r["start"], r["length"], r["period"]) for r in got] == plain_runs(words)
        assert hashlib.sha256(kept.encode()).hexdigest() == plain_row(words)[-1]
    assert sum(map(bool, runs)) > 50


def test_long_periodic_text_takes_time_in_proportion():
    words = [str(i) for i in range(3000)] * 20
    assert runs_of(words) == [(0, 60_000, 3000)]
    assert runs_of(["a"] * 60_000) == [(0, 60_000, 1)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 5000:
        fib.append(fib[-1] + fib[-2])
    assert len(runs_of(list(fib[-1]))) > 1000


def test_odd_rows(spark, odd, empty):
    got = run_digests(find_runs(odd)).collect()
    want = [(r.doc_id, *plain_row(split(r.text))) for r in odd.collect() if len(r.text or "") < 5000]
    short = [tuple(r) for r in got]
    for row in want:
        assert row in short
    assert len(got) == odd.count() and find_runs(empty).collect() == []
    renamed = odd.select("doc_id", "text", "row").withColumnRenamed("doc_id", "runs").withColumnRenamed("text", "collapsed")
    assert len(find_runs(renamed, "runs", "collapsed").collect()) == len(got)


def test_words_are_equal_by_their_bytes(spark):
    rows = [(1, "É é " * 6), (2, "A a " * 6), (3, " x " * 12), (4, "a b " * 8)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "bytes")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in find_runs(docs).collect()}
    assert got == {1: [(0, 12, 2)], 2: [(0, 12, 2)], 3: [(0, 12, 1)], 4: []}


def test_query_against_brute_force(spark):
    given_ = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = Q.queries()["op13_periodic_runs"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(given_)
    some = 0
    for r in rows:
        words = planted(r.doc_id, split(given_[r.doc_id]))
        if len(words) <= 1500:
            some += r.n_runs > 0
            assert tuple(r) == (r.doc_id, *plain_row(words))
    assert some >= 10 and np.sum([r.n_runs for r in rows]) > some

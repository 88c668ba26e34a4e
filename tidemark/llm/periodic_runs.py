"""Periodic runs of words, by a suffix automaton with link-cut access.

Words are appended to a suffix automaton one by one.  Its suffix links form a
tree that is kept as preferred paths (splay trees); a path's colour is the last
place at which its strings ended.  Appending a word exposes the path from the
root to the new prefix: where that path enters a segment of colour c at a state
of length l, the l words that end here ended at c too.  If the distance d = here
- c is at most l, the last l + d words hold a square of period d.  d is then the
smallest period, as the colour is the latest end; and every square's first end
meets it.  The stretch is extended to both sides as far as the period holds, and
the exposed path is recoloured.

Most words of a text can be in no run: a run of ``min_length`` words or more lies
within words covered by runs of ``min_length / 2`` words that occur twice.  Texts
are searched for these first, by hashes and many at a time, and again within
what is left; only the stretches that remain are appended to an automaton.
That loses nothing, as a run lies in one stretch as a whole.

Texts are handled row by row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code
from tidemark.llm.words import U64, WHITESPACE, hashes, mix, ngram_hashes, offsets_of, slices, spans

MIN_LENGTH = 12
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class LastEnds:
    """Suffix automaton of a growing sequence, with the last end of every state.

    States are numbers.  ``left``, ``right`` and ``up`` hold the splay trees of
    the preferred paths; the ``up`` of a splay root is the state above its
    path.  ``colour`` counts at splay roots only.
    """

    def __init__(self) -> None:
        self.length, self.link, self.step = [0], [-1], [{}]
        self.left, self.right, self.up, self.colour = [-1], [-1], [-1], [-1]
        self.last, self.count = 0, 0

    def _state(self, length: int, link: int, step: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.left.append(-1)
        self.right.append(-1)
        self.up.append(link)
        self.colour.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree; it takes over the colour."""
        left, right, up = self.left, self.right, self.up
        top = x
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                break
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                if (left[g] == p) == (left[p] == x):
                    self._rotate(p)
                else:
                    self._rotate(x)
                top = g
            else:
                top = p
            self._rotate(x)
        self.colour[x] = self.colour[top]

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _extend(self, word: int) -> int:
        """The state of the whole sequence after ``word`` is appended."""
        length, link, step = self.length, self.link, self.step
        new = self._state(length[self.last] + 1, -1, {})
        p = self.last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p < 0:
            above = 0
        else:
            above = step[p][word]
            if length[above] != length[p] + 1:
                above = self._split(p, word, above)
        link[new] = self.up[new] = above
        self.last = new
        return new

    def _split(self, p: int, word: int, old: int) -> int:
        """A state for the shorter strings of ``old``, just above it.  They ended
        last where those of ``old`` did, so it joins the same path."""
        length, link, step, left, up = self.length, self.link, self.step, self.left, self.up
        short = self._state(length[p] + 1, link[old], step[old].copy())
        while p >= 0 and step[p].get(word) == old:
            step[p][word] = short
            p = link[p]
        link[old] = short
        self._splay(old)
        left[short] = left[old]
        if left[short] >= 0:
            up[left[short]] = short
        left[old], up[short] = short, old
        return short

    def append(self, word: int) -> list[tuple[int, int]]:
        """Append a word; ``(distance, length)`` of each segment of the exposed
        path whose strings overlap or touch their last occurrence."""
        here, found = self.count, []
        self.count += 1
        left_of, x, below = self.length, self._extend(word), -1
        right, up, colour = self.right, self.up, self.colour
        while x >= 0:
            self._splay(x)
            end = colour[x]
            if 0 <= end and here - end <= left_of[x]:
                found.append((here - end, left_of[x]))
            if right[x] >= 0:  # what is deeper stays a path of the old colour
                colour[right[x]] = end
            right[x] = below
            below, x = x, up[x]
        colour[below] = here
        return found


def runs_of(words: list, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of hashable words, by start and
    period: stretches with smallest period q, as long as possible, of at least
    ``min_length`` and 2 q words."""
    ends, known, out, n = LastEnds(), {}, [], len(words)
    number: dict = {}
    seq = [number.setdefault(w, len(number)) for w in words]
    for here, word in enumerate(seq):
        for period, length in ends.append(word):
            if here < known.get(period, 0):  # within the last run of this period
                continue
            start, end = here + 1 - length - period, here + 1
            while start > 0 and seq[start - 1] == seq[start - 1 + period]:
                start -= 1
            while end < n and seq[end] == seq[end - period]:
                end += 1
            known[period] = end
            if end - start >= min_length:
                out.append((start, end - start, period))
    return sorted((s, k, p) for s, k, p in out)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def stretches(h: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """Word ranges (over all texts) outside of which there is no run.  ``h`` are
    the words' hashes, ``at`` the texts' first words."""
    n = (min_length + 1) // 2
    place = np.arange(len(h))
    group = np.searchsorted(at[1:], place, side="right")  # the text, later the stretch
    while len(place):
        grams = ngram_hashes(h[place], n)
        inside = group[n - 1:] == group[:len(group) - n + 1]
        first = np.flatnonzero(inside)
        first = first[_repeated(mix(grams[first] + group[first].astype(np.uint64) * U64(0x9E3779B97F4A7C15)))]
        edge = np.zeros(len(place) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + n, -1)
        covered = np.cumsum(edge[:-1]) > 0
        begins = covered.copy()
        begins[1:] &= ~covered[:-1] | (group[1:] != group[:-1])
        number = np.cumsum(begins)  # of the stretch, where covered
        size = np.bincount(number[covered], minlength=1)
        stays = covered & (size[number] >= min_length)
        if stays.all():
            break
        place, group = place[stays], number[stays]
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(place) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(place)) if len(begins) else begins
    return list(zip(place[begins].tolist(), (place[ends - 1] + 1).tolist()))


def _found(texts: pa.Array, min_length: int) -> tuple[list[int], list[list[dict]], list[str]]:
    """Per text: words, runs, and the text without the words that runs repeat."""
    off = offsets_of(texts)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    starts, ends, at = spans(raw, off, WHITESPACE)
    h = hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    runs: list[list[tuple]] = [[] for _ in range(len(texts))]
    data = raw.tobytes()
    for a, b in stretches(h, at, min_length):
        text = int(np.searchsorted(at, a, side="right")) - 1
        words = [data[i:j] for i, j in zip(starts[a:b].tolist(), ends[a:b].tolist())]
        shift = a - int(at[text])
        runs[text] += [(s + shift, k, p) for s, k, p in runs_of(words, min_length)]
    collapsed = []
    for k, found in enumerate(runs):
        words = data[off[k]:off[k + 1]].split()
        if found:
            drop = np.zeros(len(words) + 1, np.int64)
            for s, size, period in found:
                drop[s + period] += 1
                drop[s + size] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(words).decode())
    named = [[{"start": s, "length": k, "period": p} for s, k, p in found] for found in runs]
    return np.diff(at).tolist(), named, collapsed


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    Words are separated by ASCII white space and equal when their bytes are.
    ``runs`` are ``(start, length, period)`` in words, counted from 0, in order
    of start and period.  ``collapsed`` is the text's words joined by one space,
    without the words that some run contains after its first ``period`` words.
    A null text counts as empty and has no words and no runs; a null
    identifier stays null; repeated rows are searched each; other columns are
    not read; empty input gives an empty result.
    """
    if min_length < 2:
        raise ValueError("a run has two words at least")
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                n, runs, collapsed = _found(batch.column(1).slice(a, b - a), min_length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(runs, pa.list_(RUN)),
                     pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document of ``find_runs``: ``doc_id, n_runs``, the longest run (of
    equal ones the first, then that of the smallest period; null without a run)
    as ``start, length, period, exponent_milli``, and digests of all runs and of
    the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    best_of = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                           F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    period = -F.col("best.shorter")
    return best_of.select(
        "doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
        F.expr("cast((1000 * best.length) div (-best.shorter) as long)").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

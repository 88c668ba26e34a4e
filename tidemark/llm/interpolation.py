"""Language-model scores by deleted interpolation.

P(w | h) mixes the maximum-likelihood estimates of all orders and a uniform
floor.  The mixture's weights depend on how often the context was seen, by
buckets of powers of two, and are learned by expectation-maximisation on a
deleted part of the training documents, whose own counts are left out while
learning.  Counts of all n-grams come from the whole training part by the
exchange of ``exchange.py``; texts are scored chunk by chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import exchange as X
from tidemark.llm import words as W
from tidemark.llm.common import ship_code, written

FOLDS, HELD_OUT, DELETED = 7, 2, 3
ORDER = 3
KEY_BITS = 48
# Context-frequency buckets: unseen, 1, 2-3, 4-7, ...
BUCKETS = 33
# The learning statistics bin log ratios to the floor in steps of 1/BINS; a bin
# takes RATIO_BITS of a statistic's key, and NO_RATIO stands for an estimate of 0.
BINS, RATIO_BITS = 3, 12
NO_RATIO = -(1 << RATIO_BITS - 1)
EM_ROUNDS = 40
# Hashes of the end token and of the place before a text: not those of words.
END, BEFORE = np.uint64(0x5EED0E4D), np.uint64(0x5EED57A7)
KEPT, TUNED, OUT = 0, 1, 2

SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def fold(ids: pa.Array) -> np.ndarray:
    """Part of each document: counted, counted but deleted while learning the
    weights, or held out."""
    r = np.array([zlib.crc32(("" if i is None else str(i)).encode()) % FOLDS for i in ids.to_pylist()])
    return np.select([r == HELD_OUT, r == DELETED], [OUT, TUNED], KEPT)


class Tokens:
    """Token hashes of a chunk, its distinct n-grams, and each token's place
    among these."""

    def __init__(self, texts: pa.Array, order: int) -> None:
        parts, counts = [], []
        for a, b in W.slices(texts):
            h, at = W.word_hashes(texts.slice(a, b - a), W.WHITESPACE)
            n = np.diff(at)
            parts.append(np.insert(h, at[1:], END))
            counts.append(n + 1)
        self.counts = np.concatenate(counts)
        self.token = np.concatenate(parts)
        first = np.cumsum(self.counts) - self.counts
        self.first = np.zeros(len(self.token), bool)
        self.first[first] = True
        self.starts = first
        self.keys, self.place = [], []
        gram = self.token
        for n in range(1, order + 1):
            if n > 1:  # the n-gram that ends here: that of n-1 one back, and this token
                back = np.concatenate([[BEFORE], gram[:-1]])
                back[self.first] = BEFORE + np.uint64(n)
                gram = W.mix(back * W.U64(0x9E3779B97F4A7C15) + self.token)
            keys, place = np.unique(gram if n == 1 else gram >> np.uint64(64 - KEY_BITS), return_inverse=True)
            self.keys.append(keys)
            self.place.append(place)


def _requests(docs: DataFrame, order: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, fold):
            t = Tokens(chunk.texts(), order)
            for n in range(order):
                count = np.bincount(t.place[n], minlength=len(t.keys[n]))
                none = np.zeros_like(count)
                columns = np.stack([count if chunk.kind == KEPT else none, count if chunk.kind == TUNED else none])
                yield pa.RecordBatch.from_pylist(
                    X.requests(chunk.number, n, t.keys[n], columns, 64 if n == 0 else KEY_BITS, buckets), X.REQUEST)
            texts = len(chunk.ids)
            yield pa.RecordBatch.from_pylist([{
                "chunk": None, "bucket": chunk.number % buckets, "space": -2, "keys": None, "counts": None,
                "stats": [texts if chunk.kind == KEPT else 0, texts if chunk.kind == TUNED else 0]}], X.REQUEST)

    return docs.mapInArrow(run, X.REQUEST_DDL)


def _bodies(docs: DataFrame, kinds: tuple[int, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, fold):
            if chunk.kind in kinds:
                yield pa.RecordBatch.from_pylist([X.body_row(chunk)], X.BODY_SCHEMA)

    return docs.mapInArrow(run, X.BODY_DDL)


def _estimates(t: Tokens, answer: X.Answered, order: int, deleted: bool, tokens: int, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates of every token by order (1..order), and its
    context's count by order (2..order)."""
    estimates, contexts, shorter = [], [], None
    for n in range(order):
        totals = answer.of(n, 2, len(t.keys[n])).astype(np.int64)
        count = (totals[0] if deleted else totals.sum(axis=0))[t.place[n]]
        if n == 0:
            estimates.append(count / max(tokens, 1))
        else:
            context = np.concatenate([[0], shorter[:-1]])
            context[t.first] = texts
            estimates.append(np.divide(count, context, out=np.zeros(len(count)), where=context > 0))
            contexts.append(context)
        shorter = count
    return np.stack(estimates), np.stack(contexts) if contexts else np.zeros((0, len(t.token)), np.int64)


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.minimum(np.frexp(count.astype(float))[1], BUCKETS - 1)


def _learning_rows(tuned: DataFrame, answers: DataFrame, order: int, floor: float, tokens: int, texts: int) -> DataFrame:
    """Numbers of deleted tokens by the longest context's bucket and the binned log
    ratios, packed into one number ``key``."""

    def use(answer: X.Answered) -> pa.RecordBatch:
        t = Tokens(answer.texts, order)
        p, c = _estimates(t, answer, order, True, tokens, texts)
        with np.errstate(divide="ignore"):
            ratio = np.where(p > 0, np.rint(BINS * np.log(p / floor)), NO_RATIO).astype(np.int64)
        key = _bucket(c[-1]).astype(np.int64) if order > 1 else np.zeros(p.shape[1], np.int64)
        for r in ratio:
            key = (key << RATIO_BITS) | (r - NO_RATIO)
        keys, n = np.unique(key, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    return X.with_answers(tuned, answers, 2, use, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def unpacked(keys: np.ndarray, order: int) -> np.ndarray:
    """Bucket and ratios of packed keys, one row each."""
    parts = [(keys >> RATIO_BITS * k & (1 << RATIO_BITS) - 1) + NO_RATIO for k in range(order - 1, -1, -1)]
    return np.stack([keys >> RATIO_BITS * order, *parts], axis=1) if len(keys) else np.zeros((0, order + 1), np.int64)


def learn_weights(keys: np.ndarray, n: np.ndarray, order: int) -> np.ndarray:
    """Weights by context bucket: row b of the result mixes floor and orders
    1..order for the longest context's bucket b.

    ``keys`` holds for each row the longest context's bucket and the binned log
    ratios of orders 1..order to the floor.  Buckets without rows take the
    weights of the nearest bucket below them that has some.
    """
    weights = np.zeros((BUCKETS, order + 1))
    if len(keys):
        bucket, ratio = keys[:, 0], keys[:, 1:].astype(float)
        p = np.concatenate([np.ones((len(keys), 1)), np.where(ratio <= NO_RATIO, 0.0, np.exp(np.maximum(ratio, -600) / BINS))], axis=1)
    for b in range(BUCKETS):
        rows = bucket == b if len(keys) else np.zeros(0, bool)
        if not rows.any():
            weights[b] = weights[b - 1] if b else np.full(order + 1, 1 / (order + 1))
            continue
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(EM_ROUNDS):
            share = w * p[rows]
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[rows, None]).sum(axis=0)
            w = (w + 0.01) / (w + 0.01).sum()  # no estimate is ruled out
        weights[b] = w
    return weights


def mixture(weights: np.ndarray, p: np.ndarray, contexts: np.ndarray, floor: float) -> np.ndarray:
    """Each token's probability.  A context never seen gives its order's weight
    to the others in proportion."""
    order = len(p)
    w = weights[_bucket(contexts[-1]) if order > 1 else np.zeros(p.shape[1], np.int64)].T.copy()
    w[2:] *= contexts > 0
    w /= w.sum(axis=0)
    return w[0] * floor + (w[1:] * p).sum(axis=0)


def score_documents(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Tokens are the white-space words of the text, A-Z lowered, and one end
    token; a null text counts as empty and has the end alone.  Documents whose
    crc32 of the identifier as text leaves 2 modulo 7 (a null identifier:
    empty text) are held out: scored, but not learned from.  ``base_score`` is
    the add-one unigram score in log10, ``score`` the mixture's.  Without any
    training document every estimate is the uniform floor.  Repeated rows count
    and are scored each; empty input gives an empty result.  The rows of
    ``docs`` are read three times and must come in the same order; write the
    result of a shuffle as a table first.
    """
    if not 1 <= order <= 4:
        raise ValueError("orders 1 to 4")
    ship_code(docs.sparkSession)
    buckets = X.bucket_count(docs)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    answers = written(X.answered(_requests(slim, order, buckets), buckets, 2), "lm-answers")

    stats = {r["space"]: r for r in answers.filter(F.col("stats").isNotNull()).groupBy("space").agg(
        *[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(3)]).collect()}
    distinct, kept, tuned = (stats[0]["s0"], stats[0]["s1"], stats[0]["s2"]) if 0 in stats else (0, 0, 0)
    kept_texts, tuned_texts = (stats[-2]["s0"], stats[-2]["s1"]) if -2 in stats else (0, 0)
    floor = 1.0 / (distinct + 1)

    learning = _learning_rows(_bodies(slim, (TUNED,)), answers, order, floor, kept, kept_texts).toPandas()
    keys = unpacked(learning["key"].to_numpy(np.int64), order)
    weights = learn_weights(keys, learning["n"].to_numpy(np.int64), order)
    total, texts = kept + tuned, kept_texts + tuned_texts

    def use(answer: X.Answered) -> pa.RecordBatch:
        t = Tokens(answer.texts, order)
        p, contexts = _estimates(t, answer, order, False, total, texts)
        known = answer.of(0, 2, len(t.keys[0])).sum(axis=0, dtype=np.int64)[t.place[0]]
        base = np.log10((known + 1) / (total + distinct + 1))
        score = np.log10(mixture(weights, p, contexts, floor))
        n = t.counts
        return pa.RecordBatch.from_arrays(
            [pa.array(answer.ids, pa.int64()), pa.array(fold(pa.array(answer.ids, pa.int64())) == OUT), pa.array(n),
             pa.array(np.add.reduceat((known > 0).astype(np.int64), t.starts)),
             pa.array(np.full(len(n), total, np.int64)),
             pa.array(np.add.reduceat(base, t.starts)), pa.array(np.add.reduceat(score, t.starts))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return X.with_answers(_bodies(slim, (KEPT, TUNED, OUT)), answers, 2, use, SCHEMA)

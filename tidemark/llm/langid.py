"""Language identification by a bidirectional gated recurrent network on bytes.

The network is trained on the driver, in numpy, by backpropagation through time
over windows of a bounded sample of labelled texts; every position is labelled.
Texts of any length are cut into windows that overlap by some context, many
windows advance together, and a text's probabilities are the mean of those of
all its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, ship_code
from tidemark.llm.words import cuts_by, offsets_of

HIDDEN = 8
# Defaults of ``Training``.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 300
TRAIN_BYTES, TRAIN_BATCH, TRAIN_STEPS, RATE = 48, 192, 260, 0.015
# Scoring: core bytes of a window, context on either side, windows at a time.
CORE, CONTEXT, ROWS = 256, 16, 2048

# Labels of one network; their counts are broadcast.
MAX_LABELS = 1000

UNKNOWN = "und"
FOLDS = 5
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class Training:
    """What a network learns from, and how long.

    ``sample_docs``: at most so many labelled texts a language, chosen by a hash
    of the identifier; ``sample_chars``: of each one stretch of so many
    characters, at a place hashed from its identifier; ``window_bytes``,
    ``batch``, ``steps``, ``rate``: bytes of a training window, windows a step,
    steps, and the first learning rate; ``hidden``: units a direction.  The
    sample bounds what comes to the driver: ``sample_docs * sample_chars``
    characters a language.  Scoring reads whole texts whatever is set here.
    """

    sample_docs: int = SAMPLE_DOCS
    sample_chars: int = SAMPLE_CHARS
    window_bytes: int = TRAIN_BYTES
    batch: int = TRAIN_BATCH
    steps: int = TRAIN_STEPS
    rate: float = RATE
    hidden: int = HIDDEN


@dataclass
class Network:
    """Per direction: byte inputs (256, 3H), recurrence (H, 3H), its bias for
    the candidate (H); output (2H, K) and its bias.  Gate order: reset,
    update, candidate."""

    labels: list[str]
    inputs: np.ndarray
    recur: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(labels: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.3).astype(np.float32)

        return Network(labels, small(2, 256, 3 * hidden), small(2, hidden, 3 * hidden), small(2, hidden) * 0,
                       small(2 * hidden, len(labels)), small(len(labels)) * 0)

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.bias, self.out, self.out_bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def gradients(net: Network, data: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over positions, and its gradient by every weight.
    ``data`` (B, T) bytes, ``label`` (B,), ``weight`` (B, T) of positions."""
    size, steps = data.shape
    h = net.recur.shape[1]
    # both directions run along axis 0 in their own order of time
    seq = np.stack([data.T, data.T[::-1]])
    state = np.zeros((steps + 1, 2, size, h), np.float32)
    reset, update, cand, hidden_n = (np.empty((steps, 2, size, h), np.float32) for _ in range(4))
    for t in range(steps):
        x = np.stack([net.inputs[0][seq[0, t]], net.inputs[1][seq[1, t]]])
        g = state[t] @ net.recur
        reset[t] = _sigmoid(x[..., :h] + g[..., :h])
        update[t] = _sigmoid(x[..., h:2 * h] + g[..., h:2 * h])
        hidden_n[t] = g[..., 2 * h:] + net.bias[:, None]
        cand[t] = np.tanh(x[..., 2 * h:] + reset[t] * hidden_n[t])
        state[t + 1] = cand[t] + update[t] * (state[t] - cand[t])
    both = np.concatenate([state[1:, 0], state[:0:-1, 1]], axis=-1)
    p = _softmax(both @ net.out + net.out_bias)
    w = (weight / weight.sum()).T
    loss = float(-(w * np.log(p[:, np.arange(size), label] + 1e-9)).sum())
    d = p * w[..., None]
    d[:, np.arange(size), label] -= w
    flat = d.reshape(-1, d.shape[-1])
    d_out, d_out_bias = both.reshape(-1, 2 * h).T @ flat, flat.sum(axis=0)
    d_both = d @ net.out.T
    into = np.stack([d_both[..., :h], d_both[::-1, :, h:]], axis=1)
    d_recur, d_bias = np.zeros_like(net.recur), np.zeros_like(net.bias)
    d_x = np.empty((steps, 2, size, 3 * h), np.float32)
    back = np.zeros((2, size, h), np.float32)
    for t in range(steps - 1, -1, -1):
        dh = into[t] + back
        r, z, n = reset[t], update[t], cand[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (state[t] - n) * z * (1 - z)
        dr = dn * hidden_n[t] * r * (1 - r)
        d_x[t] = np.concatenate([dr, dz, dn], axis=-1)
        dg = np.concatenate([dr, dz, dn * r], axis=-1)
        d_recur += state[t].transpose(0, 2, 1) @ dg
        d_bias += dg[..., 2 * h:].sum(axis=1)
        back = dh * z + dg @ net.recur.transpose(0, 2, 1)
    d_in = np.zeros_like(net.inputs)
    for k in range(2):
        hot = np.zeros((steps * size, 256), np.float32)
        hot[np.arange(steps * size), seq[k].reshape(-1)] = 1
        d_in[k] = hot.T @ d_x[:, k].reshape(steps * size, -1)
    return loss, [d_in, d_recur, d_bias, d_out, d_out_bias]


def train(texts: list[str], langs: list[str], how: Training = Training(), seed: int = 7) -> Network:
    """A network fitted to the texts (each label present equally often in a
    batch) by Adam."""
    rng = np.random.default_rng(seed)
    labels = sorted(set(langs))
    net = Network.fresh(labels, how.hidden, rng)
    if len(labels) < 2:
        return net
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    of = [[i for i, x in enumerate(langs) if x == name and len(raw[i])] for name in labels]
    first, second = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    for step in range(1, how.steps + 1):
        label = np.arange(how.batch) % len(labels) if len(labels) <= how.batch else rng.integers(0, len(labels), how.batch)
        label = np.array([k for k in label if of[k]])
        data = np.zeros((len(label), how.window_bytes), np.uint8)
        weight = np.zeros(data.shape, np.float32)
        for row, k in enumerate(label):
            x = raw[of[k][rng.integers(len(of[k]))]]
            at = int(rng.integers(max(len(x) - how.window_bytes, 0) + 1))
            x = x[at:at + how.window_bytes]
            data[row, :len(x)], weight[row, :len(x)] = x, 1
        _, grads = gradients(net, data, label, weight)
        rate = how.rate * (1 - 0.9 * step / how.steps)
        for w, g, m, v in zip(net.weights(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


class Scorer:
    """Position probabilities of many windows at a time."""

    def __init__(self, net: Network) -> None:
        h = net.recur.shape[1]
        # gates come from tanh of half the sum: s(x) = tanh(x / 2) / 2 + 1 / 2
        half = np.concatenate([np.full(2 * h, 0.5), np.ones(h)]).astype(np.float32)
        self.h, self.k = h, len(net.labels)
        self.inputs = [np.ascontiguousarray((net.inputs[d] * half).T) for d in range(2)]
        self.recur = [np.ascontiguousarray((net.recur[d] * half).T) for d in range(2)]
        self.bias = [net.bias[d][:, None].copy() for d in range(2)]
        self.out, self.out_bias = np.ascontiguousarray(net.out.T), net.out_bias[:, None].copy()

    def _run(self, d: int, seq: np.ndarray, inside: np.ndarray) -> np.ndarray:
        steps, n = seq.shape
        h = self.h
        states = np.empty((steps, h, n), np.float32)
        state = np.zeros((h, n), np.float32)
        x, g = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            np.take(self.inputs[d], seq[t], axis=1, out=x)
            np.matmul(self.recur[d], state, out=g)
            gates = x[:2 * h]
            gates += g[:2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            n_part = g[2 * h:]
            n_part += self.bias[d]
            n_part *= gates[:h]
            n_part += x[2 * h:]
            np.tanh(n_part, out=n_part)
            new = states[t]
            np.subtract(state, n_part, out=new)
            new *= gates[h:]
            new += n_part
            if not inside[t].all():  # padding leaves the state at its start
                new *= inside[t]
            state = new
        return states

    def sums(self, seq: np.ndarray, inside: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Sum of the position probabilities (K, N) over the kept places;
        ``seq`` (T, N) are bytes, padded after the ``inside`` ones."""
        fore, aft = self._run(0, seq, inside), self._run(1, seq, inside)
        total = np.zeros((self.k, seq.shape[1]), np.float32)
        for t in range(len(seq)):
            x = self.out[:, :self.h] @ fore[t] + self.out[:, self.h:] @ aft[t] + self.out_bias
            x -= x.max(axis=0)
            np.exp(x, out=x)
            x *= keep[t] / x.sum(axis=0)
            total += x
        return total

    def pooled(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text (texts, K); empty texts give 0."""
        size = np.diff(off)
        per = -(-size // CORE)
        text = np.repeat(np.arange(len(size)), per)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * CORE
        length = np.minimum(size[text] - begin, CORE)
        lead, tail = np.minimum(begin, CONTEXT), np.minimum(size[text] - begin - length, CONTEXT)
        # windows of like length advance together
        order = np.argsort(lead + length + tail, kind="stable")
        out = np.zeros((len(size), self.k))
        padded = np.append(data, np.uint8(0))
        for k in range(0, len(order), ROWS):
            w = order[k:k + ROWS]
            span = (lead + length + tail)[w]
            t = np.arange(int(span.max()))[:, None]
            at = off[text[w]] + begin[w] - lead[w] + t
            inside = t < span
            seq = padded[np.where(inside, at, len(data))]
            keep = (t >= lead[w]) & (t < (lead + length)[w])
            sums = self.sums(seq, inside, keep.astype(np.float32))
            for c in range(self.k):
                out[:, c] += np.bincount(text[w], sums[c], len(size))
        return out / np.maximum(size, 1)[:, None]


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _lettered(texts: pa.Array, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    rank = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = rank[off[1:]] > rank[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[i] = any(c.isalpha() for c in texts[i].as_py())
    return out


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, how: Training = Training()) -> DataFrame:
    """``stretch, lang``: at most ``how.sample_docs`` rows a language, chosen by a hash."""
    learn = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang")).filter(
        (F.pmod(F.crc32(F.coalesce("i", F.lit(""))), F.lit(FOLDS)) != 0) & F.col("lang").isNotNull() & (F.length("t") > 0))
    sizes = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} languages: is {lang_col!r} a language column?")
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("langid|"), F.coalesce("i", F.lit("")))), 1, 12), 16, 10).cast("long")
    u = draw / float(1 << 48)
    place = F.pmod(draw, F.greatest(F.length("t") - how.sample_chars + 1, F.lit(1))) + 1
    # first about three times the wanted rows, then the wanted ones of these
    near = (learn.withColumn("u", u).withColumn("stretch", F.col("t").substr(place.cast("int"), F.lit(how.sample_chars)))
            .select("lang", "u", "stretch").join(F.broadcast(sizes), "lang")
            .filter(F.col("u") * F.col("n") < 3 * how.sample_docs))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u", "stretch"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= how.sample_docs).select("stretch", "lang")


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             how: Training = Training()) -> Network:
    """A network fitted to a sample, bounded by ``how``, of the labelled texts that
    are not held out."""
    rows = training_sample(docs, id_col, text_col, lang_col, how).collect()
    rows.sort(key=lambda r: (r.lang, r.stretch))
    return train([r.stretch for r in rows], [r.lang for r in rows], how)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       net: Network | None = None, how: Training = Training()) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Without ``net``, one is trained on the labelled texts whose crc32 of the
    identifier as text (null: empty) is not 0 modulo 5; the others are held
    out.  ``how`` bounds the sample it learns from (``Training``: by default 400
    texts a language, 300 characters of each).  A text that is null or has no letter is ``und`` with score 0, and so
    is every text where no label was learned.  Else ``lang_pred`` is the
    learned label of the largest mean position probability, ``score`` that
    probability; ties take the first label in order.  Repeated rows are scored
    alike; empty input gives an empty result.
    """
    ship_code(docs.sparkSession)
    model = net if net is not None else train_on(docs, id_col, text_col, lang_col, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            coded = batch.column(2).dictionary_encode()  # equal texts are scored once
            texts, row = coded.dictionary, coded.indices.to_numpy()
            names, scores = [], []
            for a, b in cuts_by(np.diff(offsets_of(texts)), 1 << 20):
                part = texts.slice(a, b - a)
                off = offsets_of(part)
                data = np.frombuffer(part.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
                off = off - off[0]
                known = _lettered(part, data, off) if model.labels else np.zeros(b - a, bool)
                if model.labels:
                    p = scorer.pooled(data, off)
                    best = p.argmax(axis=1)
                    names += [model.labels[k] if y else UNKNOWN for k, y in zip(best.tolist(), known.tolist())]
                    scores += np.where(known, np.minimum(p.max(axis=1), 1.0), 0.0).tolist()
                else:
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([names[k] for k in row.tolist()], pa.string()),
                 pa.array(np.array(scores)[row] if len(row) else [], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
        give_back()

    held_out = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(FOLDS)) == 0
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
    # the last digits of 32-bit sums depend on which windows advance together
    return found.withColumn("score", F.round("score", 4))

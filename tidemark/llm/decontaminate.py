"""Benchmark decontamination by an FM-index for each training shard.

A task gathers its documents into shards of about SHARD_WORDS words, maps words
to the benchmark's vocabulary (words outside it, which no phrase can hold, fall
together to one separator), builds an FM-index of the shard, searches all test
phrases backward at once, locates their occurrences by sampled suffix positions
and merges the spans they cover.  Nothing is shuffled.

The phrases go to every task.  A benchmark that is larger than a task should
hold is cut into batches of bounded size; every batch is searched by itself, and
the spans and items of a document are merged over the batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import give_back, ship_code, utf8_size, written
from tidemark.llm.fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 20
# Text of a batch of benchmark items (its phrases take about 15 times as much),
# and of a piece of an item; a longer item is cut into overlapping pieces.
BATCH_BYTES, PIECE_BYTES = 4 << 20, 1 << 18

SPAN = "struct<start: long, end: long, first: long, last: long>"
SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          f"items array<string>, spans array<{SPAN}>")


class Phrases:
    """Distinct test phrases as vocabulary numbers, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        texts = pa.array([t for _, t in items], pa.string())
        hashes, at = W.word_hashes(texts, W.NOT_WORD)
        self.vocabulary = np.unique(hashes)
        # 0 ends the sequence, 1 separates, words follow
        code = np.searchsorted(self.vocabulary, hashes) + 2
        names, item = np.unique(np.array([i for i, _ in items], dtype=object), return_inverse=True)
        self.names = names.tolist()
        sizes = np.diff(at)
        owner_of = np.repeat(np.arange(len(items)), sizes)
        long = np.zeros((0, window), np.int32)
        begin = np.zeros(0, np.int64)
        if len(code) >= window:  # windows that lie in one item
            begin = np.flatnonzero(owner_of[window - 1:] == owner_of[:len(code) - window + 1])
            long = np.lib.stride_tricks.sliding_window_view(code.astype(np.int32), window)[begin]
        short = np.flatnonzero((sizes > 0) & (sizes < window))
        rest = np.zeros((len(short), window), np.int32)
        for row, k in zip(rest, short.tolist()):
            row[window - sizes[k]:] = code[at[k]:at[k + 1]]
        rows = np.concatenate([long, rest])
        owner = item[np.concatenate([owner_of[begin], short]).astype(np.int64)] if len(rows) else np.zeros(0, np.int64)
        if not len(rows):
            self.phrases, self.sizes = np.zeros((0, window), np.int32), np.zeros(0, np.int64)
            self.owner, self.owner_at = np.zeros(0, np.int64), np.zeros(1, np.int64)
            return
        self.phrases, which = np.unique(rows, axis=0, return_inverse=True)
        self.sizes = (self.phrases > 0).sum(axis=1)
        pairs = np.unique(np.stack([which.reshape(-1), owner], axis=1), axis=0)
        self.owner = pairs[:, 1]
        self.owner_at = np.searchsorted(pairs[:, 0], np.arange(len(self.phrases) + 1))

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.ones(len(hashes), np.int64)
        k = np.searchsorted(self.vocabulary, hashes)
        k[k == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[k] == hashes, k + 2, 1)


class _Shard:
    """Documents gathered until the shard is full."""

    def __init__(self) -> None:
        self.ids: list = []
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.words = 0

    def add(self, ids: list, texts: pa.Array, phrases: Phrases) -> None:
        data, off = W.lowered_bytes(texts)
        start, end, at = W.spans(data, off, W.NOT_WORD)
        self.ids += ids
        self.codes.append(phrases.encode(W.hashes(data, start, end)))
        counts = np.diff(at)
        base = np.repeat(off[:-1], counts)
        self.counts.append(counts)
        self.starts.append((start - base).astype(np.int32))
        self.ends.append((end - base).astype(np.int32))
        self.words += len(start)

    def result(self, phrases: Phrases) -> pa.RecordBatch:
        codes, counts = np.concatenate(self.codes), np.concatenate(self.counts)
        starts, ends = np.concatenate(self.starts), np.concatenate(self.ends)
        docs, n = len(counts), len(codes)
        doc_of = np.repeat(np.arange(docs), counts)
        # one separator before each document and for each run of other words
        text = np.ones(n + docs, np.int64)
        word = np.full(n + docs, -1, np.int64)
        at = np.arange(n) + doc_of + 1
        text[at], word[at] = codes, np.arange(n)
        keep = text > 1
        keep[1:] |= text[:-1] > 1
        text, word = np.append(text[keep], 0), word[keep]
        which, place = FMIndex(text).find(phrases.phrases, phrases.sizes)
        first = word[place]
        edge = np.bincount(first, minlength=n + 1) - np.bincount(first + phrases.sizes[which], minlength=n + 1)
        hit = np.cumsum(edge[:n]) > 0
        n_hit = np.bincount(doc_of[hit], minlength=docs)

        n_phrases, n_items = max(len(phrases.sizes), 1), max(len(phrases.names), 1)
        found_doc, found = np.divmod(np.unique(doc_of[first] * n_phrases + which), n_phrases)
        owners = phrases.owner_at[found]
        many = phrases.owner_at[found + 1] - owners
        item_doc, item = np.divmod(np.unique(np.repeat(found_doc, many) * n_items
                                             + phrases.owner[W.ragged(owners, many)]), n_items)
        item_at = np.searchsorted(item_doc, np.arange(docs + 1))

        # runs of hit words within a document
        begins = hit & ~np.concatenate([[False], hit[:-1]])
        begins |= hit & np.concatenate([[True], doc_of[1:] != doc_of[:-1]])[:n]
        run = np.flatnonzero(begins)
        last = np.flatnonzero(hit & np.concatenate([begins[1:] | ~hit[1:], [True]])[:n])
        run_at = np.searchsorted(doc_of[run], np.arange(docs + 1))

        names = [phrases.names[i] for i in item.tolist()]
        lists = [names[a:b] for a, b in zip(item_at.tolist(), item_at[1:].tolist())]
        digest = {x: hashlib.sha256(",".join(x).encode()).hexdigest() for x in set(map(tuple, lists))}
        sha = [digest[tuple(x)] for x in lists]
        ahead = (np.cumsum(counts) - counts)[doc_of[run]]
        spans = pa.StructArray.from_arrays(
            [pa.array(starts[run], pa.int64()), pa.array(ends[last], pa.int64()), pa.array(run - ahead), pa.array(last + 1 - ahead)],
            ["start", "end", "first", "last"])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids, pa.int64()), pa.array(counts), pa.array(n_hit), pa.array(np.diff(item_at)),
             pa.array(sha, pa.string()), pa.array(n_hit > 0), pa.array(lists, pa.list_(pa.string())),
             pa.ListArray.from_arrays(pa.array(run_at.astype(np.int32)), spans)],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"])


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """``i, t``: items, long ones cut into pieces that hold every window once."""

    def cut(text: pa.Array) -> list[str]:
        data, off = W.lowered_bytes(text)
        start, end, _ = W.spans(data, off, W.NOT_WORD)
        if len(start) < window:
            return text.to_pylist()
        raw = text[0].as_py().encode()
        per = max(PIECE_BYTES * len(start) // len(raw), 1)
        return [raw[start[k]:end[min(k + per + window - 1, len(start)) - 1]].decode() for k in range(0, len(start) - window + 1, per)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.diff(W.offsets_of(texts))
            for k, name in enumerate(names):
                parts = cut(texts.slice(k, 1)) if sizes[k] > PIECE_BYTES else [texts[k].as_py()]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(parts), pa.string()), pa.array(parts, pa.string())], names=["i", "t"])

    return items.mapInArrow(run, "i string, t string")


def _search(slim: DataFrame, batch: DataFrame, window: int) -> DataFrame:
    """Occurrences of one batch of items in all documents."""
    phrases = slim.sparkSession.sparkContext.broadcast(Phrases([(r.i, r.t) for r in batch.collect()], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in W.slices(texts):
                shard.add(ids[a:b], texts.slice(a, b - a), phrases.value)
                if shard.words >= SHARD_WORDS:
                    yield shard.result(phrases.value)
                    shard = _Shard()
        if shard.ids:
            yield shard.result(phrases.value)
            shard = _Shard()
        give_back()

    return slim.mapInArrow(run, SCHEMA)


def _merged(found: list[DataFrame]) -> DataFrame:
    """``row``, and the columns that follow from hits, over all batches."""
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = written(hits.filter("contaminated").select(F.col("doc_id").alias("row"), "items", "spans"), "batch-hits")
    named = hits.select("row", F.explode("items").alias("item")).distinct().groupBy("row").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    # runs of words that touch or overlap are one
    order = Window.partitionBy("row").orderBy("first", "last")
    runs = hits.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.when(reach.isNull() | (F.col("first") > reach), 1).otherwise(0))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first"),
                                            F.max("last").alias("last"))
    spans = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "first", "last"))).alias("spans"),
                                      F.sum(F.col("last") - F.col("first")).alias("n_hit"))
    return named.join(spans, "row")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items, spans``.

    Words are runs of ASCII letters and digits and of any non-ASCII characters,
    with A-Z lowered.  A phrase is ``window`` consecutive words of an item, or
    the whole of a shorter item; an item without words has none.  A word inside
    any occurrence is hit.  ``items`` are the identifiers, as sorted strings, of
    items with an occurring phrase, ``items_sha256`` the digest of these joined
    by commas; ``spans`` are the merged stretches of hit words: UTF-8 byte
    offsets ``start, end`` and word numbers ``first, last`` (ends excluded).  A
    null text has no words; a null identifier stays null, a null item identifier
    is the empty string, repeated ones are one item.  Repeated rows each give a
    row; empty tables give empty results or no hits.

    A benchmark of up to ``batch_bytes`` of text is searched in one pass over
    the documents, a larger one in as many passes as it has batches.
    """
    spark = docs.sparkSession
    ship_code(spark)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("t"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = items.agg(F.sum(utf8_size(F.col("t")) + F.octet_length("i") + 16)).first()[0] or 0
    batches = max(-(-held // batch_bytes), 1)
    if batches == 1:
        return _search(slim, items, window)
    dealt = written(_pieces(items, window).withColumn("batch", F.pmod(F.xxhash64("i", "t"), F.lit(batches))), "benchmark-batches")
    numbered = written(slim.withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
    found = [written(_search(numbered.select(F.col("row").alias("doc_id"), "text"), dealt.filter(F.col("batch") == k).select("i", "t"), window),
                     "batch-found") for k in range(batches)]
    words = found[0].select(F.col("doc_id").alias("row"), "n_words")
    n = F.coalesce("n_hit", F.lit(0))
    none = F.array().cast("array<string>")
    joined = numbered.select("row", "doc_id").join(words, "row").join(_merged(found), "row", "left").withColumn("items", F.coalesce("items", none))
    return joined.select("doc_id", "n_words", n.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"), "items",
                         F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def remove_spans(text: str | None, spans: list | None) -> str | None:
    """The text without the given UTF-8 byte ranges."""
    if not text or not spans:
        return text
    raw, at, out = text.encode(), 0, []
    for a, b, *_ in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]).decode()

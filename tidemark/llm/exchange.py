"""Counting n-gram keys over the corpus, by chunks of texts.

Texts are gathered into chunks of some megabytes.  A chunk asks for the corpus
totals of its distinct keys: one row a bucket (a range of the keys), holding the
sorted keys and their counts in the chunk.  A bucket adds up what all chunks
sent and answers each in the same order.  So a key crosses the network once a
chunk, however often it occurs, and a key that fills a third of the corpus is
no larger than any other.  ``with_answers`` brings each chunk's texts and its
answers together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, shuffle_partitions
from tidemark.llm.words import offsets_of, slices

CHUNK_BYTES = 6 << 20

REQUEST = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("space", pa.int32()), ("keys", pa.binary()),
                     ("counts", pa.binary()), ("stats", pa.list_(pa.int64()))])
REQUEST_DDL = "chunk long, bucket int, space int, keys binary, counts binary, stats array<long>"
ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("space", pa.int32()), ("totals", pa.binary()),
                    ("stats", pa.list_(pa.int64()))])
ANSWER_DDL = "chunk long, bucket int, space int, totals binary, stats array<long>"
# Space of a chunk's own row beside its answers.
BODY = -1


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def squeeze_texts(a: np.ndarray) -> bytes:
    """For a chunk's texts: copies anywhere in the chunk are found."""
    how = zstandard.ZstdCompressionParameters.from_level(3, window_log=23, enable_ldm=True)
    return zstandard.ZstdCompressor(compression_params=how).compress(a.tobytes())


def unsqueeze(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def squeeze_totals(a: np.ndarray) -> bytes:
    """Non-negative totals, eight bytes each where four do not hold the largest."""
    wide = a.max(initial=0) >= 1 << 32
    return (b"8" if wide else b"4") + squeeze(a.astype(np.uint64 if wide else np.uint32))


def unsqueeze_totals(data: bytes) -> np.ndarray:
    return unsqueeze(data[1:], np.uint64 if data[:1] == b"8" else np.uint32)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: the upper halves as runs where that is shorter."""
    high = (keys >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if 8 * len(first) >= 4 * len(keys):
        return b"r" + keys.tobytes()
    runs = np.diff(np.append(first, len(keys))).astype(np.uint32)
    return b"p" + b"".join([len(first).to_bytes(4, "little"), high[first].tobytes(), runs.tobytes(),
                            keys.astype(np.uint32).tobytes()])


def unpack_keys(data: bytes) -> np.ndarray:
    if data[:1] == b"r":
        return np.frombuffer(data, np.uint64, offset=1)
    n = int.from_bytes(data[1:5], "little")
    high = np.frombuffer(data, np.uint32, n, 5)
    runs = np.frombuffer(data, np.uint32, n, 5 + 4 * n)
    low = np.frombuffer(data, np.uint32, offset=5 + 8 * n)
    return (np.repeat(high, runs).astype(np.uint64) << np.uint64(32)) | low


@dataclass
class Chunk:
    """Documents of one chunk: identifiers, and texts as an Arrow array."""

    number: int
    kind: int
    ids: list = field(default_factory=list)
    parts: list = field(default_factory=list)
    size: int = 0

    def texts(self) -> pa.Array:
        return pa.concat_arrays(self.parts)


def chunks(batches: Iterator[pa.RecordBatch], kind_of: Callable[[pa.Array], np.ndarray] | None = None) -> Iterator[Chunk]:
    """Chunks of a task's rows (identifier, text); rows of different kinds go to
    different chunks.  The same rows in the same order give the same chunks."""
    base, count = TaskContext.get().partitionId() << 32, 0
    open_: dict[int, Chunk] = {}
    for batch in batches:
        texts = batch.column(1)
        for a, b in slices(texts):
            part, ids = texts.slice(a, b - a), batch.column(0).slice(a, b - a)
            kinds = kind_of(ids) if kind_of else np.zeros(b - a, np.int64)
            for kind in np.unique(kinds).tolist():
                rows = np.flatnonzero(kinds == kind)
                own = part if len(rows) == b - a else part.take(pa.array(rows))
                chunk = open_.get(kind)
                if chunk is None:
                    chunk = open_[kind] = Chunk(base + count, kind)
                    count += 1
                chunk.ids += (ids if len(rows) == b - a else ids.take(pa.array(rows))).to_pylist()
                chunk.parts.append(own)
                chunk.size += int(np.diff(offsets_of(own)).sum())
                if chunk.size >= CHUNK_BYTES:
                    yield open_.pop(kind)
    yield from open_.values()


def requests(chunk: int, space: int, keys: np.ndarray, counts: np.ndarray, bits: int, buckets: int) -> list[dict]:
    """Rows that ask for the totals of sorted distinct ``keys`` (below 2**bits).
    ``counts`` has one row a column to total, of counts within the chunk."""
    edges = np.array([-(-(b << bits) // buckets) for b in range(1, buckets)], np.uint64)
    cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [{"chunk": chunk, "bucket": b, "space": space, "keys": pack_keys(keys[i:j]),
             "counts": squeeze_totals(counts[:, i:j]), "stats": None}
            for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]


def answered(rows: DataFrame, buckets: int, columns: int) -> DataFrame:
    """Answers to all requests.  Rows without keys (statistics) pass through;
    each task adds one with, for each space it served, the space, its distinct
    keys with a positive total, and the totals' sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["keys"] is None:
                    yield pa.RecordBatch.from_pylist(
                        [{"chunk": row["chunk"], "bucket": row["bucket"], "space": row["space"], "totals": None,
                          "stats": row["stats"]}], ANSWER)
                else:
                    asked.setdefault(row["space"], []).append(
                        (row["chunk"], row["bucket"], unpack_keys(row["keys"]),
                         unsqueeze_totals(row["counts"]).reshape(columns, -1)))
        for space, held in asked.items():
            sizes = [len(x[2]) for x in held]
            keys, at = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True)
            # sums of doubles are exact up to 2 ** 53 occurrences of a key
            totals = np.stack([np.bincount(at, np.concatenate([x[3][c] for x in held]), len(keys))
                               for c in range(columns)]).astype(np.int64)
            ends = np.cumsum(sizes)
            for (chunk, bucket, _, _), size, end in zip(held, sizes, ends.tolist()):
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": chunk, "bucket": bucket, "space": space,
                      "totals": squeeze_totals(totals[:, at[end - size:end]]), "stats": None}], ANSWER)
            yield pa.RecordBatch.from_pylist(
                [{"chunk": None, "bucket": None, "space": space, "totals": None,
                  "stats": [int((totals.sum(axis=0) > 0).sum()), *totals.sum(axis=1, dtype=np.int64).tolist()]}], ANSWER)

    return rows.repartitionById(buckets, F.col("bucket")).mapInArrow(run, ANSWER_DDL)


def body_row(chunk: Chunk) -> dict:
    """A chunk's documents as one row, texts compressed."""
    texts = chunk.texts()
    off = offsets_of(texts)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return {"chunk": chunk.number, "bucket": 0, "space": BODY, "totals": squeeze_texts(raw), "ids": chunk.ids,
            "sizes": np.diff(off).astype(np.int32).tolist()}


BODY_SCHEMA = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("space", pa.int32()), ("totals", pa.binary()),
                         ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
BODY_DDL = "chunk long, bucket int, space int, totals binary, ids array<long>, sizes array<int>"


@dataclass
class Answered:
    """A chunk with the totals it asked for."""

    ids: list
    texts: pa.Array
    totals: dict[int, np.ndarray]

    def of(self, space: int, columns: int, n: int) -> np.ndarray:
        """Totals of the chunk's ``n`` sorted distinct keys."""
        got = self.totals.get(space, np.zeros((columns, 0), np.uint32))
        if got.shape[1] != n:
            raise RuntimeError("the input's rows came in another order than before; write it as a table first")
        return got


def with_answers(bodies: DataFrame, answers: DataFrame, columns: int,
                 use: Callable[[Answered], pa.RecordBatch], ddl: str) -> DataFrame:
    """``use`` on every chunk together with its answers."""
    ship_code(bodies.sparkSession)
    both = bodies.unionByName(
        answers.filter(F.col("chunk").isNotNull() & F.col("totals").isNotNull())
        .select("chunk", "bucket", "space", "totals",
                F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<int>").alias("sizes")))

    def one(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        body = [r for r in rows if r["space"] == BODY]
        if not body:  # a chunk that is not wanted here
            return
        raw = unsqueeze(body[0]["totals"], np.uint8)
        off = np.concatenate([[0], np.cumsum(body[0]["sizes"])]).astype(np.int64)
        texts = pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(raw)])
        totals: dict[int, list] = {}
        for r in sorted((r for r in rows if r["space"] != BODY), key=lambda r: r["bucket"]):
            totals.setdefault(r["space"], []).append(unsqueeze_totals(r["totals"]).reshape(columns, -1))
        yield use(Answered(body[0]["ids"], texts, {s: np.concatenate(t, axis=1) for s, t in totals.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held and row["chunk"] != held[0]["chunk"]:
                    yield from one(held)
                    held = []
                held.append(row)
        if held:
            yield from one(held)

    return (both.repartition(F.col("chunk")).sortWithinPartitions("chunk").mapInArrow(run, ddl))


def bucket_count(df: DataFrame) -> int:
    return max(shuffle_partitions(df.sparkSession), 8)

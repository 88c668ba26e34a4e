"""Token files: ids of whole texts under one Huffman code of the whole corpus.

Written in ascending document order as a folder of two Parquet tables:

* ``codebook``: ``id, length``; canonical codes follow from the lengths.
* ``blocks``: runs of whole documents of about BLOCK_IDS ids.  ``part`` and
  ``seq`` give the order; ``doc_ids`` and ``doc_tokens`` describe the documents;
  ``payload`` is the bit stream, each document from a whole byte on;
  ``checkpoints`` are the bit offsets of every CHECKPOINT_IDS-th id of each
  document, from which stretches decode independently.

The code needs the corpus counts first, so ids are written once as an
intermediate table and counted there; texts are not shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ordered_id, scratch_table, ship_code, shuffle_partitions
from tidemark.llm.huffman import CHECKPOINT_IDS, MAX_BITS, Codec, code_lengths
from tidemark.llm.ranges import range_of, splitters
from tidemark.llm.words import SLICE_BYTES, cuts_by, offsets_of

BLOCK_IDS = 65_536
TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tie, n_tokens, ids`` (little-endian 16- or 32-bit)."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.tokenize import encoder

        encode = encoder(tokenizer)
        for batch in sliced(batches, lambda b: np.diff(offsets_of(b.column(2))), SLICE_BYTES):
            ids, counts = encode(batch.column(2))
            starts = np.cumsum(counts) - counts
            whole = np.insert(ids, starts + counts, encode.dtype(end_id))
            data = whole.tobytes()
            width = whole.itemsize
            ends = np.concatenate([[0], np.cumsum(counts + 1) * width]).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts + 1, pa.int64()),
                 pa.array([data[a:b] for a, b in zip(ends, ends[1:])], pa.binary())],
                names=["doc_id", "tie", "n_tokens", "ids"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, tie long, n_tokens long, ids binary")


def sliced(batches: Iterator[pa.RecordBatch], sizes: Callable[[pa.RecordBatch], np.ndarray],
           limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where their rows' sizes pass the limit, to bound memory."""
    for batch in batches:
        for a, b in cuts_by(sizes(batch), limit):
            yield batch.slice(a, b - a)


def _as_ids(column: pa.Array, width: int) -> np.ndarray:
    off = offsets_of(column)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), np.uint16 if width == 2 else np.uint32)


def id_counts(tokens: DataFrame, width: int) -> DataFrame:
    """``id, n`` over all tokens; a task sends each id once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in sliced(batches, lambda b: np.diff(offsets_of(b.column(0))), SLICE_BYTES):
            n = np.bincount(_as_ids(batch.column(0), width))
            if len(n) > len(total):
                n[:len(total)] += total
                total = n
            else:
                total[:len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _coded(tokens: DataFrame, lengths: np.ndarray, width: int, cuts: list[str]) -> DataFrame:
    codec_of: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not codec_of:
            codec_of.append(Codec(lengths))
        for batch in sliced(batches, lambda b: np.asarray(b.column(4)), SLICE_BYTES // 2):
            n = np.asarray(batch.column(4))
            data, size, offsets, marks = codec_of[0].encode(_as_ids(batch.column(5), width), n)
            raw, at = data.tobytes(), np.concatenate([[0], np.cumsum(size)]).tolist()
            upto = np.concatenate([[0], np.cumsum(marks)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)]
                + [pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary()),
                   pa.ListArray.from_arrays(pa.array(upto), pa.array(offsets, pa.int64()))],
                names=["part", "doc_id", "tie", "salt", "n_tokens", "code", "marks"])

    return (tokens.select(range_of(F.col("key"), cuts).alias("part"), "doc_id", "tie", "salt", "n_tokens", "ids")
            .mapInArrow(run, "part int, doc_id long, tie long, salt long, n_tokens long, code binary, marks array<long>"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents to blocks; a block never spans two parts."""
    names = ["part", "seq", "n_ids", "doc_ids", "doc_tokens", "payload", "checkpoints"]
    state: dict = {"part": None, "seq": 0}
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        base, marks = 0, []
        for _, _, code, m in held:
            marks.append(np.asarray(m, np.int64) + 8 * base)
            base += len(code)
        row = [pa.array([state["part"]], pa.int32()), pa.array([state["seq"]], pa.int64()),
               pa.array([sum(x[1] for x in held)], pa.int64()),
               pa.array([[x[0] for x in held]], pa.list_(pa.int64())),
               pa.array([[x[1] for x in held]], pa.list_(pa.int64())),
               pa.array([b"".join(x[2] for x in held)], pa.binary()),
               pa.array([np.concatenate(marks)], pa.list_(pa.int64()))]
        held.clear()
        state["seq"] += 1
        return pa.RecordBatch.from_arrays(row, names=names)

    count = 0
    for batch in batches:
        cols = [batch.column(i) for i in range(5)]
        offsets, flat = np.asarray(cols[4].offsets), np.asarray(cols[4].values)
        for i, (part, doc, n, code) in enumerate(zip(*(c.to_pylist() for c in cols[:4]))):
            if held and (part != state["part"] or count + n > BLOCK_IDS):
                yield block()
                count = 0
            if part != state["part"]:
                state["part"], state["seq"] = part, 0
            held.append((doc, n, code, flat[offsets[i]:offsets[i + 1]]))
            count += n
    if held:
        yield block()


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the folder described above.

    A null text counts as empty and yields the end id alone.  Documents go in
    ascending identifier order, null first; rows that share an identifier are
    ordered by a hash of their text, and rows equal in both stand together.
    An empty table writes empty tables.  Other columns are not read.
    """
    from tidemark.llm.tokenize import Encoder

    spark = docs.sparkSession
    width = Encoder(tokenizer).dtype().itemsize
    scratch = scratch_table(spark, "tokens")
    (tokenized(docs, tokenizer, end_id, id_col, text_col)
     # rows equal in identifier and text are dealt by a salt, so that many
     # copies of one row do not meet in one range
     .withColumn("salt", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(scratch))
    tokens = spark.read.parquet(scratch).withColumn(
        "key", F.concat(ordered_id(F.col("doc_id")), F.lit(" "), ordered_id(F.col("tie")), ordered_id(F.col("salt"))))

    # one row for each id of the vocabulary
    counts = id_counts(tokens, width).toPandas()
    table = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    table[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(table, max(MAX_BITS, (len(counts) - 1).bit_length()) if len(counts) else MAX_BITS)
    used = np.flatnonzero(lengths)
    book = pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used].astype(np.int32))})
    spark.createDataFrame(book.to_pandas(), "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")

    cuts = splitters(tokens, shuffle_partitions(spark))
    (_coded(tokens, lengths, width, cuts)
     .repartitionById(len(cuts) + 1, F.col("part"))
     .sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "tie", "salt")
     .select("part", "doc_id", "n_tokens", "code", "marks")
     .mapInArrow(_blocks, "part int, seq long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
                          "payload binary, checkpoints array<long>")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the files: ``doc_id, start, n_tokens,
    ids_crc32`` and, if asked for, the ids as ``array<int>``.  ``start`` counts
    the ids of all documents before it."""
    ship_code(spark)
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["length"].to_numpy()
    blocks = spark.read.parquet(f"{path}/blocks")
    codec_of: list[Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not codec_of:
            codec_of.append(Codec(lengths))
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, docs, n, payload, marks = (batch.column(k)[i] for k in range(6))
                n = np.asarray(n.values)
                per = (n + CHECKPOINT_IDS - 1) // CHECKPOINT_IDS
                stretch = np.full(int(per.sum()), CHECKPOINT_IDS, np.int64)
                stretch[np.cumsum(per) - 1] = n - CHECKPOINT_IDS * (per - 1)
                ids = codec_of[0].decode(np.frombuffer(payload.as_buffer(), np.uint8), np.asarray(marks.values), stretch)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(n)
                k = len(n)
                bounds = zip((4 * (ends - n)).tolist(), (4 * ends).tolist())
                row = [pa.array([part.as_py()] * k, pa.int32()), pa.array([seq.as_py()] * k, pa.int64()),
                       docs.values, pa.array(ends - n), pa.array(n),
                       pa.array([zlib.crc32(raw[a:b]) for a, b in bounds], pa.int64())]
                names = ["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"]
                if with_ids:
                    row.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(row, names=names)

    schema = "part int, seq long, doc_id long, inner long, n_tokens long, ids_crc32 long"
    found = (blocks.select("part", "seq", "doc_ids", "doc_tokens", "payload", "checkpoints")
             .mapInArrow(run, schema + (", ids array<int>" if with_ids else "")))
    upto = Window.unboundedPreceding
    sizes = blocks.select("part", "seq", "n_ids")
    # one row a part meets in one task: as many as ranges
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(upto, -1)), F.lit(0)).alias("ahead"))
    starts = sizes.withColumn("before", F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(upto, -1)), F.lit(0)))
    starts = starts.join(parts, "part").select("part", "seq", (F.col("ahead") + F.col("before")).alias("first"))
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))


def token_digest(docs: DataFrame, **options) -> DataFrame:
    """Write token files to the shared scratch folder and read them back."""
    path = scratch_table(docs.sparkSession, "token-files")
    write_token_files(docs, path, **options)
    return read_token_files(docs.sparkSession, path)

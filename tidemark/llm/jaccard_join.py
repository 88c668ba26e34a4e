"""N-gram Jaccard join by signature trees.

1. Shingles are counted over the corpus (``exchange.py``).  A document of which
   more than a quarter of the shingles occur nowhere else can have no link.
2. Of the others, equal sets become one node.  Tokens are ordered by corpus
   count, rarest first; two linked sets share a token among the first quarter
   (and one) of each, so nodes are dealt to these tokens, unique ones left out,
   and nodes that tokens connect form a cluster.  Links stay within clusters,
   and each node lies in one, so sets are not copied for each token.
3. A cluster is cut into blocks of about BLOCK nodes.  Trees over a block are
   traversed against themselves and against the cluster's first block, so a
   group of near copies joins in time in proportion to its size.
4. In clusters of several blocks whose nodes still have different labels, trees
   over the nodes outside the largest label are traversed against all blocks.

Surviving pairs are compared in full, except pairs already joined.  Joined
nodes leave a task as one edge a node, and components are found by rounds of
joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import exchange as X
from tidemark.llm import words as W
from tidemark.llm.common import ship_code, written
from tidemark.llm.components import connected
from tidemark.llm.signature_tree import link

SHINGLE = 5
THRESHOLD = (3, 4)
KEY_BITS = 48
BLOCK = 256

SETS = "doc_id long, n_shingles long, node binary, tokens binary, first array<long>"


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text.  With fewer words than
    ``size`` the whole sequence is one shingle; without words there is none."""
    out = []
    for a, b in W.slices(texts):
        h, at = W.word_hashes(texts.slice(a, b - a), W.WHITESPACE)
        grams = W.ngram_hashes(h, size)
        for i, j in zip(at.tolist(), at[1:].tolist()):
            if j - i >= size:
                out.append(np.unique(grams[i:j - size + 1]))
            elif j > i:
                out.append(W.ngram_hashes(h[i:j], j - i))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class _Texts:
    """Distinct texts of a chunk: sets, key places, and each row's text."""

    def __init__(self, texts: pa.Array, size: int) -> None:
        coded = texts.dictionary_encode()
        self.row = coded.indices.to_numpy()
        sets = shingle_sets(coded.dictionary, size)
        # texts that differ in case or white space may have one set
        nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"" for s in sets]
        place: dict[bytes, int] = {}
        self.of_row = np.array([place.setdefault(x, len(place)) for x in nodes], np.int64)[self.row]
        example = dict(zip(nodes, range(len(nodes))))
        self.nodes = list(place)
        self.sets = [sets[example[x]] for x in self.nodes]
        self.keys, self.at = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - KEY_BITS),
                                       return_inverse=True)


def _requests(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches):
            t = _Texts(chunk.texts(), size)
            if len(t.keys):
                counts = np.bincount(t.at, minlength=len(t.keys))[None, :]
                yield pa.RecordBatch.from_pylist(X.requests(chunk.number, 0, t.keys, counts, KEY_BITS, buckets), X.REQUEST)

    return docs.mapInArrow(run, X.REQUEST_DDL)


def _bodies(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches):
            yield pa.RecordBatch.from_pylist([X.body_row(chunk)], X.BODY_SCHEMA)

    return docs.mapInArrow(run, X.BODY_DDL)


def document_sets(docs: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, node`` (digest of its set,
    null without one).  For sets that may have a link, one row a chunk and set
    also has ``tokens`` (the sorted hashes) and ``first`` (the tokens to which
    it is dealt, rarest first)."""
    num, den = threshold
    buckets = X.bucket_count(docs)
    answers = written(X.answered(_requests(docs, size, buckets), buckets, 1), "shingles")

    def use(answer: X.Answered) -> pa.RecordBatch:
        t = _Texts(answer.texts, size)
        df = answer.of(0, 1, len(t.keys))[0][t.at]
        ends = np.cumsum([len(s) for s in t.sets])
        tokens, first = [], []
        for s, e in zip(t.sets, ends.tolist()):
            n, count = len(s), df[e - len(s):e]
            unique = int((count == 1).sum())
            # with u unique tokens the similarity is at most (n - u) / n
            if not n or den * (n - unique) < num * n:
                tokens.append(None)
                first.append(None)
                continue
            prefix = n - -(-num * n // den) + 1
            order = np.lexsort((s, count))[unique:prefix]
            tokens.append(s.tobytes())
            first.append(s[order].view(np.int64).tolist())
        rows = t.of_row.tolist()
        seen: set[int] = set()
        show = [k if k not in seen and not seen.add(k) else None for k in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(answer.ids, pa.int64()), pa.array([len(t.sets[k]) for k in rows], pa.int64()),
             pa.array([t.nodes[k] or None for k in rows], pa.binary()),
             pa.array([None if k is None else tokens[k] for k in show], pa.binary()),
             pa.array([None if k is None else first[k] for k in show], pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "node", "tokens", "first"])

    return X.with_answers(_bodies(docs), answers, 1, use, SETS)


def _linked(dealt: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Edges (``a, b``) from rows ``cluster, i, j, side, node, label, tokens``: a
    task (cluster, i, j) joins its sets of side 0 with those of side 1, or
    among themselves if there are none."""
    num, den = threshold

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        side = np.array([r[3] for r in rows])
        sets, nodes, labels = [np.frombuffer(r[6], np.uint64) for r in rows], [r[4] for r in rows], [r[5] for r in rows]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left):
            return None
        forest = link(sets, labels, left, right if len(right) else None, num, den)
        pairs = {(nodes[k], nodes[forest.find(k)]) for k in range(len(nodes))}
        pairs = [x for x in pairs if x[0] != x[1]]
        if not pairs:
            return None
        a, b = zip(*pairs)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if held and row[:3] != held[0][:3]:
                    if len(held) > 1 and (out := solve(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if len(held) > 1 and (out := solve(held)) is not None:
            yield out

    return (dealt.select("cluster", "i", "j", "side", "node", "label", "tokens")
            .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
            .mapInArrow(run, "a binary, b binary"))


def _block(salt: int, blocks: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(blocks)).cast("int")


def _first_tasks(members: DataFrame) -> DataFrame:
    """Each block with itself, and the first block with each other one."""

    def task(i: Column, j: Column, side: int) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    block, zero = F.col("block"), F.lit(0)
    others = (F.when(F.col("blocks") == 1, F.filter(F.array(task(zero, zero, 0)), lambda _: F.lit(False)))
              .when(block == 0, F.transform(F.sequence(F.lit(1), F.greatest(F.col("blocks") - 1, F.lit(1))), lambda j: task(zero, j, 0)))
              .otherwise(F.array(task(zero, block, 1))))
    rows = members.withColumn("block", _block(0, "blocks"))
    return rows.select(*members.columns, F.inline(F.concat(F.array(task(block, block, 0)), others)))


def _second_tasks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes outside a cluster's largest label, in blocks, with all its blocks."""
    named = (members.drop("label").join(labels, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    sizes = named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = (sizes.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
               .select("cluster", F.col("top.label").alias("major"),
                       F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("minor_blocks"))
               .filter("minor_blocks > 0"))
    rows = named.join(largest, "cluster")
    left = (rows.filter("label != major").withColumn("i", _block(1, "minor_blocks"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(0)))
    right = (rows.withColumn("j", _block(0, "blocks"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1))).withColumn("side", F.lit(1)))
    return left.unionByName(right.select(*left.columns))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, node``.

    A document's set is that of its distinct ``size``-word shingles over
    white-space words with A-Z lowered, held as 64-bit hashes; with fewer words
    the whole sequence is one shingle.  Documents link when the Jaccard
    similarity is at least num / den; the component is named by its smallest
    identifier, null if all are null.  A null or empty text has no set and is
    its own component.  Repeated rows (and any with equal sets) link.  Empty
    input gives an empty result.  The rows of ``docs`` are read twice and must
    come in the same order; write the result of a shuffle as a table first.
    """
    spark = docs.sparkSession
    ship_code(spark)
    name = "jaccard"
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # nid, a hash of the set's digest, serves to cluster: should two share one,
    # their clusters are compared together
    sets = written(document_sets(slim, size, threshold).withColumn("nid", F.xxhash64("node"))
                   .withColumn("uid", F.monotonically_increasing_id()), f"{name}-sets")
    rows = sets.select("doc_id", "n_shingles", "node")

    # clusters of sets that dealt tokens connect; long keys only, one shuffle
    held = sets.filter(F.col("tokens").isNotNull())
    dealt = held.select("nid", F.explode("first").alias("token")).repartition("token")
    leads = (dealt.groupBy("token").agg(F.min("nid").alias("lead"), F.max("nid").alias("high"))
             .filter("lead != high").select("token", "lead"))
    clusters = connected(dealt.join(leads, "token").select(F.col("nid").alias("a"), F.col("lead").alias("b")))
    clusters = clusters.select(F.col("node").alias("nid"), F.col("label").alias("cluster"))
    # one row a distinct set
    chosen = held.groupBy("node", "nid").agg(F.min("uid").alias("uid")).join(clusters, "nid")
    blocks = chosen.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    assigned = written(chosen.join(blocks, "cluster").select("uid", "cluster", "blocks"), f"{name}-clusters")

    def members(of: DataFrame) -> DataFrame:
        return (sets.select("uid", "node", "tokens").join(of, "uid").drop("uid")
                .withColumn("label", F.col("node")))

    edges = written(_linked(_first_tasks(members(assigned)), threshold), f"{name}-edges1")
    labels = connected(edges)
    several = written(assigned.filter("blocks > 1"), f"{name}-several")
    if several.limit(1).count():
        more = written(_linked(_second_tasks(members(several), labels), threshold), f"{name}-edges2")
        labels = connected(edges.union(more))

    # the smallest identifier of each component
    marked = rows.join(labels, "node", "left").select(
        "doc_id", "n_shingles", "node", F.coalesce("label", "node").alias("lead"))
    shared = (marked.filter(F.col("lead").isNotNull()).groupBy("lead")
              .agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("members")).filter("members > 1"))
    return marked.join(shared, "lead", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("members").isNull(), F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"), "node")

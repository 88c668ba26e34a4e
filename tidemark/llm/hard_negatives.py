"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors of whole numbers are laid out along a Hilbert curve, label by label, in
blocks of neighbouring rows.  A block is one row of a Parquet table: identifiers,
the vectors packed, and its zone map, the least and largest value of every
dimension.  A search asks, for each query, for the best rows whose score (inner
product with the query) lies in one of the query's windows.  It takes two steps:

1. The zone maps alone are read.  Interval arithmetic over a block's dimensions
   bounds the scores that a query can have there; a block that no window of a
   tile's queries meets is not read for that tile.
2. Queries meet the blocks that they must read.  A window closes from below as
   better rows are found, and the bounds are tested again before a block is
   scored.

A tile holds up to 65,536 queries; blocks stream past it.  Where tiles are few,
the blocks are dealt over several tasks a tile.  So a task's memory does not
grow with the data, and no label, vector or group of copies is the key of a
shuffle.

Mining is two searches: the best rows of the same label, with windows that begin
at the scores within each anchor's own block; then the best rows of other labels
within the window that each positive sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, shuffle_partitions, written

# Rows of a block, or of a group of queries; queries of a tile.
BLOCK, TILE = 256, 65_536
# Bits a dimension of the curve.
CURVE_BITS = 4
# Blocks whose bounds are found at a time, and windows that score a block at a time.
AT_A_TIME, WINDOWS_AT_A_TIME = 32, 4096
# Rows held in a tile before the best are chosen.
HELD = 1 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1

ROW_DDL = "label long, place binary, id long, vector binary"
BLOCK_DDL = ("block long, label long, ids array<long>, vectors binary, low binary, high binary, "
             "seed_ids array<long>, seeds array<long>")
GROUP_DDL = ("tile int, label long, ids array<long>, vectors binary, "
             "windows array<struct<query:int,tag:long,low:long,high:long>>")


# vectors and bounds, in tasks

def hilbert_places(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``cells`` (rows, dimensions; below 2 ** bits) on the
    Hilbert curve, as bytes that sort in the curve's order."""
    x = cells.T.astype(np.uint32).copy()  # dimension by dimension
    n = len(x)
    if not n:
        return [b""] * cells.shape[0]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1)).astype(np.uint32)
            x[0] ^= np.where(turned, q - 1, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where((x[-1] & q) > 0, q - 1, 0).astype(np.uint32)
    x ^= flip
    # the highest bit of every dimension comes first
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def exact_type(size: int, top: int) -> type:
    """A type in which inner products of such vectors are exact."""
    most = size * max(top, 1) ** 2
    if 100 * most >= 1 << 63:
        raise ValueError("inner products beyond 64 bits")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def scores(a: np.ndarray, b: np.ndarray, kind: type) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers."""
    return (a.astype(kind, copy=False) @ b.astype(kind, copy=False).T).astype(np.int64)


def score_bounds(plus: np.ndarray, minus: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query (given as its positive and
    its negative part) with any vector between ``low`` and ``high``, one row a
    block: sums of intervals."""
    return (plus @ low.T + minus @ high.T).astype(np.int64), (plus @ high.T + minus @ low.T).astype(np.int64)


def _matrix(parts: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.int32).reshape(-1, size)


# rows, blocks and groups

def whole_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, label, vector``: components ``floor(scale * x)``.  Rows with a null
    identifier, label or vector, or a null or non-finite component, are left
    out; of rows that share an identifier the least (label, vector) stays."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                     F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _placed(rows: DataFrame, size: int, low: int, high: int) -> DataFrame:
    """Rows with their place on the curve; shorter vectors end in zeros."""
    span = max(high - low + 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, given = batch.column(0), batch.column(1), batch.column(2)
            lengths = np.diff(given.offsets.to_numpy())
            m = np.zeros((len(lengths), size), np.int64)
            m[np.arange(size) < lengths[:, None]] = given.flatten().to_numpy()
            cells = ((m - low) * (1 << CURVE_BITS)) // span
            yield pa.RecordBatch.from_arrays(
                [labels, pa.array(hilbert_places(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS), pa.binary()), ids,
                 pa.array([v.tobytes() for v in m.astype(np.int32)], pa.binary())], names=["label", "place", "id", "vector"])

    return rows.select("id", "label", "vector").mapInArrow(run, ROW_DDL)


def _blocks(rows: DataFrame, size: int, kind: type, ranges: int, most_rows: int, every: int, positives: int) -> DataFrame:
    """The rows in their order as blocks of one label, with zone maps.  ``seeds``
    are, for each anchor in the block, the score of its last positive within
    the block (the least number if it has too few there)."""
    schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary()),
                        ("low", pa.binary()), ("high", pa.binary()), ("seed_ids", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])

    def pack(number: int, label: int, held: list) -> pa.RecordBatch:
        ids, m = np.array([h[0] for h in held], np.int64), _matrix([h[1] for h in held], size)
        own = np.flatnonzero(ids % every == 0)
        seeds = np.full(len(own), LEAST, np.int64)
        if len(own) and len(ids) > positives:
            s = scores(m[own], m, kind)
            s[np.arange(len(own)), own] = LEAST
            seeds = np.partition(s, len(ids) - positives, axis=1)[:, len(ids) - positives]
        return pa.RecordBatch.from_pylist([{
            "block": (TaskContext.get().partitionId() << 32) + number, "label": label, "ids": ids.tolist(), "vectors": m.tobytes(),
            "low": m.min(axis=0).tobytes(), "high": m.max(axis=0).tobytes(), "seed_ids": ids[own].tolist(), "seeds": seeds.tolist()}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (label, held) in enumerate(_stretches(batches, most_rows)):
            yield pack(number, label, held)

    return (rows.select("label", "place", "id", "vector").repartitionByRange(ranges, "label", "place", "id")
            .sortWithinPartitions("label", "place", "id").select("label", "id", "vector").mapInArrow(run, BLOCK_DDL))


def _stretches(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[tuple[int, list[list]]]:
    """A label, and consecutive rows of it, without the label."""
    held, label = [], None
    for batch in batches:
        for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (own != label or len(held) == most_rows):
                yield label, held
                held = []
            label = own
            held.append(row)
    if held:
        yield label, held


def _groups(queries: DataFrame, count: int, most_rows: int, tile: int) -> DataFrame:
    """``count`` queries (``label, place, id, vector, windows``) in their order, as
    groups of one label; a window is (tag, low, high).  A task makes one tile."""
    schema = pa.schema([("tile", pa.int32()), ("label", pa.int64()), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary()),
                        ("windows", pa.list_(pa.struct([("query", pa.int32()), ("tag", pa.int64()), ("low", pa.int64()),
                                                        ("high", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, held in _stretches(batches, most_rows):
            yield pa.RecordBatch.from_pylist([{
                "tile": TaskContext.get().partitionId(), "label": label, "ids": [h[0] for h in held],
                "vectors": b"".join(h[1] for h in held),
                "windows": [{"query": k, **w} for k, h in enumerate(held) for w in h[2]]}], schema)

    return (queries.select("label", "place", "id", "vector", "windows")
            .repartitionByRange(max(-(-count // tile), 1), "label", "place", "id")
            .sortWithinPartitions("label", "place", "id").select("label", "id", "vector", "windows").mapInArrow(run, GROUP_DDL))


class Tile:
    """Queries, their windows, and the best rows so far."""

    def __init__(self, groups: list[dict], size: int, kind: type, same_label: bool, best: int, most_held: int) -> None:
        self.size, self.kind, self.same_label, self.best, self.most_held = size, kind, same_label, best, most_held
        sizes = [len(g["ids"]) for g in groups]
        self.ids = np.array([i for g in groups for i in g["ids"]], np.int64)
        self.vectors = _matrix([g["vectors"] for g in groups], size).astype(kind)
        self.plus, self.minus = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        shift = np.repeat(np.cumsum(sizes) - sizes, [len(g["windows"]) for g in groups])
        self.query = np.array([w["query"] for g in groups for w in g["windows"]], np.int64) + shift
        self.tag, self.low, self.high = (np.array([w[c] for g in groups for w in g["windows"]], np.int64) for c in ("tag", "low", "high"))
        self.label = np.repeat(np.array([g["label"] for g in groups], np.int64), sizes)[self.query]
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def meeting(self, blocks: list[dict]) -> np.ndarray:
        """Which windows (rows) the scores of which blocks can meet, by zone maps."""
        low, high = (_matrix([b[c] for b in blocks], self.size).astype(self.kind) for c in ("low", "high"))
        least, most = score_bounds(self.plus, self.minus, low, high)
        labels = np.array([b["label"] for b in blocks], np.int64)
        return ((most[self.query] >= self.low[:, None]) & (least[self.query] <= self.high[:, None])
                & ((self.label[:, None] == labels) == self.same_label))

    def score(self, windows: np.ndarray, block: dict) -> None:
        ids, vectors = np.array(block["ids"], np.int64), _matrix([block["vectors"]], self.size)
        for k in range(0, len(windows), WINDOWS_AT_A_TIME):
            part = windows[k:k + WINDOWS_AT_A_TIME]
            asked, row = np.unique(self.query[part], return_inverse=True)
            s = scores(self.vectors[asked], vectors, self.kind)[row]
            w, at = np.nonzero((s >= self.low[part, None]) & (s <= self.high[part, None]) & (self.ids[self.query[part], None] != ids))
            if len(w):
                self.found.append((part[w], s[w, at], ids[at]))
                self.held += len(w)
        if self.held > self.most_held:
            self.choose()

    def choose(self) -> tuple[np.ndarray, ...]:
        """The best rows of each window (window, score, identifier); a window that
        has enough closes below them."""
        if not self.found:
            return (np.zeros(0, np.int64),) * 3
        w, s, i = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((i, -s, w))
        w, s, i = w[order], s[order], i[order]
        rank = np.arange(len(w)) - np.searchsorted(w, w)
        last = rank == self.best - 1
        self.low[w[last]] = s[last]
        keep = rank < self.best
        self.found, self.held = [(w[keep], s[keep], i[keep])], int(keep.sum())
        return self.found[0]


def _tiled(groups: DataFrame, blocks: DataFrame, parts: int, ranges: int) -> DataFrame:
    """Both sides' rows by tile and part, groups first.  ``blocks`` have a ``tile``."""
    wide = [*groups.drop("tile").schema, *[f for f in blocks.drop("tile").schema if f.name not in groups.columns]]

    def side(df: DataFrame, part: Column, is_block: bool) -> DataFrame:
        return df.select("tile", part.alias("part"), F.lit(is_block).alias("is_block"), *[
            (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wide])

    both = side(groups, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), False).unionByName(
        side(blocks, F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"), True))
    return both.repartition(ranges, "tile", "part").sortWithinPartitions("tile", "part", "is_block")


def _tiles(batches: Iterator[pa.RecordBatch], **of_tile) -> Iterator[tuple[int, Tile, list[dict] | None]]:
    """Of sorted rows: a tile's number, the tile and some of its blocks; at its
    end the tile once more, without blocks."""
    at, groups, tile, blocks = None, [], None, []
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if (row["tile"], row["part"]) != at:
                if tile is not None:
                    yield at[0], tile, blocks
                    yield at[0], tile, None
                at, groups, tile, blocks = (row["tile"], row["part"]), [], None, []
            if not row["is_block"]:
                groups.append(row)
                continue
            if not groups:  # no queries at all
                continue
            if tile is None:
                tile = Tile(groups, **of_tile)
            blocks.append(row)
            if len(blocks) == AT_A_TIME:
                yield at[0], tile, blocks
                blocks = []
    if tile is not None:
        if blocks:
            yield at[0], tile, blocks
        yield at[0], tile, None


def search(groups: DataFrame, blocks: DataFrame, size: int, kind: type, same_label: bool, best: int, held: int = HELD) -> DataFrame:
    """``id, tag, score, other, rank``: for each window of each query the ``best``
    rows with the largest scores within the window (of equal ones the smaller
    identifiers first), among rows of the query's label, or of all other labels.  A query is
    no answer to itself."""
    of_tile = {"size": size, "kind": kind, "same_label": same_label, "best": best, "most_held": held}
    ranges = max(shuffle_partitions(blocks.sparkSession), 1)
    tiles = (groups.agg(F.max("tile")).first()[0] or 0) + 1
    parts = -(-4 * ranges // tiles)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, tile, some in _tiles(batches, **of_tile):
            if some:
                met = tile.meeting(some).any(axis=0)
                names = [b["block"] for b, m in zip(some, met) if m]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(names), pa.int32()), pa.array(names, pa.int64())],
                                                 names=["tile", "block"])

    zones = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), "block", "label", "low", "high")
    needed = written(_tiled(groups, zones, parts, ranges).mapInArrow(plan, "tile int, block long"), "blocks-to-read")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tile, some in _tiles(batches, **of_tile):
            if some is None:
                w, s, i = tile.choose()
                for k in range(0, len(w), 1 << 16):
                    at = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tile.ids[tile.query[w[at]]]), pa.array(tile.tag[w[at]]), pa.array(s[at]), pa.array(i[at])],
                        names=["id", "tag", "score", "other"])
            elif some:
                met = tile.meeting(some)
                for k, block in enumerate(some):
                    tile.score(np.flatnonzero(met[:, k]), block)

    data = blocks.drop("seed_ids", "seeds").join(needed, "block")
    found = _tiled(groups, data, parts, ranges).mapInArrow(meet, "id long, tag long, score long, other long")
    order = Window.partitionBy("id", "tag").orderBy(F.desc("score"), "other")  # at most ``best`` rows a part
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def mine_hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                        scale: float = 256.0, block: int = BLOCK, tile: int = TILE, held: int = HELD) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    Anchors are the rows whose identifier is divisible by ``every``; all rows
    are candidates.  An anchor's positives are the ``positives`` other rows of
    its label with the largest scores; for each of them the answer holds the
    first ``negatives`` rows of other labels whose score is between ``low`` and
    ``high`` percent of the positive's.  Scores are inner products of
    ``floor(scale * x)``; larger ones come first, then smaller identifiers.
    Nothing is capped: a window that holds many rows is searched as a whole.
    ``block`` (rows of a block), ``tile`` (queries of a tile) and ``held`` (rows
    kept in a tile before the best are chosen) change the work, not the answer.

    Rows with a null identifier, label, vector or component, or a component
    that is not finite, take no part.  Rows that share an identifier count
    once, as the one of the least label and vector.  Vectors of different
    lengths meet as if the shorter ended in zeros.  A positive of a negative
    score has an empty window.  Components whose products may pass 63 bits are
    refused with an error.  Other columns are not read; empty input gives an
    empty result.
    """
    spark = df.sparkSession
    ship_code(spark)
    rows = written(whole_vectors(df, id_col, vector_col, label_col, scale), "vectors")
    size, least, most = rows.agg(F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    size, least, most = max(size or 0, 1), min(least or 0, 0), max(most or 0, 0)
    kind = exact_type(size, max(-least, most))
    ranges = max(shuffle_partitions(spark), 1)
    placed = written(_placed(rows, size, least, most), "placed-vectors")
    blocks = written(_blocks(placed, size, kind, ranges, block, every, positives), "vector-blocks")

    # an anchor's first window begins at its last positive within its own block
    seed = blocks.select(F.explode(F.arrays_zip("seed_ids", "seeds")).alias("a")).select("a.seed_ids", "a.seeds")
    anchors = written(placed.filter(F.col("id") % every == 0).join(seed, F.col("id") == F.col("seed_ids")), "anchors")
    count = anchors.count()

    def window(tag: str, least_: str, most_: str) -> Column:
        return F.expr(f"named_struct('tag', {tag}, 'low', {least_}, 'high', {most_})")

    first = anchors.withColumn("windows", F.array(window("0L", "seeds", f"{MOST}L")))
    groups = written(_groups(first, count, block, tile), "anchor-groups")
    positive = written(search(groups, blocks, size, kind, True, positives, held).select(
        "id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # low * score <= 100 * negative <= high * score, in whole numbers
    floor = lambda x: f"(({x}) - pmod({x}, 100L)) div 100"
    opened = positive.select("id", window("positive_id", f"-({floor(f'-{low} * positive_score')})",
                                          floor(f"{high} * positive_score")).alias("w")).filter("w.low <= w.high")
    windows = opened.groupBy("id").agg(F.collect_list("w").alias("windows"))  # at most ``positives`` each
    asked = written(_groups(anchors.join(windows, "id"), count, block, tile), "anchor-windows")
    found = search(asked, blocks, size, kind, False, negatives, held)
    return found.withColumnRenamed("tag", "positive_id").join(positive, ["id", "positive_id"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

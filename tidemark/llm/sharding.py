"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded digest and ranked within their source; a row's
fractional rank (rank + 1/2) / n lies evenly in 0..1 for every source, so the
rows sorted by it show the mixture in every stretch, and cuts at equal counts
give shards that all match it.  Ranks are not counted in one task a source:
rows are counted by narrow bins first, and only ranks within a bin are sorted.
Whole rows travel twice, to their bin and to their stretch, and are written from
there; a task writes a range of slots, not a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_table, shuffle_partitions, utf8_size, written

# Digest bins a source, and bins of the fractional rank: they bound what one
# task sorts to about rows / BINS.
BINS = 4096


def _digest(seed: int, *cols: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols]))


def _bin_of(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def _stretches(sizes: DataFrame) -> DataFrame:
    """``stretch, ahead, total``: the rows in earlier stretches, and in all, from
    the strata's sizes ``of``.  A stratum's first rank in stretch k is the least
    r with (2 r - 1) BINS >= 2 of k; ranks of small strata are listed."""
    def first(k: str) -> str:
        return f"((2 * of * ({k}) + {3 * BINS - 1}) div {2 * BINS})"

    large = sizes.filter(F.col("of") > BINS).select("of", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("stretch"))
    large = large.select("stretch", F.expr(f"{first('stretch + 1')} - {first('stretch')}").alias("n"))
    small = (sizes.filter(F.col("of") <= BINS).groupBy("of").agg(F.count(F.lit(1)).alias("n"))
             .select("of", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("of"))).alias("r"))
             .select(F.expr(f"cast(((2 * r - 1) * {BINS}) div (2 * of) as int)").alias("stretch"), "n"))
    line = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    return (large.unionByName(small).groupBy("stretch").agg(F.sum("n").alias("n"))  # BINS rows at most
            .select("stretch", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("ahead"),
                    F.sum("n").over(Window.partitionBy()).alias("total")))


def _sum_of(*cols: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("h")]


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text", strata_col: str = "source") -> None:
    """Write every row of ``docs`` whole: ``doc`` (a struct of all input columns,
    so names cannot clash) and ``slot``, one folder ``shard=N`` a shard.

    A file holds a range of a shard's slots in order, and files in order of
    their names go on where the one before ends.  ``docs`` is read twice; if its
    rows are others the second time, the files are not to be used and an error
    says so.  Empty input writes an empty table.
    """
    spark = docs.sparkSession
    field = lambda c: F.col(f"doc.`{c}`")
    text = F.coalesce(field(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select(
        "doc", F.coalesce(F.concat(F.lit("="), field(strata_col).cast("string")), F.lit("")).alias("stratum"),
        _digest(seed, field(id_col), F.md5(text)).alias("draw")).withColumn("bin", _bin_of(F.col("draw")))

    # 1. rank within the stratum: rows of earlier bins, then place in the bin
    by_source = Window.partitionBy("stratum")
    before = by_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = written(rows.groupBy("stratum", "bin").agg(*_sum_of("stratum", "draw")).select(
        "stratum", "bin", "h", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
        F.sum("n").over(by_source).alias("of")), "shards-bins")
    counted = bins.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("h").alias("h")).first()
    if not counted.n:
        rows.limit(0).select("doc", F.lit(0).cast("long").alias("slot")).write.parquet(f"{path}/shard=0")
        return
    place = F.row_number().over(Window.partitionBy("stratum", "bin").orderBy("draw", field(id_col).cast("long")))
    rank = F.col("ahead") + F.col("place")
    ranked = (rows.withColumn("place", place).join(bins.drop("h", "n"), ["stratum", "bin"], "left")
              .withColumn("at", (rank - F.lit(0.5)) / F.col("of"))
              .withColumn("stretch", F.expr(f"cast(((2 * (ahead + place) - 1) * {BINS}) div (2 * of) as int)")))

    # 2. place in the whole order: rows of earlier stretches, then place in it;
    # a task has neighbouring stretches
    stretches = written(_stretches(bins.groupBy("stratum").agg(F.first("of").alias("of"))), "shards-stretches")
    parts = min(BINS, max(shards, shuffle_partitions(spark)))
    seen = Observation()
    dealt = (ranked.observe(seen, *_sum_of("stratum", "draw"))
             .withColumn("part", F.coalesce(F.expr(f"cast(stretch * {parts} div {BINS} as int)"), F.lit(0)))
             .select("doc", "draw", "at", "stretch", "part")
             .repartitionById(parts, F.col("part")))
    within = F.row_number().over(Window.partitionBy("part", "stretch").orderBy("at", "draw", field(id_col).cast("long")))
    # the first position of a shard is ceil(shard * total / shards)
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    (dealt.withColumn("place", within).join(F.broadcast(stretches), "stretch", "left")
     .withColumn("pos", F.col("ahead") + F.col("place") - 1)
     .withColumn("shard", F.expr(f"(pos * {shards}) div total").cast("int"))
     .select("doc", (F.col("pos") - first).alias("slot"), "shard")
     .sortWithinPartitions("shard", "slot")
     .write.option("compression", "zstd").partitionBy("shard").parquet(path))
    if (counted.n, counted.h) != (seen.get["n"], seen.get["h"]):
        raise ValueError("the documents changed between two reads; write them as a table first")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of written shards: ``doc, slot, shard``."""
    return spark.read.parquet(path).withColumn("shard", F.col("shard").cast("int"))


def stratified_shards(docs: DataFrame, shards: int = 24, seed: int = 42, id_col: str = "doc_id",
                      text_col: str = "text", strata_col: str = "source") -> DataFrame:
    """Write the shards to the shared scratch folder and read them back, one row
    per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``
    and ``source``.

    ``law`` is ``rows``: shard counts differ by one at most, and each stratum
    is spread evenly over the shards.  ``size`` is the text's UTF-8 bytes
    (null: 0) plus 8; ``text_crc32`` of a null text is that of an empty one.
    A null stratum is a stratum of its own.  Rows that share an identifier are
    ordered by their text's digest; rows equal in both take neighbouring
    places in either order.  Empty input gives an empty result.
    """
    path = scratch_table(docs.sparkSession, "shard-files")
    write_shards(docs, path, shards, seed, id_col, text_col, strata_col)
    text = F.col(f"doc.`{text_col}`")
    return read_shards(docs.sparkSession, path).select(
        F.col(f"doc.`{id_col}`").cast("long").alias("doc_id"), (utf8_size(text) + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col(f"doc.`{strata_col}`").cast("string").alias("source"))

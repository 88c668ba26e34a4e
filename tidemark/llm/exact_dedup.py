"""Exact dedup by content sort.

Sampled splitters cut the order of (normalised bytes, identifier) into ranges;
each range is sorted externally, so equal texts lie next to each other, and a
full comparison with the preceding text starts or continues a run.  A run that
crosses a cut is rejoined from the first and last text of each range, at most
two rows a range.  As the identifier is part of the order, a text that fills a
third of all rows is spread over as many ranges as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, ordered_id, shuffle_partitions, written
from tidemark.llm.ranges import range_of, splitters

def _sort_key(norm: Column, sha: Column, ident: Column) -> Column:
    """Order: leading bytes, digest of the whole text, identifier.  Equal texts
    share the first two parts, so they are contiguous."""
    return F.concat(F.hex(F.substring(norm, 1, 16)), F.lit(" "), sha, ordered_id(ident))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max", ranges: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty.  Of equal texts the largest (``keep="max"``) or smallest
    (``"min"``) identifier stays.  Rows that repeat both identifier and text
    form one group of which a single row is kept.  A null identifier sorts
    before all others and is kept only where its group has no other (or, with
    ``"min"``, first).  An empty table gives an empty result; other columns are
    not read.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    ranges = ranges or shuffle_partitions(docs.sparkSession)
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    keyed = (docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
             .withColumn("sha", F.sha2("norm", 256))
             .withColumn("key", _sort_key(F.col("norm"), F.col("sha"), F.col("doc_id"))))
    cuts = splitters(keyed, ranges)
    dealt = (keyed.withColumn("bucket", range_of(F.col("key"), cuts))
             .repartitionById(len(cuts) + 1, F.col("bucket")))

    order = Window.partitionBy("bucket").orderBy("key")
    before = F.lag("norm").over(order)
    flagged = dealt.select(
        "bucket", "key", "doc_id", "sha",
        (before.isNull() | (before != F.col("norm"))).cast("int").alias("starts"),
        F.when(before.isNull() | F.lead("key").over(order).isNull(), F.col("norm")).alias("edge"))
    runs = flagged.withColumn("run", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    of_run = Window.partitionBy("bucket", "run")
    best = F.desc("key") if keep == "max" else F.asc("key")
    rows = written(runs.select(
        "bucket", "run", "doc_id", "sha", "key", "edge",
        F.count(F.lit(1)).over(of_run).alias("run_n"),
        F.first("doc_id").over(of_run.orderBy(best)).alias("run_keep"),
        F.row_number().over(of_run.orderBy(best)).alias("place")), "exact-dedup")

    # At most two rows a range meet here.
    line = Window.orderBy("key")
    edges = (rows.filter(F.col("edge").isNotNull())
             .withColumn("joins", F.coalesce(F.lag("edge").over(line) == F.col("edge"), F.lit(False)))
             .withColumn("chain", F.sum((~F.col("joins")).cast("int")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("chain", "bucket", "run")
             .agg(F.max("run_n").alias("run_n"), F.max("run_keep").alias("run_keep")))
    of_chain = Window.partitionBy("chain")
    at_end = F.desc("bucket") if keep == "max" else F.asc("bucket")
    chains = edges.select(
        "bucket", "run",
        F.sum("run_n").over(of_chain).alias("chain_n"),
        F.first("run_keep").over(of_chain.orderBy(at_end)).alias("chain_keep"),
        F.row_number().over(of_chain.orderBy(at_end)).alias("chain_place"))
    return rows.join(F.broadcast(chains), ["bucket", "run"], "left").select(
        "doc_id",
        F.when(F.col("chain_n").isNull(), F.col("run_keep")).otherwise(F.col("chain_keep")).alias("keep_id"),
        F.coalesce("chain_n", "run_n").cast("long").alias("group_size"),
        ((F.col("place") == 1) & (F.coalesce("chain_place", F.lit(1)) == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))

"""Exact distinct counts that are kept from run to run.

Each distinct value gets a dense number once (``operators.keys``), and a run keeps
the numbers that it saw as bitmaps: one row for 32,768 numbers.  Counts over any
runs are the bits of their bitmaps, or-ed; no run reads the rows of another, and
no row is expanded for each counted column.

    path/<column>/values     value and number, by the run that first saw it
    path/<column>/seen/version=V   ``block, bits`` of run V
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import keyed_rows, last_key, load_with_keys
from tidemark.session import materialize
from tidemark.streaming.keyed_store import complete_versions


def add_run(rows: DataFrame, path: str, version: int, columns: list[str]) -> None:
    """Keep the distinct non-null values of ``columns`` in ``rows`` as run
    ``version``.  A run made twice replaces its own bitmaps."""
    spark = rows.sparkSession
    for c in columns:
        values = f"{path}/{c}/values"
        seen = materialize(rows.select(F.col(f"`{c}`").alias("value")).filter(F.col("value").isNotNull()).distinct())
        fresh = seen
        if last_key(spark, values, version):
            fresh = seen.join(keyed_rows(spark, values).select("value"), "value", "left_anti")
        load_with_keys(fresh, values, version, ["value"], "number")
        numbers = seen.join(keyed_rows(spark, values), "value").select((F.col("number") - 1).alias("n"))
        bits = numbers.groupBy(F.bitmap_bucket_number("n").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
        bits.write.mode("overwrite").parquet(f"{path}/{c}/seen/version={version}")


def distinct_counts(spark: SparkSession, path: str, columns: list[str], versions: list[int] | None = None) -> DataFrame:
    """One row: the distinct values of each column over all runs, or the given ones."""
    schema = "block long, bits binary"
    runs = spark.createDataFrame([], f"column string, {schema}")
    for c in columns:
        known = [v for v in complete_versions(spark, f"{path}/{c}/seen") if versions is None or v in versions]
        if known:
            bits = spark.read.schema(schema).parquet(*[f"{path}/{c}/seen/version={v}" for v in known])
            runs = runs.unionByName(bits.withColumn("column", F.lit(c)))
    merged = runs.groupBy("column", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(*[F.coalesce(F.sum(F.when(F.col("column") == c, F.bitmap_count("bits"))), F.lit(0)).alias(c) for c in columns])

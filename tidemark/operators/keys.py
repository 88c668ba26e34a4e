"""Generated keys that go on from load to load.

A load's rows are put in order and written with their place: partition and
position within it.  A row's key is the saved high-water mark, plus the rows of
earlier partitions, plus its position: keys are gapless, and no row passes
through one task or the driver.

    path/rows/version=V    rows of load V with their keys
    path/marks/version=V   ``last``: the largest key after load V; puts it in force
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.streaming.keyed_store import complete_versions


def last_key(spark: SparkSession, path: str, before: int | None = None) -> int:
    """The largest key given out by the loads in force (below ``before``); 0 at first."""
    known = [v for v in complete_versions(spark, f"{path}/marks") if before is None or v < before]
    if not known:
        return 0
    return spark.read.schema("last long").parquet(f"{path}/marks/version={known[-1]}").first().last


def with_dense_key(rows: DataFrame, order: list[str], key: str, start: int = 0) -> DataFrame:
    """``rows`` with the keys ``start + 1, start + 2, ...`` in the given order;
    rows that are equal in it are numbered either way."""
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumns({"_part": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND((1 << 33) - 1)})
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    return placed.join(F.broadcast(parts), "_part").select(
        (F.col("_ahead") + F.col("_pos") + F.lit(start + 1)).alias(key), *[F.col(f"`{c}`") for c in rows.columns])


def load_with_keys(rows: DataFrame, path: str, version: int, order: list[str], key: str) -> bool:
    """Write load ``version`` with keys that go on where the loads before it ended.
    A load that is in force is not repeated (False); one that broke off is overwritten."""
    spark = rows.sparkSession
    if version in complete_versions(spark, f"{path}/marks"):
        return False
    start = last_key(spark, path, version)
    with_dense_key(rows, order, key, start).write.mode("overwrite").parquet(f"{path}/rows/version={version}")
    n = spark.read.parquet(f"{path}/rows/version={version}").count()
    spark.createDataFrame([(start + n,)], "last long").coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/version={version}")
    return True


def keyed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all loads in force."""
    known = complete_versions(spark, f"{path}/marks")
    return spark.read.parquet(*[f"{path}/rows/version={v}" for v in known])

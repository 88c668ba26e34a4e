"""Bloom filters of the keys that each batch wrote, beside the data.

A filter is cut into blocks of 32,768 bits.  A key sets ``HASHES`` bits within one
block, so a filter is a table ``block, bitmap`` built by one aggregation that
combines bits before the shuffle, and a key is tested against a batch with one
row of it.  Testing the keys of a new batch says which earlier batches may hold
any of them; only these are read.  A filter never misses a key; where it errs, a
batch is read for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
# Bits a key, and bits that it sets: about 3 in 10 million foreign keys pass.
KEY_BITS, HASHES = 32, 16
SCHEMA = "block int, bitmap binary, blocks int"


def _places(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(1, HASHES + 1)])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks)).cast("int")


def build_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of the column ``key``: ``block, bitmap, blocks``."""
    bits = keys.select(_block(F.col(key), blocks).alias("block"), F.explode(_places(F.col(key))).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).withColumn("blocks", F.lit(blocks))


def holds(bitmap: Column, places: Column) -> Column:
    """Whether all these bits of a block are set."""
    def bit(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (p % 8).cast("int")) == 1

    return F.forall(places, bit)


class KeyFilters:
    """Filters under ``path``, one folder ``batch_id=N`` a batch.

    The number of blocks follows from the first batch's keys and stays: larger
    batches than it was made for still give right answers, but pass more keys.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path, key

    def _blocks(self, batches: list[int], keys: DataFrame) -> int:
        if batches:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/batch_id={batches[0]}").first().blocks
        wanted = -(-keys.count() * KEY_BITS // BLOCK_BITS)
        return 1 << max(wanted - 1, 15).bit_length()

    def add(self, keys: DataFrame, batch_id: int, batches: list[int]) -> None:
        """Write the filter of a batch's keys; ``batches`` have filters already."""
        (build_filter(keys, self.key, self._blocks([b for b in batches if b != batch_id], keys)).coalesce(1)
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/batch_id={batch_id}"))

    def may_hold(self, keys: DataFrame, batches: list[int]) -> list[int]:
        """Of ``batches``, those that may hold any of the keys: one number a batch."""
        if not batches:
            return []
        filters = self.spark.read.option("basePath", self.path).schema(f"{SCHEMA}, batch_id int").parquet(
            *[f"{self.path}/batch_id={b}" for b in batches])
        blocks = self._blocks(batches, keys)
        asked = keys.select(_block(F.col(self.key), blocks).alias("block"), _places(F.col(self.key)).alias("places"))
        found = asked.join(filters.select("batch_id", "block", "bitmap"), "block").filter(holds(F.col("bitmap"), F.col("places")))
        return sorted(r.batch_id for r in found.select("batch_id").distinct().collect())

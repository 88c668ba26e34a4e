"""Range partitioning by explicit sampled splitters.

Spark's own range partitioning would run the plan below it twice (once for the
sample) and its partitions cannot serve a window without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sampled keys for each range, and the most keys brought to the driver at once.
OVERSAMPLE = 60
MAX_SAMPLE = 200_000


def splitters(keys: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges - 1`` sorted keys that cut the string column ``key``
    into parts of about equal rows.  Any splitters give a right order."""
    total = keys.count()
    want = max(min(ranges * OVERSAMPLE, MAX_SAMPLE), ranges)
    sample = sorted(r[0] for r in keys.select("key").sample(min(1.0, want / max(total, 1)), seed=17).collect())
    if not sample:
        return []
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)})


def range_of(key: Column, cuts: list[str]) -> Column:
    """How many splitters are <= key, by binary search.  Keys hold no comma."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(cuts)), ",")

    def halve(acc, _):
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        open_ = acc["lo"] < acc["hi"]
        right = open_ & (F.get(table, mid) <= key)
        return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~right, mid).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])

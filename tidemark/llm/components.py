"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each component, for every node of
    ``edges`` (``a, b``, any comparable type).

    A round takes each node's smallest neighbouring label, then the label of
    that label, so chains shorten by doubling.  Each round is written as a
    table; rounds go on until no label changes.
    """
    name = "components"
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct(), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), f"{name}-0")
    step = 0
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m")))
        taken = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        leads = labels.select(F.col("node").alias("lead"), F.col("label").alias("far"))
        step += 1
        new = written(taken.join(leads, F.col("label") == F.col("lead")).select(
            "node", F.least("label", "far").alias("label"), (F.col("old") != F.least("label", "far")).alias("moved")), f"{name}-{step}")
        labels = new.select("node", "label")
        if not new.filter("moved").limit(1).count():
            return labels

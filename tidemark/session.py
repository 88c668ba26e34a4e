"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock, AQE with skew-join splitting and
# partition coalescing, Arrow for the few pandas hand-offs.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files of materialised layers once they are released
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def is_local(master: str) -> bool:
    """One process on this machine (not ``local-cluster``)."""
    return re.match(r"local(\[|$)", master) is not None


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A session with the settings every job relies on.

    The number of shuffle partitions is set only if given, or on a local
    master; on a cluster the operator's own setting stays.
    """
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and is_local(master):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to a shared file system.  Only on a
    local master a scratch folder of our own stands in when it is unset;
    elsewhere that would be a folder that other machines cannot see.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if getattr(sc, "_tidemark_checkpoint_dir", None) != d:
        sc.setCheckpointDir(d)
        sc._tidemark_checkpoint_dir = d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used at the pipeline's natural layer boundaries (validated events, silver
    rows, vocabularies), where several downstream branches would otherwise
    recompute the same upstream work.  A reliable checkpoint survives executor
    loss (unlike a local checkpoint, which is never used).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

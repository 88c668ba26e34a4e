"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import string
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python need not find it by
    itself.  Spark copies the archive from the driver; once a context."""
    import tidemark

    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._tidemark_shipped = True


# Scratch tables that this process has written, oldest first, and those written
# within ``own_scratch`` of a thread.
_SCRATCH: list[str] = []
_OWN = threading.local()


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table in the shared checkpoint folder."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    for tables in getattr(_OWN, "open", []):
        tables.append(path)
    return path


def scratch_tables() -> list[str]:
    return list(_SCRATCH)


@contextmanager
def own_scratch() -> Iterator[list[str]]:
    """The scratch tables that this thread writes within the block."""
    tables: list[str] = []
    _OWN.open = [*getattr(_OWN, "open", []), tables]
    try:
        yield tables
    finally:
        _OWN.open = [t for t in _OWN.open if t is not tables]


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables whose results have been stored elsewhere."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _SCRATCH.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage is cut and a lost executor costs no recomputation."""
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """In a task: return freed memory to the system.  Python workers live on
    beside the next tasks, and keep what their allocators hold."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Texts of ASCII alone take the byte-wise
    ``lower``; others go through ``translate``."""
    up, low = string.ascii_uppercase, string.ascii_lowercase
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, up, low))


def ordered_id(c: Column) -> Column:
    """A fixed-width string that sorts as the long ``c`` does (null first)."""
    c = c.cast("long")
    digits = F.lpad(F.hex(c.bitwiseAND(F.lit((1 << 63) - 1))), 16, "0")
    return F.when(c.isNull(), F.lit("")).otherwise(
        F.concat(F.when(c < 0, F.lit("0")).otherwise(F.lit("1")), digits))


def utf8_size(c: Column) -> Column:
    return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")

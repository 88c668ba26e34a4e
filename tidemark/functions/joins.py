"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side we hint for broadcast; beyond it Spark plans a shuffle join and
# AQE may still demote it to a broadcast from runtime statistics.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of a plan; for compressed files it can be too
    low, so it only ever decides small dimension tables read as they are."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``max_bytes``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def measured_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a *materialised* table when its measured size is within bound.

    Rows and the real lengths of all texts are summed in one pass over the
    written data.  Beyond the bound the table joins through a shuffle.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory: 8 bytes a column, and what texts hold; nested
    columns count as the JSON text they would make."""
    size = F.lit(8 * (len(df.columns) + 1))
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) * 2
    return size


def measured_bytes(df: DataFrame) -> int:
    return int(df.agg(F.sum(row_bytes(df))).first()[0] or 0)

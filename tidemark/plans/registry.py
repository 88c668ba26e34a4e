"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole given
tables; builders that write layers, fit models or run streams do so when called.  Double outputs are rounded to 6 places on both sides so the
value hash does not depend on floating-point summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Presentation of a query result, identical however a client converts it
    (row objects or pandas): doubles and decimals as doubles rounded to
    ``places``; session-zone timestamps as UTC wall-clock ``TIMESTAMP_NTZ``
    (the session zone is pinned to UTC); dates as ISO ``yyyy-MM-dd`` text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            # event times are UTC wall-clock values; pin the session clock so
            # results do not depend on the caller's time zone
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return round_doubles(fn(spark, sf_dir))
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        _QUERIES[name] = wrapped
        if sql is not None:
            _ORACLES[name] = sql
        return wrapped
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # importing the modules registers their queries
    from tidemark.plans import (  # noqa: F401
        q_features,
        q_lake,
        q_telemetry,
        q_training,
        q_validation,
        q_warehouse,
    )

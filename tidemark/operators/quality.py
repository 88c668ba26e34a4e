"""Data-quality checks: row-count expectation, pipeline alerts, null profile, head."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
RAW_ROW_BOUNDS = (0, 1_000_000)       # raw data suite
GOLD_ROW_BOUNDS = (1, 1_000_000)      # gold layer suite
# (alert text, SQL-ish rule over the metrics row)
ALERT_RULES = [
    ("High number of invalid records detected!", "invalid_records > valid_records"),
    ("High number of duplicate records detected!", "duplicate_records > 100"),
    ("Low data volume detected!", "total_records < 100"),
    ("Unusually high data volume detected!", "total_records > 1000000"),
    ("Long processing time detected!", "processing_time > 3600"),
]
# -------------------------------------------------------------------------


def expect_row_count(df: DataFrame, name: str, lo: int, hi: int) -> DataFrame:
    """One result row: expectation name, observed count, success flag."""
    return (df.agg(F.count(F.lit(1)).alias("observed"))
            .select(F.lit(name).alias("expectation"), "observed",
                    F.col("observed").between(lo, hi).alias("success")))


def pipeline_alerts(metrics: DataFrame) -> DataFrame:
    """Metrics row(s) -> one row per raised alert, in rule order."""
    cands = F.array(*[F.when(F.expr(rule), F.struct(F.lit(i).alias("rule_no"), F.lit(text).alias("alert")))
                      for i, (text, rule) in enumerate(ALERT_RULES)])
    return (metrics.select(F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("a"))
            .select("a.rule_no", "a.alert"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column in a single pass, unpivoted to (column_name, null_count)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column_name", "null_count")


def head_n(df: DataFrame, order: str, n: int = 20) -> DataFrame:
    """First n rows by ``order`` (top-k: each task keeps n rows, then one merge)."""
    return df.orderBy(order).limit(n)

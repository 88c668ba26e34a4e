"""Telemetry: rate counters, latency histograms, quantiles, log parsing, alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_event_time
from tidemark.functions.histogram import histogram_quantile

# --- fixed values ---------------------------------------------------------
# Default latency bucket bounds in milliseconds (17 explicit bounds; +Inf implied).
LATENCY_BOUNDS_MS = [0.1, 1, 2, 6, 10, 50, 100, 250, 500, 1000, 1400, 2000, 5000, 10000, 20000, 40000, 60000]
# Syslog container log line: "<pri>ver timestamp container_id container_name pid - - body";
# groups: 1 priority, 2 timestamp, 3 container_id, 4 container_name, 5 body
LOG_LINE_RE = (r"^<([0-9]+)>[0-9]+ ([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"
               r"(?:[zZ]|[+-](?:[01]\d|2[0-3]):?(?:[0-5]\d)?)?) (\S+) (\S+) [0-9]+ - -(?: (.*))?")
# Entries from the telemetry stack's own containers are dropped.
LOG_DROP_NAMES = r"^signoz-(logspout|frontend|alertmanager|query-service|otel-collector|clickhouse|zookeeper)"
ALERT_THRESHOLD = 0.1
# -------------------------------------------------------------------------


def _ts(c: str, df: DataFrame) -> Column:
    return parse_event_time(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c)


def rate_counters(df: DataFrame, ts_col: str, verdict_col: str, width: str = "1 second") -> DataFrame:
    """Success/failure counts per tumbling window (partial aggregation, one shuffle)."""
    w = F.window(_ts(ts_col, df), width)
    return (df.groupBy(w.alias("w"))
            .agg(F.count_if(F.col(verdict_col) == "VALID").alias("success_count"),
                 F.count_if(F.col(verdict_col) != "VALID").alias("failure_count"))
            .select(F.col("w.start").alias("window_start"), "success_count", "failure_count"))


def latency_histogram(df: DataFrame, ts_col: str, value_col: str, dims: list[str],
                      bounds: list[float] = LATENCY_BOUNDS_MS, width: str = "60 seconds") -> DataFrame:
    """Cumulative bucket counts per (window, dims), delta temporality.

    One pass: each bound is a ``count_if(v <= b)`` aggregate, so the map side
    pre-aggregates and only one row per (window, dims) is shuffled.
    """
    w = F.window(_ts(ts_col, df), width)
    v = F.col(value_col)
    aggs = [F.count_if(v <= F.lit(float(b))).cast("double").alias(f"_b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(v).cast("double").alias("_inf"))
    aggs.append(F.sum(v).alias("sum"))
    g = df.groupBy(w.alias("w"), *dims).agg(*aggs)
    return g.select(
        F.col("w.start").alias("window_start"), *dims,
        F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf"))).alias("bounds"),
        F.array(*[F.col(f"_b{i}") for i in range(len(bounds))], F.col("_inf")).alias("counts"),
        F.col("_inf").cast("bigint").alias("count"), "sum")


def with_quantile(df: DataFrame, q: float, out: str = "quantile") -> DataFrame:
    return df.withColumn(out, histogram_quantile("bounds", "counts", f"CAST({float(q)!r} AS DOUBLE)"))


def log_parse(df: DataFrame, line_col: str = "line", drop_names: str | None = LOG_DROP_NAMES) -> DataFrame:
    """Parse syslog container lines into timestamp, container_id, container_name, body.

    A line that does not parse is passed on unparsed (body = the raw line,
    other fields null).  Entries whose container name matches ``drop_names``
    are dropped.
    """
    line = F.col(line_col)
    ok = line.rlike(LOG_LINE_RE)

    def grp(i):
        return F.when(ok, F.regexp_extract(line, LOG_LINE_RE, i))

    body = F.when(ok, F.regexp_extract(line, LOG_LINE_RE, 5)).otherwise(line)
    out = df.select(*[c for c in df.columns if c != line_col],
                    F.upper(grp(2)).try_cast("timestamp").alias("timestamp"),
                    grp(3).alias("container_id"), grp(4).alias("container_name"), body.alias("body"))
    if drop_names:
        out = out.filter(F.col("container_name").isNull() | ~F.col("container_name").rlike(drop_names))
    return out


def threshold_alert(df: DataFrame, value_col: str, threshold: float = ALERT_THRESHOLD,
                    severity: str = "warning") -> DataFrame:
    return (df.filter(F.col(value_col) > F.lit(threshold))
            .withColumn("severity", F.lit(severity)))

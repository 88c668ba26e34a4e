"""Registered queries: latency histograms, quantiles, log parsing, alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import telemetry as TL
from tidemark.plans.oracles import with_ctes
from tidemark.plans.registry import register
from tidemark.sources.testdata import read_table

BOUNDS_SQL = "[" + ", ".join(repr(float(b)) for b in TL.LATENCY_BOUNDS_MS) + ", 'inf'::DOUBLE]"
NB = len(TL.LATENCY_BOUNDS_MS) + 1
QUANTILE = 0.9


def _spans(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(F.col("l_shipdate").alias("ts"), F.col("l_returnflag").alias("operation"),
                     (F.col("l_extendedprice") / 100.0).alias("latency_ms"))


HIST_CTE = f"""spans AS (SELECT l_shipdate AS ts, l_returnflag AS operation, l_extendedprice / 100.0 AS latency_ms
          FROM lineitem),
hist AS (
  SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, operation, {BOUNDS_SQL} AS bounds,
         [{', '.join(f'CAST(count(*) FILTER (WHERE latency_ms <= {float(b)!r}) AS DOUBLE)' for b in TL.LATENCY_BOUNDS_MS)},
          CAST(count(latency_ms) AS DOUBLE)] AS counts,
         count(latency_ms) AS count, sum(latency_ms) AS sum
  FROM spans GROUP BY 1, 2)"""


@register("latency_histogram", with_ctes(
    "SELECT window_start, operation, bounds, counts, count, round(sum, 6) AS sum FROM hist", HIST_CTE))
def q_latency_histogram(spark, sf):
    return TL.latency_histogram(_spans(spark, sf), "ts", "latency_ms", ["operation"])


@register("histogram_quantile", with_ctes(f"""
, k AS (SELECT *, {QUANTILE} * counts[{NB}] AS rk,
               coalesce(list_min(list_filter(range(1, {NB}), lambda i: counts[i] >= {QUANTILE} * counts[{NB}])), {NB}) AS b
        FROM hist)
SELECT window_start, operation, round(CASE
    WHEN counts[{NB}] = 0 THEN 'nan'::DOUBLE
    WHEN b = {NB} THEN bounds[{NB - 1}]
    WHEN b = 1 AND bounds[1] <= 0 THEN bounds[1]
    ELSE (CASE WHEN b > 1 THEN bounds[b - 1] ELSE 0 END)
         + (bounds[b] - CASE WHEN b > 1 THEN bounds[b - 1] ELSE 0 END)
           * ((rk - CASE WHEN b > 1 THEN counts[b - 1] ELSE 0 END)
              / (counts[b] - CASE WHEN b > 1 THEN counts[b - 1] ELSE 0 END)) END, 6) AS quantile
FROM k""", HIST_CTE))
def q_histogram_quantile(spark, sf):
    h = TL.latency_histogram(_spans(spark, sf), "ts", "latency_ms", ["operation"])
    return TL.with_quantile(h, QUANTILE).select("window_start", "operation", "quantile")


def _log_lines(spark, sf):
    ev = read_table(spark, sf, "events")
    name = F.when(F.col("event_type") == "error", F.lit("signoz-query-service")) \
        .otherwise(F.concat(F.lit("shop-"), F.col("event_type")))
    cid = F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 12)
    good = F.concat_ws(" ", F.lit("<14>1"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), cid, name,
                       F.col("user_id").cast("string"), F.lit("- -"),
                       F.concat(F.lit("value="), F.col("value").cast("string")))
    broken = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), name, F.lit("crashed"))
    return ev.select("event_id", F.when(F.col("event_id") % 50 == 7, broken).otherwise(good).alias("line"))


LINES_CTE = """lines AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'signoz-query-service' ELSE 'shop-' || event_type END AS name,
         substr(sha256(CAST(user_id AS VARCHAR)), 1, 12) AS cid, ts, user_id, value
  FROM events)"""


@register("log_parse", with_ctes(r"""
SELECT event_id,
       CASE WHEN event_id % 50 = 7 THEN NULL ELSE date_trunc('millisecond', ts) END AS timestamp,
       CASE WHEN event_id % 50 = 7 THEN NULL ELSE cid END AS container_id,
       CASE WHEN event_id % 50 = 7 THEN NULL ELSE name END AS container_name,
       CASE WHEN event_id % 50 = 7 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || name || ' crashed'
            ELSE 'value=' || CAST(value AS VARCHAR) END AS body
FROM lines
WHERE event_id % 50 = 7
   OR NOT regexp_matches(name, '^signoz-(logspout|frontend|alertmanager|query-service|otel-collector|clickhouse|zookeeper)')
""", LINES_CTE))
def q_log_parse(spark, sf):
    return TL.log_parse(_log_lines(spark, sf), "line")


@register("threshold_alert", with_ctes("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       round(max(value) / 2000.0, 6) AS system_cpu_load_average_1m, 'warning' AS severity
FROM events GROUP BY 1 HAVING max(value) / 2000.0 > 0.1""", ""))
def q_threshold_alert(spark, sf):
    ev = read_table(spark, sf, "events")
    load = (ev.groupBy(F.window("ts", "1 hour").alias("w"))
            .agg((F.max("value") / 2000.0).alias("system_cpu_load_average_1m"))
            .select(F.col("w.start").alias("window_start"), "system_cpu_load_average_1m"))
    return TL.threshold_alert(load, "system_cpu_load_average_1m", TL.ALERT_THRESHOLD, "warning")

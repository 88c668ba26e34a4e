"""Registered queries: streaming-feature preprocessing, serving, labels, sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import features as FE
from tidemark.operators import validation as V
from tidemark.operators.envelope import envelope_decode
from tidemark.plans.oracles import WAREHOUSE, with_ctes
from tidemark.plans.q_validation import VERDICT_CTES, _verdicts
from tidemark.plans.registry import register
from tidemark.plans.warehouse import Gold
from tidemark.session import materialize
from tidemark.sources.testdata import behaviour_events

CLOCK = dt.datetime(2024, 2, 1, 0, 0, 0)
CLOCK_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
REQUEST_TS = dt.datetime(2024, 1, 31, 0, 0, 0)
REQUEST_TS_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
SNAPSHOT_END = "2024-01-20 00:00:00"
FEATURE_COLS_SQL = ", ".join(FE.FEATURE_COLUMNS)
SERVED_SQL = ", ".join(FE.SERVED_FEATURES)
NUMERIC_SERVED = ["activity_count", "event_weekday", "is_purchased"]

FEATURE_CTES = VERDICT_CTES + r""",
valid_rows AS (SELECT b.* FROM behaviour b JOIN verdict v USING (ingest_seq) WHERE v.valid = 'VALID'),
f_ts AS (
  SELECT * EXCLUDE (event_time),
         try_strptime(CASE WHEN contains(event_time, 'UTC') THEN regexp_replace(event_time, ' UTC$', '')
                           ELSE event_time END, '%Y-%m-%d %H:%M:%S') AS event_timestamp
  FROM valid_rows
),
f_cnt AS (
  SELECT *, count(*) OVER (PARTITION BY user_session) AS activity_count
  FROM f_ts WHERE event_timestamp IS NOT NULL
),
f_fill AS (
  SELECT * REPLACE (coalesce(price, 0.0) AS price, coalesce(brand, '') AS brand,
                    coalesce(category_code, '') AS category_code, coalesce(event_type, '') AS event_type)
  FROM f_cnt
),
f_cols AS (
  SELECT *,
         replace(CASE WHEN strpos(category_code, '.') > 0
                      THEN substr(category_code, 1, strpos(category_code, '.') - 1)
                      ELSE category_code END, 'null', '') AS category_code_level1,
         replace(CASE WHEN strpos(category_code, '.') > 0
                      THEN substr(category_code, strpos(category_code, '.') + 1) END, 'null', '')
           AS category_code_level2,
         CAST(dayofweek(event_timestamp) AS INTEGER) AS event_weekday,
         CASE WHEN lower(event_type) = 'purchase' THEN 1 ELSE 0 END AS is_purchased
  FROM f_fill
),
features AS (
  SELECT * FROM f_cols
  WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND price IS NOT NULL AND brand IS NOT NULL
    AND category_code_level1 IS NOT NULL AND category_code_level2 IS NOT NULL
    AND user_session IS NOT NULL AND trim(brand) <> '' AND trim(category_code_level1) <> ''
    AND trim(category_code_level2) <> '' AND trim(user_session) <> ''
    AND user_id > 0 AND product_id > 0 AND price >= 0 AND activity_count > 0
    AND event_weekday BETWEEN 0 AND 6
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, product_id
                                 ORDER BY event_timestamp DESC, ingest_seq DESC) AS rn FROM features)
  WHERE rn = 1
)"""


def _valid_rows(spark, sf):
    """Validated, decoded events: the boundary between the validation job and
    the feature job (a topic in production), materialised once."""
    ok = V.route(_verdicts(spark, sf, False), V.VALID)
    return materialize(envelope_decode(ok, keep=["ingest_seq"]))


def _stage_ts(spark, sf):
    return FE.with_event_timestamp(_valid_rows(spark, sf))


def _features(spark, sf):
    return FE.preprocess_batch(_valid_rows(spark, sf), keep=["ingest_seq"])


@register("parse_event_time", with_ctes("SELECT ingest_seq, event_timestamp FROM f_ts WHERE event_timestamp IS NOT NULL", FEATURE_CTES))
def q_parse_event_time(spark, sf):
    return _stage_ts(spark, sf).select("ingest_seq", "event_timestamp")


@register("activity_count", with_ctes("SELECT ingest_seq, user_session, activity_count FROM f_cnt", FEATURE_CTES))
def q_activity_count(spark, sf):
    return FE.session_counts(_stage_ts(spark, sf)).select("ingest_seq", "user_session", "activity_count")


def _cols(spark, sf):
    return FE.with_feature_columns(FE.session_counts(_stage_ts(spark, sf)))


@register("feature_categories", with_ctes(
    "SELECT ingest_seq, category_code, category_code_level1, category_code_level2 FROM f_cols", FEATURE_CTES))
def q_feature_categories(spark, sf):
    return _cols(spark, sf).select("ingest_seq", "category_code", "category_code_level1", "category_code_level2")


@register("event_weekday", with_ctes("SELECT ingest_seq, event_timestamp, event_weekday FROM f_cols", FEATURE_CTES))
def q_event_weekday(spark, sf):
    return _cols(spark, sf).select("ingest_seq", "event_timestamp", "event_weekday")


@register("is_purchased_flag", with_ctes("SELECT ingest_seq, event_type, is_purchased FROM f_cols", FEATURE_CTES))
def q_is_purchased_flag(spark, sf):
    return _cols(spark, sf).select("ingest_seq", "event_type", "is_purchased")


@register("feature_quality_filter", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM features", FEATURE_CTES))
def q_feature_quality_filter(spark, sf):
    return _features(spark, sf)


@register("offline_features", with_ctes(
    f"SELECT ingest_seq, {FEATURE_COLS_SQL}, {CLOCK_SQL} AS created_timestamp, CAST(0 AS BIGINT) AS batch_id FROM features",
    FEATURE_CTES))
def q_offline_features(spark, sf):
    return FE.offline_rows(_features(spark, sf), CLOCK, batch_id=0)


@register("latest_features", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM latest", FEATURE_CTES))
def q_latest_features(spark, sf):
    return FE.latest_per_key(_features(spark, sf))


def _requests(spark, sf):
    b = behaviour_events(spark, sf)
    return (b.filter(F.col("event_type") == "purchase").select("user_id", "product_id").distinct()
            .withColumn("request_ts", F.lit(REQUEST_TS).cast("timestamp")))


@register("feature_lookup", with_ctes(f"""
, req AS (SELECT DISTINCT user_id, product_id, {REQUEST_TS_SQL} AS request_ts FROM behaviour
          WHERE event_type = 'purchase')
SELECT r.user_id, r.product_id, r.request_ts,
       {', '.join(('CAST(l.' + c + ' AS DOUBLE) AS ' + c) if c in NUMERIC_SERVED else 'l.' + c
                  for c in FE.SERVED_FEATURES)}
FROM req r LEFT JOIN latest l ON r.user_id = l.user_id AND r.product_id = l.product_id
  AND l.event_timestamp >= r.request_ts - INTERVAL 1 DAY""", FEATURE_CTES))
def q_feature_lookup(spark, sf):
    """Served numeric features come back as doubles (missing keys are null),
    as the scoring side reads them."""
    out = FE.feature_lookup(_requests(spark, sf), FE.latest_per_key(_features(spark, sf)))
    return out.withColumns({c: F.col(c).cast("double") for c in NUMERIC_SERVED})


@register("materialise_incremental", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM latest", FEATURE_CTES))
def q_materialise_incremental(spark, sf):
    f = _features(spark, sf)
    cut = F.lit(SNAPSHOT_END).cast("timestamp")
    snapshot = FE.latest_per_key(f.filter(F.col("event_timestamp") <= cut))
    return FE.materialise_incremental(snapshot, f.filter(F.col("event_timestamp") > cut))


CART_SQL = """
SELECT {g}, count(*) FILTER (WHERE event_type = 'cart') AS cart_events,
       max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS is_purchased
FROM fact_events GROUP BY {g} HAVING count(*) FILTER (WHERE event_type = 'cart') > 0"""


@register("cart_purchase_label", with_ctes(CART_SQL.format(g="user_session, product_id"), WAREHOUSE))
def q_cart_purchase_label(spark, sf):
    return FE.cart_purchase_label(Gold(spark, sf).events, ["user_session", "product_id"])


@register("cart_purchase_label_user", with_ctes(CART_SQL.format(g="user_id, product_id"), WAREHOUSE))
def q_cart_purchase_label_user(spark, sf):
    return FE.cart_purchase_label(Gold(spark, sf).events, ["user_id", "product_id"])


@register("session_window_activity", with_ctes("""
, g AS (SELECT user_id, event_timestamp,
               sum(CASE WHEN event_timestamp - prev >= INTERVAL 24 HOUR THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY event_timestamp
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
        FROM (SELECT user_id, event_timestamp,
                     lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp) AS prev
              FROM fact_events))
SELECT user_id, min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 24 HOUR AS session_end,
       count(*) AS event_count, min(event_timestamp) AS first_event, max(event_timestamp) AS last_event
FROM g GROUP BY user_id, sid""", WAREHOUSE))
def q_session_window_activity(spark, sf):
    return FE.session_window_activity(Gold(spark, sf).events, "user_id", "event_timestamp", "24 hours")

"""Registered queries: record validation, routing, alerts, CDC."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark.operators import cdc as C
from tidemark.operators import validation as V
from tidemark.operators.envelope import envelope_decode, envelope_encode
from tidemark.operators.telemetry import rate_counters
from tidemark.plans.oracles import ADAPTED, with_ctes
from tidemark.plans.registry import register
from tidemark.sources.testdata import (EVENT_FIELDS, EVENT_SCHEMA_JSON, behaviour_events, cdc_changes,
                                       raw_envelopes)

CLOCK = dt.datetime(2024, 2, 1, 0, 0, 0)
CLOCK_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
# Schemas that the topics are declared with.
KNOWN_SCHEMAS = [EVENT_SCHEMA_JSON, C.CDC_SCHEMA_JSON]
EVENT_SCHEMA_FIELDS = json.loads(EVENT_SCHEMA_JSON)["fields"]

VERDICT_CTES = ADAPTED + r""",
env AS (SELECT ingest_seq, event_id, event_id % 100 AS m, event_type, price FROM behaviour),
verdict AS (
  SELECT ingest_seq, event_id, msg,
         CASE WHEN msg IS NULL THEN 'VALID' ELSE 'INVALID' END AS valid,
         CASE WHEN m = 41 THEN 'PROCESSING_ERROR'
              WHEN msg IS NOT NULL THEN 'SCHEMA_VALIDATION_ERROR' END AS error_type
  FROM (SELECT *, CASE
          WHEN m = 41 THEN 'Processing error: malformed JSON'
          WHEN event_type NOT IN ('view', 'cart', 'purchase', 'remove_from_cart')
            THEN 'Event type should be one of: view, cart, purchase, remove_from_cart'
          WHEN m = 29 THEN 'Field product_id has invalid type'
          WHEN m = 83 THEN 'Field category_id has invalid type'
          WHEN m = 71 THEN 'Field category_code is required'
          WHEN price <= 0 THEN 'Price should be greater than 0'
          WHEN m = 53 THEN 'Field user_id has invalid type'
          WHEN m = 17 THEN 'Field user_session is required' END AS msg FROM env)
)"""

VERDICT_SQL = with_ctes(f"""
SELECT ingest_seq, valid, error_type, msg AS error_message,
       CASE WHEN valid = 'VALID' OR error_type = 'PROCESSING_ERROR' THEN {CLOCK_SQL} END AS processed_at
FROM verdict""", VERDICT_CTES)


def _verdicts(spark, sf, static=True):
    env = raw_envelopes(spark, sf)
    if static:
        return V.validate_static(env, EVENT_SCHEMA_FIELDS, keep=["ingest_seq", "value"], clock=CLOCK)
    return V.validate_dynamic(env, keep=["ingest_seq", "value"], clock=CLOCK, known=KNOWN_SCHEMAS)


@register("validate_schema_static", VERDICT_SQL)
def q_validate_static(spark, sf):
    return _verdicts(spark, sf, True).drop("value")


@register("validate_schema_dynamic", VERDICT_SQL)
def q_validate_dynamic(spark, sf):
    return _verdicts(spark, sf, False).drop("value")


@register("validation_summary", with_ctes("""
SELECT valid, error_type, msg AS error_message, count(*) AS n FROM verdict GROUP BY 1, 2, 3""",
                                          VERDICT_CTES))
def q_validation_summary(spark, sf):
    return V.validation_summary(_verdicts(spark, sf, False))


@register("route_valid", with_ctes(f"""
SELECT b.ingest_seq, {', '.join('b.' + c for c in EVENT_FIELDS)}
FROM behaviour b JOIN verdict v USING (ingest_seq) WHERE v.valid = 'VALID'""", VERDICT_CTES))
def q_route_valid(spark, sf):
    ok = V.route(_verdicts(spark, sf, False), V.VALID)
    return envelope_decode(ok, keep=["ingest_seq"])


@register("route_invalid", with_ctes("""
SELECT ingest_seq, error_type, msg AS error_message FROM verdict WHERE valid = 'INVALID'""",
                                     VERDICT_CTES))
def q_route_invalid(spark, sf):
    return V.route(_verdicts(spark, sf, False), V.INVALID).select("ingest_seq", "error_type",
                                                                 "error_message")


@register("invalid_alerts", with_ctes("""
SELECT ingest_seq, error_type, msg AS error_message,
       CASE WHEN contains(lower(error_type), 'schema') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CAST(NULL AS VARCHAR) AS raw_event
FROM verdict WHERE valid = 'INVALID'""", VERDICT_CTES))
def q_invalid_alerts(spark, sf):
    bad = V.invalid_record_json(V.route(_verdicts(spark, sf, False), V.INVALID))
    return V.invalid_alerts(bad.select("ingest_seq", F.col("invalid_json").alias("value")))


@register("validation_rate_1s", with_ctes("""
SELECT time_bucket(INTERVAL 1 SECOND, CAST(strptime(replace(b.event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS window_start,
       count(*) FILTER (WHERE v.valid = 'VALID') AS success_count,
       count(*) FILTER (WHERE v.valid = 'INVALID') AS failure_count
FROM behaviour b JOIN verdict v USING (ingest_seq) GROUP BY 1""", VERDICT_CTES))
def q_validation_rate_1s(spark, sf):
    # event_time rides along through the validation: one scan, no join back
    env = raw_envelopes(spark, sf, keep=["event_time"])
    verdicts = V.validate_dynamic(env, keep=["event_time"], clock=CLOCK, known=KNOWN_SCHEMAS)
    return rate_counters(verdicts, "event_time", "valid")


CDC_CTES = ADAPTED + r""",
base AS (SELECT * FROM adapted),
changes AS (
  SELECT ingest_seq * 4 AS ingest_seq, event_id, 'c' AS op, 0.0 AS d, * EXCLUDE (ingest_seq, event_id) FROM base
  UNION ALL
  SELECT ingest_seq * 4 + 1, event_id, 'u', 1.0, * EXCLUDE (ingest_seq, event_id) FROM base WHERE event_id % 9 = 4
),
unwrapped AS (
  SELECT ingest_seq, event_id, op,
         CASE WHEN event_id % 2 = 0
              THEN CAST(epoch_us(strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S')) AS VARCHAR)
              ELSE event_time END AS event_time,
         event_type, product_id, category_id, category_code, brand, price + d AS price, user_id, user_session
  FROM changes
)"""


@register("cdc_unwrap", with_ctes("SELECT * FROM unwrapped", CDC_CTES))
def q_cdc_unwrap(spark, sf):
    return C.cdc_unwrap(cdc_changes(spark, sf))


@register("cdc_normalise", with_ctes("""
SELECT ingest_seq, event_id, op,
       CASE WHEN regexp_full_match(event_time, '\\d+') THEN make_timestamp(CAST(event_time AS BIGINT))
            ELSE try_strptime(regexp_replace(event_time, ' UTC$', ''), '%Y-%m-%d %H:%M:%S') END AS event_time,
       event_type, product_id, category_id, category_code, brand, greatest(price, 0.0) AS price,
       user_id, user_session
FROM unwrapped""", CDC_CTES))
def q_cdc_normalise(spark, sf):
    return C.cdc_normalise(C.cdc_unwrap(cdc_changes(spark, sf)))


@register("union_sources", with_ctes(r"""
, raw AS (SELECT 'events.raw' AS topic, ingest_seq, valid, msg AS error_message FROM verdict),
cdc AS (SELECT 'events.cdc' AS topic, ingest_seq, valid, msg AS error_message FROM (
   SELECT ingest_seq, CASE WHEN msg IS NULL THEN 'VALID' ELSE 'INVALID' END AS valid, msg FROM (
     SELECT ingest_seq, CASE
       WHEN event_type NOT IN ('view', 'cart', 'purchase', 'remove_from_cart')
         THEN 'Event type should be one of: view, cart, purchase, remove_from_cart'
       WHEN greatest(price, 0.0) <= 0 THEN 'Price should be greater than 0' END AS msg
     FROM unwrapped)))
SELECT * FROM raw UNION ALL SELECT * FROM cdc""", VERDICT_CTES + CDC_CTES.replace(ADAPTED, "", 1)))
def q_union_sources(spark, sf):
    raw = raw_envelopes(spark, sf).select(F.lit("events.raw").alias("topic"), "ingest_seq", "value")
    cdc = C.cdc_envelope(C.cdc_normalise(C.cdc_unwrap(cdc_changes(spark, sf))),
                         keep=[F.lit("events.cdc").alias("topic"), "ingest_seq"])
    both = raw.unionByName(cdc)
    return V.validate_dynamic(both, keep=["topic", "ingest_seq"], clock=CLOCK, known=KNOWN_SCHEMAS).select(
        "topic", "ingest_seq", "valid", "error_message")


ENVELOPE_SQL = with_ctes("""
SELECT ingest_seq, '{"schema":' || '""" + EVENT_SCHEMA_JSON + """' || ',"payload":' ||
       CAST(to_json(struct_pack(event_time := event_time, event_type := event_type, product_id := product_id,
            category_id := category_id, category_code := category_code, brand := brand, price := price,
            user_id := user_id, user_session := user_session)) AS VARCHAR) || '}' AS value
FROM behaviour""", ADAPTED)


@register("envelope_encode", ENVELOPE_SQL)
def q_envelope_encode(spark, sf):
    """Envelope text: declared schema + compact payload JSON with nulls kept."""
    return envelope_encode(behaviour_events(spark, sf), keep=["ingest_seq"])

"""Registered queries: sources, bronze, silver, gold, quality."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.operators import bronze as B
from tidemark.operators import distinct as D
from tidemark.operators import gold as G
from tidemark.operators import keys as K
from tidemark.operators import quality as Q
from tidemark.operators import silver as S
from tidemark.operators import sinks
from tidemark.operators.envelope import envelope_decode, envelope_encode
from tidemark.plans.oracles import r6, with_ctes
from tidemark.plans.registry import register
from tidemark.plans.warehouse import Gold, bronze_input, clean_rows, silver_rows
from tidemark.session import materialize, scratch_path
from tidemark.sources.testdata import EVENT_FIELDS, behaviour_events, raw_envelopes

# Fixed clock for enrichment so results are reproducible.
ENRICH_CLOCK = dt.datetime(2024, 2, 1, 0, 0, 0)
ENRICH_CLOCK_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
# Incremental-load split: rows up to this date were loaded by an earlier run.
FIRST_RUN_LAST_DATE = "2024-01-15"

DOMAIN = ["ingest_seq"] + EVENT_FIELDS
DOMAIN_SQL = ", ".join(DOMAIN)


@register("scan_events", with_ctes(f"SELECT event_id, {DOMAIN_SQL} FROM behaviour"))
def scan_events(spark, sf):
    return behaviour_events(spark, sf).select("event_id", *DOMAIN)


@register("envelope_decode", with_ctes(f"SELECT {DOMAIN_SQL} FROM behaviour"))
def q_envelope_decode(spark, sf):
    enc = envelope_encode(behaviour_events(spark, sf), keep=["ingest_seq"])
    return envelope_decode(enc, keep=["ingest_seq"])


@register("record_hash", with_ctes("SELECT ingest_seq, record_hash FROM bronze_in"))
def q_record_hash(spark, sf):
    return bronze_input(spark, sf).select("ingest_seq", "record_hash")


@register("record_hash_raw", with_ctes("""
SELECT ingest_seq,
       CASE WHEN event_id % 100 <> 41 THEN
         sha256(CAST(product_id AS VARCHAR) || '|' || event_time || '|' ||
                CASE WHEN event_id % 100 = 53 THEN 'None' ELSE CAST(user_id AS VARCHAR) END) END AS record_hash,
       event_id % 100 = 41 AS unparsable
FROM behaviour"""))
def q_record_hash_raw(spark, sf):
    """Record hash computed from the raw record text (lake/bronze input): the
    payload is parsed once; an unparsable text is kept and marked."""
    checked = B.bronze_from_text(raw_envelopes(spark, sf).select("ingest_seq", "value"))
    return checked.select("ingest_seq", "record_hash",
                          F.coalesce(F.col("error") == B.UNPARSABLE, F.lit(False)).alias("unparsable"))


@register("bronze_validate", with_ctes("SELECT ingest_seq, record_hash, error FROM bronze_v"))
def q_bronze_validate(spark, sf):
    return B.bronze_validate(bronze_input(spark, sf)).select("ingest_seq", "record_hash", "error")


@register("bronze_valid", with_ctes(f"SELECT record_hash, {DOMAIN_SQL} FROM bronze_valid"))
def q_bronze_valid(spark, sf):
    return B.bronze_valid(bronze_input(spark, sf)).select("record_hash", *DOMAIN)


@register("bronze_errors", with_ctes("SELECT ingest_seq, record_hash, error FROM bronze_v WHERE error IS NOT NULL"))
def q_bronze_errors(spark, sf):
    return B.bronze_errors(bronze_input(spark, sf)).select("ingest_seq", "record_hash", "error")


@register("bronze_metrics", with_ctes("""
SELECT coalesce(error, 'VALID') AS status, count(*) AS n FROM bronze_v GROUP BY 1
UNION ALL SELECT 'TOTAL' AS status, count(*) AS n FROM bronze_v"""))
def q_bronze_metrics(spark, sf):
    return B.bronze_metrics(bronze_input(spark, sf))


@register("bronze_enrich", with_ctes(f"""
SELECT ingest_seq, record_hash, {ENRICH_CLOCK_SQL} AS processed_date,
       'minio_etl' AS processing_pipeline, 'TRUE' AS valid FROM bronze_valid"""))
def q_bronze_enrich(spark, sf):
    e = B.bronze_enrich(B.bronze_valid(bronze_input(spark, sf)), ENRICH_CLOCK)
    return e.select("ingest_seq", "record_hash", "processed_date", "processing_pipeline", "valid")


@register("bronze_flatten", with_ctes(f"""
SELECT record_hash, {ENRICH_CLOCK_SQL} AS processed_date, 'minio_etl' AS processing_pipeline,
       'TRUE' AS valid, {DOMAIN_SQL} FROM bronze_valid"""))
def q_bronze_flatten(spark, sf):
    v = B.bronze_valid(bronze_input(spark, sf))
    nested = B.bronze_enrich(v.select("record_hash", F.struct(*DOMAIN).alias("payload")), ENRICH_CLOCK)
    return B.bronze_flatten(nested)


@register("dedup_first", with_ctes(
    "SELECT ingest_seq, record_hash, event_time, product_id, user_id, event_type FROM dedup"))
def q_dedup_first(spark, sf):
    # the aggregate carries whole rows, so columns are chosen before it
    slim = B.bronze_valid(bronze_input(spark, sf)).select(
        "ingest_seq", "record_hash", "event_time", "product_id", "user_id", "event_type")
    return S.dedup_first(slim)


@register("duplicate_count", with_ctes("""
SELECT count(*) AS total_records, count(DISTINCT record_hash) AS distinct_records,
       count(*) - count(DISTINCT record_hash) AS duplicate_count FROM bronze_valid"""))
def q_duplicate_count(spark, sf):
    return S.duplicate_count(B.bronze_valid(bronze_input(spark, sf)))


@register("silver_time", with_ctes(
    "SELECT ingest_seq, event_timestamp, CAST(event_date AS VARCHAR) AS event_date, event_hour, day_of_week FROM stime"))
def q_silver_time(spark, sf):
    d = S.silver_time(S.dedup_first(B.bronze_valid(bronze_input(spark, sf))))
    return d.select("ingest_seq", "event_timestamp", "event_date", "event_hour", "day_of_week")


@register("price_tier", with_ctes("SELECT ingest_seq, price, price_tier FROM derived"))
def q_price_tier(spark, sf):
    return clean_rows(spark, sf).select("ingest_seq", "price", "price_tier")


@register("category_levels", with_ctes(
    "SELECT ingest_seq, category_code, category_l1, category_l2, category_l3 FROM derived"))
def q_category_levels(spark, sf):
    return clean_rows(spark, sf).select("ingest_seq", "category_code", "category_l1", "category_l2",
                                         "category_l3")


@register("session_metrics", with_ctes("""
SELECT user_session, events_in_session, session_start, session_end,
       round(avg_price, 6) AS avg_price, min_price, max_price FROM sessions"""))
def q_session_metrics(spark, sf):
    return S.session_metrics(clean_rows(spark, sf))


@register("silver_session_metrics", with_ctes("""
SELECT ingest_seq, user_session, events_in_session, session_start, session_end,
       round(avg_price, 6) AS avg_price, min_price, max_price FROM silver"""))
def q_silver_session_metrics(spark, sf):
    return silver_rows(spark, sf).select("ingest_seq", "user_session", "events_in_session",
                                         "session_start", "session_end", "avg_price", "min_price",
                                         "max_price")


@register("silver_serialise", with_ctes("""
SELECT ingest_seq, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       CAST(event_date AS VARCHAR) AS event_date,
       strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end FROM silver"""))
def q_silver_serialise(spark, sf):
    return S.silver_serialise(silver_rows(spark, sf)).select(
        "ingest_seq", "event_timestamp", "event_date", "session_start", "session_end")


@register("transform_metrics", with_ctes(f"""
SELECT count(*) AS total_records, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT user_session) AS unique_sessions,
       {r6('avg(events_in_session)', 'avg_events_per_session')} FROM silver"""))
def q_transform_metrics(spark, sf):
    return S.transform_metrics(silver_rows(spark, sf))


@register("price_tier_distribution", with_ctes(
    "SELECT price_tier, count(*) AS n FROM silver GROUP BY price_tier"))
def q_price_tier_distribution(spark, sf):
    return S.price_tier_distribution(clean_rows(spark, sf))


@register("dim_user", with_ctes("SELECT user_id FROM dim_user"))
def q_dim_user(spark, sf):
    return Gold(spark, sf).dim_user


@register("dim_product", with_ctes("SELECT product_id, brand, CAST(price AS DOUBLE) AS price, price_tier FROM dim_product"))
def q_dim_product(spark, sf):
    return Gold(spark, sf).dim_product


@register("dim_category", with_ctes(
    "SELECT category_id, category_code, category_l1, category_l2, category_l3 FROM dim_category"))
def q_dim_category(spark, sf):
    return Gold(spark, sf).dim_category


@register("dim_date", with_ctes("SELECT CAST(event_date AS VARCHAR) AS event_date, event_hour, day_of_week FROM dim_date"))
def q_dim_date(spark, sf):
    return Gold(spark, sf).dim_date


@register("fact_events", with_ctes("SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM fact_events"))
def q_fact_events(spark, sf):
    return Gold(spark, sf).fact


@register("fk_orphans", with_ctes("""
SELECT 'dim_user' AS dimension, count(*) AS orphans FROM fact_events f
  WHERE NOT EXISTS (SELECT 1 FROM dim_user d WHERE d.user_id = f.user_id)
UNION ALL SELECT 'dim_product', count(*) FROM fact_events f
  WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_id = f.product_id)
UNION ALL SELECT 'dim_category', count(*) FROM fact_events f
  WHERE NOT EXISTS (SELECT 1 FROM dim_category d WHERE d.category_id = f.category_id)
UNION ALL SELECT 'dim_date', count(*) FROM fact_events f
  WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.event_date = f.event_date)"""))
def q_fk_orphans(spark, sf):
    g = Gold(spark, sf)
    return G.fk_orphans(g.events, {"dim_user": (g.dim_user, "user_id"),
                                 "dim_product": (g.dim_product, "product_id"),
                                 "dim_category": (g.dim_category, "category_id"),
                                 "dim_date": (g.dim_date, "event_date")})


@register("insert_if_absent", with_ctes(f"""
SELECT ingest_seq, record_hash, CAST(event_date AS VARCHAR) AS event_date FROM silver n
WHERE NOT EXISTS (SELECT 1 FROM silver o WHERE o.event_date <= DATE '{FIRST_RUN_LAST_DATE}'
                  AND o.record_hash = n.record_hash)"""))
def q_insert_if_absent(spark, sf):
    s = clean_rows(spark, sf).select("ingest_seq", "record_hash", "event_date")
    existing = s.filter(F.col("event_date") <= F.lit(FIRST_RUN_LAST_DATE).cast("date"))
    return G.insert_if_absent(s, existing, ["record_hash"])


@register("vw_user_session_summary", with_ctes("""
, known AS (
  SELECT * FROM fact_events
  WHERE user_id IN (SELECT user_id FROM dim_user)
    AND event_date IN (SELECT event_date FROM dim_date)
    AND product_id IN (SELECT product_id FROM dim_product))
SELECT user_id, user_session, count(*) AS event_count, min(event_timestamp) AS session_start,
       max(event_timestamp) AS session_end, count(DISTINCT product_id) AS unique_products_viewed
FROM known GROUP BY ALL"""))
def q_vw_user_session_summary(spark, sf):
    return Gold(spark, sf).vw_user_session_summary()


VW_CATEGORY_PERFORMANCE_SQL = with_ctes(f"""
, priced AS (
  SELECT user_id, (SELECT any_value(p.price) FROM dim_product p WHERE p.product_id = e.product_id) AS price, category_id
  FROM fact_events e
  WHERE user_id IN (SELECT user_id FROM dim_user) AND product_id IN (SELECT product_id FROM dim_product))
SELECT category_l1, category_l2, category_l3, count(*) AS view_count, count(DISTINCT user_id) AS unique_users,
       {r6('avg(CAST(price AS DOUBLE))', 'avg_price')}
FROM dim_category JOIN priced USING (category_id) GROUP BY ALL""")


@register("vw_category_performance", VW_CATEGORY_PERFORMANCE_SQL)
def q_vw_category_performance(spark, sf):
    return Gold(spark, sf).vw_category_performance()


@register("fact_keys", with_ctes(f"""
SELECT event_id, row_number() OVER (ORDER BY event_date > DATE '{FIRST_RUN_LAST_DATE}', event_id) AS event_key FROM fact_events"""))
def q_fact_keys(spark, sf):
    """Two loads, the second made twice: generated keys, gapless over both; the
    rows of the first keep theirs."""
    fact = materialize(Gold(spark, sf).events)
    path = scratch_path(spark, f"keys-{uuid.uuid4().hex[:12]}")
    first = F.col("event_date") <= F.lit(FIRST_RUN_LAST_DATE).cast("date")
    for version, part in ((0, first), (1, ~first), (1, ~first)):
        K.load_with_keys(fact.filter(part).select("event_id", "event_type"), path, version, ["event_id"], "event_key")
    return K.keyed_rows(spark, path).select("event_id", "event_key")


@register("distinct_counts", with_ctes("SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT user_session) AS user_session FROM fact_events"))
def q_distinct_counts(spark, sf):
    """Distinct users and sessions after two runs, the second made twice, from bitmaps."""
    fact = Gold(spark, sf).events
    path = scratch_path(spark, f"distinct-{uuid.uuid4().hex[:12]}")
    first = F.col("event_date") <= F.lit(FIRST_RUN_LAST_DATE).cast("date")
    for version, part in ((0, first), (1, ~first), (1, ~first)):
        D.add_run(fact.filter(part), path, version, ["user_id", "user_session"])
    return D.distinct_counts(spark, path, ["user_id", "user_session"])


@register("catalog_view", VW_CATEGORY_PERFORMANCE_SQL)
def q_catalog_view(spark, sf):
    """``vw_category_performance`` by name, in a second session."""
    run = uuid.uuid4().hex[:12]
    g, database = Gold(spark, sf), f"gold_{run}"
    sinks.publish_tables(spark, database, {"fact_events": g.events, "dim_user": g.dim_user, "dim_product": g.dim_product,
                                           "dim_category": g.dim_category, "dim_date": g.dim_date}, scratch_path(spark, f"gold-{run}"))
    sinks.publish_views(spark, database)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return other.table(f"{database}.vw_category_performance")


@register("expect_row_count", with_ctes("""
SELECT 'raw_data_suite' AS expectation, count(*) AS observed,
       count(*) BETWEEN 0 AND 1000000 AS success FROM bronze_in
UNION ALL
SELECT 'gold_layer_suite', count(*), count(*) BETWEEN 1 AND 1000000 FROM fact_events"""))
def q_expect_row_count(spark, sf):
    raw = Q.expect_row_count(bronze_input(spark, sf), "raw_data_suite", *Q.RAW_ROW_BOUNDS)
    gold = Q.expect_row_count(Gold(spark, sf).events, "gold_layer_suite", *Q.GOLD_ROW_BOUNDS)
    return raw.unionByName(gold)


def _run_metrics(spark, sf):
    v = B.bronze_validate(bronze_input(spark, sf))
    return v.agg(F.count(F.lit(1)).alias("total_records"),
                 F.count_if(F.col("error").isNull()).alias("valid_records"),
                 F.count_if(F.col("error").isNotNull()).alias("invalid_records"),
                 (F.count_if(F.col("error").isNull())
                  - F.count_distinct(F.when(F.col("error").isNull(), F.col("record_hash"))))
                 .alias("duplicate_records"),
                 F.lit(0.0).alias("processing_time"))


@register("pipeline_alerts", with_ctes("""
, m AS (SELECT count(*) AS total_records, count(*) FILTER (WHERE error IS NULL) AS valid_records,
          count(*) FILTER (WHERE error IS NOT NULL) AS invalid_records,
          count(*) FILTER (WHERE error IS NULL)
            - count(DISTINCT CASE WHEN error IS NULL THEN record_hash END) AS duplicate_records,
          0.0 AS processing_time FROM bronze_v)
SELECT * FROM (
  SELECT 0 AS rule_no, 'High number of invalid records detected!' AS alert FROM m WHERE invalid_records > valid_records
  UNION ALL SELECT 1, 'High number of duplicate records detected!' FROM m WHERE duplicate_records > 100
  UNION ALL SELECT 2, 'Low data volume detected!' FROM m WHERE total_records < 100
  UNION ALL SELECT 3, 'Unusually high data volume detected!' FROM m WHERE total_records > 1000000
  UNION ALL SELECT 4, 'Long processing time detected!' FROM m WHERE processing_time > 3600)"""
    .replace("\n, m AS", ", m AS", 1)))
def q_pipeline_alerts(spark, sf):
    return Q.pipeline_alerts(_run_metrics(spark, sf))


@register("null_profile", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM behaviour"
    for c in ["ingest_seq", "event_id"] + EVENT_FIELDS)))
def q_null_profile(spark, sf):
    return Q.null_profile(behaviour_events(spark, sf).select("ingest_seq", "event_id", *EVENT_FIELDS))


@register("head_n", with_ctes(f"SELECT {DOMAIN_SQL} FROM behaviour ORDER BY ingest_seq LIMIT 20"))
def q_head_n(spark, sf):
    return Q.head_n(behaviour_events(spark, sf).select(*DOMAIN), "ingest_seq", 20)

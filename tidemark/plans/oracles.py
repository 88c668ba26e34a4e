"""Independent DuckDB SQL for every SQL-expressible registered query.

The CTE chain below re-derives the behaviour-event adapter and each pipeline
stage in plain SQL (row_number for first-wins, group-by for sessions), so the
Spark plans are checked against a separate formulation, not a translation.
"""

from __future__ import annotations

ADAPTED = r"""
ev_k AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k FROM events e
),
adapted AS (
  SELECT e.event_id * 2 AS ingest_seq, e.event_id,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
         CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
              ELSE e.event_type END AS event_type,
         e.k + 1 AS product_id,
         1000 + e.k % 6 AS category_id,
         CASE WHEN e.k % 11 = 0 THEN NULL
              WHEN e.k % 13 = 0 THEN lower(p.p_type)
              ELSE lower(p.p_type) || '.' || replace(p.p_name, ' ', '.') END AS category_code,
         CASE WHEN e.k % 7 = 0 THEN NULL ELSE p.p_brand END AS brand,
         CASE WHEN e.event_id % 10 = 0 THEN -100.0 ELSE round(e.value * 3, 2) END AS price,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d') AS user_session
  FROM ev_k e LEFT JOIN part p ON p.p_partkey = e.k
),
behaviour AS (
  SELECT * FROM adapted
  UNION ALL
  SELECT ingest_seq + 1 AS ingest_seq, event_id, event_time, event_type, product_id, category_id,
         category_code, brand, price, user_id, user_session
  FROM adapted WHERE event_id % 20 = 3
)"""

WAREHOUSE = ADAPTED + r""",
bronze_in AS (
  SELECT *, sha256(coalesce(CAST(product_id AS VARCHAR), 'None') || '|' ||
                   coalesce(event_time, 'None') || '|' ||
                   coalesce(CAST(user_id AS VARCHAR), 'None')) AS record_hash
  FROM behaviour
),
bronze_v AS (
  SELECT *, CASE WHEN event_time IS NULL OR event_time = '' THEN 'Missing event_time'
                 WHEN event_type IS NULL OR event_type = '' THEN 'Missing event_type'
                 WHEN product_id IS NULL OR product_id = 0 THEN 'Missing product_id'
                 WHEN user_id IS NULL OR user_id = 0 THEN 'Missing user_id' END AS error
  FROM bronze_in
),
bronze_valid AS (SELECT * EXCLUDE (error) FROM bronze_v WHERE error IS NULL),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY record_hash ORDER BY ingest_seq) AS rn
    FROM bronze_valid) WHERE rn = 1
),
stime AS (
  SELECT *, CAST(event_timestamp AS DATE) AS event_date,
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
         dayname(event_timestamp) AS day_of_week
  FROM (SELECT *, try_strptime(CASE WHEN event_time LIKE '%UTC%'
                                    THEN regexp_replace(event_time, ' UTC$', '')
                                    ELSE event_time END, '%Y-%m-%d %H:%M:%S') AS event_timestamp
        FROM dedup)
),
derived AS (
  SELECT *, CASE WHEN price < 50 THEN 'low' WHEN price < 250 THEN 'medium'
                 WHEN price < 1000 THEN 'high' ELSE 'luxury' END AS price_tier,
         string_split(category_code, '.')[1] AS category_l1,
         string_split(category_code, '.')[2] AS category_l2,
         string_split(category_code, '.')[3] AS category_l3
  FROM stime
),
sessions AS (
  SELECT user_session, count(event_timestamp) AS events_in_session,
         min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
         avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price
  FROM derived WHERE user_session IS NOT NULL GROUP BY user_session
),
silver AS (
  SELECT d.*, s.* EXCLUDE (user_session) FROM derived d LEFT JOIN sessions s USING (user_session)
),
dim_user AS (SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id FROM silver),
dim_product AS (
  SELECT product_id, brand, CAST(price AS DECIMAL(10,2)) AS price, price_tier FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ingest_seq) AS rn FROM silver)
  WHERE rn = 1
),
dim_category AS (
  SELECT category_id, category_code, category_l1, category_l2, category_l3 FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY ingest_seq) AS rn FROM silver)
  WHERE rn = 1
),
dim_date AS (
  SELECT event_date, event_hour, day_of_week FROM (
    SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY ingest_seq) AS rn FROM silver)
  WHERE rn = 1
),
fact_events AS (
  SELECT ingest_seq AS event_id, event_type, CAST(user_id AS BIGINT) AS user_id,
         CAST(product_id AS BIGINT) AS product_id, CAST(category_id AS BIGINT) AS category_id,
         event_date, event_timestamp, user_session, CAST(events_in_session AS BIGINT) AS events_in_session
  FROM silver
)"""


def with_ctes(body: str, ctes: str = WAREHOUSE) -> str:
    if not ctes.strip():
        return body.strip()
    return "WITH " + ctes.strip() + "\n" + body.strip()


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"

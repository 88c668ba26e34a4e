"""Registered queries: data-lake layout and scans, streaming jobs run to completion.

These write intermediate files under the shared checkpoint folder
(``spark.checkpoint.dir``), each run in a fresh sub-folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.columns import parse_event_time
from tidemark.operators import features as FE
from tidemark.operators.bronze import bronze_from_text, bronze_valid
from tidemark.operators.envelope import ENVELOPE_STRUCT, envelope_decode
from tidemark.plans.oracles import with_ctes
from tidemark.plans.q_features import FEATURE_COLS_SQL, FEATURE_CTES, _features
from tidemark.plans.q_validation import VERDICT_CTES
from tidemark.plans.registry import register
from tidemark.plans.warehouse import bronze_input
from tidemark.session import materialize, scratch_path
from tidemark.sources import lake as L
from tidemark.sources.testdata import EVENT_FIELDS, behaviour_events, raw_envelopes
from tidemark.streaming import jobs as J

LAKE_SPLIT_DATE = "2024-01-16"


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("lake_partition_layout", with_ctes("""
, t AS (SELECT strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') AS ts FROM behaviour)
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM t GROUP BY 1, 2, 3, 4""", VERDICT_CTES))
def q_lake_partition_layout(spark, sf):
    path = _fresh(spark, "lake")
    ev = behaviour_events(spark, sf).withColumn("ts", parse_event_time("event_time"))
    L.write_lake(ev.select("ts", *EVENT_FIELDS), path, "ts")
    back = spark.read.json(path)   # partition discovery: year/month/day/hour
    return back.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def _envelope_lake(spark, sf):
    """Raw record texts (JSON lines, some truncated) written as the lake."""
    path = _fresh(spark, "rawlake")
    env = raw_envelopes(spark, sf)
    env.select("value").write.text(path)
    return path


NULLABLE_IDS = ["product_id", "category_id", "user_id"]


def _nulled(col: str, faults: str) -> str:
    val = f"CAST({col} AS DOUBLE)" if col in NULLABLE_IDS else col
    return f"CASE WHEN m IN ({faults}) THEN NULL ELSE {val} END AS {col}"


# Spark's PERMISSIVE JSON reader keeps partial results: a field that fails its
# type (text or 7.0 for a long) is null and the record is flagged corrupt; a
# truncated record is all null; absent keys and JSON nulls are just null.
LAKE_SCAN_SQL = with_ctes(f"""
, f AS (SELECT *, event_id % 100 AS m FROM behaviour)
SELECT {_nulled('event_time', '41')}, {_nulled('event_type', '41')}, {_nulled('product_id', '41, 29')},
       {_nulled('category_id', '41, 83')}, {_nulled('category_code', '41, 71')}, {_nulled('brand', '41')},
       {_nulled('price', '41')}, {_nulled('user_id', '41, 53')}, {_nulled('user_session', '41, 17')},
       m IN (41, 29, 83) AS is_corrupt
FROM f""", VERDICT_CTES)


@register("lake_json_scan", LAKE_SCAN_SQL)
def q_lake_json_scan(spark, sf):
    """Explicit-schema JSON scan of the raw record texts; unparsable or mistyped
    records are flagged via _corrupt_record."""
    path = _envelope_lake(spark, sf)
    # parsed once and saved, so any projection of the result (including one
    # that only reads the corrupt-record flag) is valid
    scan = materialize(L.lake_json_scan(spark, path, ENVELOPE_STRUCT))
    out = scan.select("payload.*", F.col(L.CORRUPT).isNotNull().alias("is_corrupt"))
    # ids nulled by mistyped records are shown as doubles, so every client
    # conversion (row objects or pandas) sees the same values
    return out.withColumns({c: F.col(c).cast("double") for c in NULLABLE_IDS})


DAY_SQL = "strftime(strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d')"
# One file a day, and one empty file; as in the JSON scan above, records of
# three kinds do not parse.
STATS_CTES = VERDICT_CTES + f""",
files AS (
  SELECT {DAY_SQL} AS day, count(*) AS records,
         count(*) FILTER (WHERE event_id % 100 IN (41, 29, 83)) AS error_records
  FROM behaviour GROUP BY 1
  UNION ALL SELECT 'empty', 0, 0),
stats AS (SELECT *, CASE WHEN records = error_records THEN 'error' ELSE 'processed' END AS status FROM files)"""


def _daily_lake(spark, sf):
    """Raw record texts, one file a day under day=..., and an empty file."""
    path = _fresh(spark, "daily")
    env = raw_envelopes(spark, sf, keep=["event_time"]).select(F.substring("event_time", 1, 10).alias("day"), "value")
    blank = spark.createDataFrame([("empty", "")], "day string, value string")
    env.unionByName(blank).repartition("day").write.partitionBy("day").text(path)
    return path


def _daily_stats(spark, sf):
    path = _daily_lake(spark, sf)
    listing = L.lake_files(spark, path)
    scan = materialize(L.lake_json_scan(spark, path, ENVELOPE_STRUCT))
    return materialize(L.ingest_stats(scan, listing))


@register("ingest_stats", with_ctes("SELECT day, records, error_records, true AS has_bytes, status FROM stats", STATS_CTES))
def q_ingest_stats(spark, sf):
    """Per file (a day each): records, parse errors, status; an empty file is an error."""
    return _daily_stats(spark, sf).select(
        F.regexp_extract("file_path", "day=([^/]+)", 1).alias("day"), "records", "error_records",
        (F.col("bytes") > 0).alias("has_bytes"), "status")


@register("ingest_totals", with_ctes("""
SELECT count(*) FILTER (WHERE status = 'processed') AS processed_files,
       count(*) FILTER (WHERE status = 'error') AS error_files, CAST(0 AS BIGINT) AS skipped_files,
       CAST(sum(records - error_records) AS BIGINT) AS records, CAST(sum(error_records) AS BIGINT) AS error_records
FROM stats""", STATS_CTES))
def q_ingest_totals(spark, sf):
    return L.ingest_totals(_daily_stats(spark, sf)).drop("bytes")


@register("incremental_new_files", with_ctes(f"""
SELECT {', '.join(EVENT_FIELDS)} FROM behaviour
WHERE strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') >= TIMESTAMP '{LAKE_SPLIT_DATE} 00:00:00'
""", VERDICT_CTES))
def q_incremental_new_files(spark, sf):
    """Two loads into one lake and a run after each: the second run opens only
    the files that the saved log of the first does not list."""
    path, log = _fresh(spark, "inclake"), _fresh(spark, "inclog")
    ev = behaviour_events(spark, sf).withColumn("ts", parse_event_time("event_time"))
    split = F.lit(LAKE_SPLIT_DATE).cast("timestamp")
    schema = ev.select(*EVENT_FIELDS).schema
    ev.filter(F.col("ts") < split).select(*EVENT_FIELDS).write.mode("append").json(path)
    L.ingest_new(spark, path, schema, log)
    ev.filter(F.col("ts") >= split).select(*EVENT_FIELDS).write.mode("append").json(path)
    rows, _ = L.ingest_new(spark, path, schema, log)
    return rows.select(*EVENT_FIELDS)


@register("bronze_from_lake", with_ctes("""
, checked AS (
  SELECT CASE WHEN event_id % 100 = 41 THEN 'Unparsable record'
              WHEN event_time IS NULL OR event_time = '' THEN 'Missing event_time'
              WHEN event_type IS NULL OR event_type = '' THEN 'Missing event_type'
              WHEN product_id IS NULL OR product_id = 0 THEN 'Missing product_id'
              WHEN user_id IS NULL OR user_id = 0 OR event_id % 100 = 53 THEN 'Missing user_id'
              ELSE 'VALID' END AS status,
         sha256(CAST(product_id AS VARCHAR) || '|' || event_time || '|' || CAST(user_id AS VARCHAR)) AS record_hash
  FROM behaviour)
SELECT status, count(*) AS records,
       count(DISTINCT CASE WHEN status = 'VALID' THEN record_hash END) AS distinct_records
FROM checked GROUP BY 1""", VERDICT_CTES))
def q_bronze_from_lake(spark, sf):
    """Raw lake texts -> payload -> required fields -> record hash: every
    record counts as valid or under its error."""
    raw = spark.read.text(_envelope_lake(spark, sf))
    checked = bronze_from_text(raw)
    return checked.groupBy(F.coalesce("error", F.lit("VALID")).alias("status")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct(F.when(F.col("error").isNull(), F.col("record_hash"))).alias("distinct_records"))


# What arrives as one file, and what a routing batch takes at most: its records
# are held while they are written to both sinks.
FILE_RECORDS = 50_000
ROUTING_BATCH = 128 << 20
METRICS_BATCHES, METRICS_BATCH_FILES = 3, 24  # at least so many batches, of so many files at most


def _record_files(spark, sf, name, least=1):
    """Raw record texts as files that arrive, none of more than ``FILE_RECORDS``."""
    src = _fresh(spark, name)
    env = raw_envelopes(spark, sf).select("ingest_seq", "value")
    env = env if env.rdd.getNumPartitions() >= least else env.repartition(least)
    env.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(src)
    return src


def _stream_validated(spark, sf):
    src = _record_files(spark, sf, "envsrc")
    valid, invalid, ck = _fresh(spark, "valid"), _fresh(spark, "invalid"), _fresh(spark, "ck")
    stream = J.file_source(spark, src, spark.read.parquet(src).schema, max_bytes=ROUTING_BATCH)
    q = J.start_validation_routing(stream, valid, invalid, ck, keep=["ingest_seq"])
    q.awaitTermination()
    return valid, invalid


@register("stream_route_valid", with_ctes(f"""
SELECT b.ingest_seq, {', '.join('b.' + c for c in EVENT_FIELDS)}
FROM behaviour b JOIN verdict v USING (ingest_seq) WHERE v.valid = 'VALID'""", VERDICT_CTES))
def q_stream_route_valid(spark, sf):
    valid, _ = _stream_validated(spark, sf)
    return envelope_decode(spark.read.parquet(valid), keep=["ingest_seq"])


@register("stream_metrics", with_ctes("""
SELECT count(*) FILTER (WHERE valid = 'VALID') AS success_count, count(*) FILTER (WHERE valid <> 'VALID') AS failure_count,
       true AS has_time FROM verdict""", VERDICT_CTES))
def q_stream_metrics(spark, sf):
    """Counters that the routing job adds to its metrics table, batch by batch."""
    src, metrics, ck = _record_files(spark, sf, "metricsrc", METRICS_BATCHES), _fresh(spark, "metrics"), _fresh(spark, "ckm")
    records = spark.read.parquet(src)
    files = min(METRICS_BATCH_FILES, -(-len(records.inputFiles()) // METRICS_BATCHES))
    stream = J.file_source(spark, src, records.schema, max_files=files)
    J.start_validation_routing(stream, _fresh(spark, "valid"), _fresh(spark, "invalid"), ck, keep=["ingest_seq"],
                               metrics_path=metrics).awaitTermination()
    return J.live_metrics(spark, metrics).select("success_count", "failure_count", (F.col("ms_per_1000") > 0).alias("has_time"))


LATE_PARTS = 3


@register("stream_late_rows", with_ctes(f"""
, e AS (SELECT ingest_seq, strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') AS ts,
               CAST(('0x' || substr(sha256(CAST(ingest_seq AS VARCHAR)), 1, 8)) AS BIGINT) % {LATE_PARTS} AS part FROM behaviour),
marks AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM e GROUP BY part)
SELECT ingest_seq, coalesce(ts < newest - INTERVAL 10 DAY, false) AS late FROM e JOIN marks USING (part)""", VERDICT_CTES))
def q_stream_late_rows(spark, sf):
    """Events that come in no order of time, in several batches: those more than
    ten days behind what was seen before go to the late table."""
    src, on_time, late, ck = (_fresh(spark, x) for x in ("latesrc", "ontime", "late", "ckl"))
    rows = materialize(behaviour_events(spark, sf).select("ingest_seq", parse_event_time("event_time").alias("event_timestamp")))
    part = F.pmod(F.conv(F.substring(F.sha2(F.col("ingest_seq").cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(LATE_PARTS))
    for k in range(LATE_PARTS):
        rows.filter(part == k).write.mode("append").parquet(src)
        J.start_late_split(J.file_source(spark, src, rows.schema), "event_timestamp", on_time, late, ck, delay="10 days").awaitTermination()
    tables = [spark.read.schema("ingest_seq long, batch_id long").parquet(p).select("ingest_seq", F.lit(is_late).alias("late"))
              for p, is_late in ((on_time, False), (late, True)) if J.existing_folder(spark, p)]
    return tables[0].unionByName(tables[1]) if len(tables) > 1 else tables[0]


@register("session_counter", with_ctes("""
, e AS (SELECT user_session, strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') AS ts FROM behaviour)
SELECT user_session, count(*) AS activity_count, max(ts) AS last_seen,
       max(ts) + INTERVAL 24 HOUR <= (SELECT max(ts) FROM e) - INTERVAL 1 MINUTE AS expired
FROM e WHERE user_session IS NOT NULL GROUP BY user_session""", VERDICT_CTES))
def q_session_counter(spark, sf):
    """The stateful counter over events that arrive in three loads, in order of
    time: what it last said of every session, closed ones and open ones."""
    src, out, ck = (_fresh(spark, x) for x in ("countsrc", "counts", "ckc"))
    rows = materialize(behaviour_events(spark, sf).select("user_session", parse_event_time("event_time").alias("event_timestamp")))
    day = F.dayofmonth("event_timestamp")
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        rows.filter(part).write.mode("append").parquet(src)
        said = J.session_counter_stream(J.file_source(spark, src, rows.schema))
        (said.writeStream.outputMode("update").foreachBatch(lambda batch, number: J._write_batch(batch, out, number))
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).groupBy("user_session").agg(
        F.max("activity_count").alias("activity_count"), F.max("last_seen").alias("last_seen"), F.max("expired").alias("expired"))


@register("stream_features", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM features", FEATURE_CTES))
def q_stream_features(spark, sf):
    valid, _ = _stream_validated(spark, sf)
    offline, ck = _fresh(spark, "offline"), _fresh(spark, "ckf")
    stream = J.file_source(spark, valid, spark.read.parquet(valid).schema)
    q = J.start_feature_ingest(stream.select("ingest_seq", "value"), offline, ck, keep=["ingest_seq"],
                               trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(offline).select("ingest_seq", *FE.FEATURE_COLUMNS)


@register("stream_online_latest", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM latest", FEATURE_CTES))
def q_stream_online_latest(spark, sf):
    """The online store after the feature stream: latest row per entity."""
    valid, _ = _stream_validated(spark, sf)
    offline, online, ck = _fresh(spark, "offline"), _fresh(spark, "online"), _fresh(spark, "cko")
    stream = J.file_source(spark, valid, spark.read.parquet(valid).schema)
    J.start_feature_ingest(stream.select("ingest_seq", "value"), offline, ck, keep=["ingest_seq"],
                           trigger={"availableNow": True}, online_path=online).awaitTermination()
    return J.online_snapshot(spark, online).select("ingest_seq", *FE.FEATURE_COLUMNS)


@register("online_store", with_ctes(f"SELECT ingest_seq, {FEATURE_COLS_SQL} FROM latest", FEATURE_CTES))
def q_online_store(spark, sf):
    """Three merges in arbitrary order of time, one of them made twice: the
    store holds the latest row per entity."""
    rows = _features(spark, sf).withColumn("part", F.pmod(F.xxhash64("ingest_seq"), F.lit(3)))
    rows = materialize(rows)
    path = _fresh(spark, "store")
    for version, part in enumerate((2, 0, 1, 1)):
        J.online_merge(rows.filter(F.col("part") == part).drop("part"), path, min(version, 2))
    return J.online_snapshot(spark, path).select("ingest_seq", *FE.FEATURE_COLUMNS)


@register("stream_dedup", with_ctes(
    "SELECT ingest_seq, record_hash, event_time, product_id, user_id, event_type FROM dedup"))
def q_stream_dedup(spark, sf):
    """Bronze rows deduplicated for good in several micro-batches, files in
    order of arrival: the first copy survives."""
    src, out, ck = _fresh(spark, "bronzesrc"), _fresh(spark, "dedup"), _fresh(spark, "ckd")
    rows = materialize(bronze_valid(bronze_input(spark, sf)))
    cut = rows.approxQuantile("ingest_seq", [0.5], 0.01)
    half = F.col("ingest_seq") <= F.lit(cut[0] if cut else 0)
    for part in (rows.filter(half), rows.filter(~half)):
        part.write.mode("append").parquet(src)
        J.start_dedup(J.file_source(spark, src, rows.schema), out, ck).awaitTermination()
    return spark.read.parquet(out).select("ingest_seq", "record_hash", "event_time", "product_id", "user_id", "event_type")

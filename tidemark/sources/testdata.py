"""Adapters from the driver's parquet tables to the behaviour-event domain.

The test tables carry no e-commerce event table, so ``behaviour_events`` derives
one from ``events`` joined to ``part`` by fixed arithmetic.  Every oracle in
``tidemark.plans.oracles`` repeats the same derivation in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import once
from tidemark.functions.joins import bounded_broadcast

# --- fixed values of the adapter (shared with the DuckDB oracle) ---------
EVENT_TYPE_MAP = {"click": "cart", "signup": "remove_from_cart"}  # others unchanged
PRICE_FACTOR = 3              # raw values end near 490; x3 fills the luxury tier
FAULT_PRICE = -100.0          # planted fault: every 10th event_id
FAULT_EVERY = 10
REPLAY_MOD, REPLAY_REM = 20, 3  # event_id % 20 = 3 is delivered twice
BRAND_NULL_MOD = 7            # k % 7 = 0  -> brand null
CATEGORY_NULL_MOD = 11        # k % 11 = 0 -> category_code null
CATEGORY_SHORT_MOD = 13       # k % 13 = 0 -> single-token category_code
CATEGORY_ID_BASE, CATEGORY_ID_MOD = 1000, 6
# Envelope faults by event_id % 100 (validator test surface)
ENV_DROP_SESSION = 17         # payload lacks user_session
ENV_PRODUCT_AS_TEXT = 29      # product_id sent as a JSON string
ENV_TRUNCATED = 41            # record text cut short (not JSON)
ENV_USER_NULL = 53            # user_id is JSON null (non-union type)
ENV_DROP_CATEGORY = 71        # union-typed key category_code absent
ENV_CATEGORY_FLOAT = 83       # category_id sent as 7.0-style number
# Declared event schema carried by every envelope, in field order.
EVENT_SCHEMA_JSON = (
    '{"type":"struct","fields":['
    '{"name":"event_time","type":"string"},'
    '{"name":"event_type","type":"string"},'
    '{"name":"product_id","type":"long"},'
    '{"name":"category_id","type":"long"},'
    '{"name":"category_code","type":["null","string"],"default":null},'
    '{"name":"brand","type":["null","string"],"default":null},'
    '{"name":"price","type":"double"},'
    '{"name":"user_id","type":"long"},'
    '{"name":"user_session","type":"string"}]}'
)
EVENT_FIELDS = ["event_time", "event_type", "product_id", "category_id", "category_code",
                "brand", "price", "user_id", "user_session"]
# -------------------------------------------------------------------------


# Tables whose rows drive per-row work; small dimension tables are read as is.
FACT_TABLES = {"events", "lineitem", "orders", "documents", "pages", "conversations", "embeddings"}


# Events for one task, in stored bytes and in rows: each becomes a record of some
# 900 bytes that is built, parsed and checked.  A row may take 8 stored bytes or
# 20, so the bytes alone do not bound a task.
EVENT_TASK_BYTES = 3 << 20
EVENT_TASK_ROWS = 100_000


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = scan_table(spark, sf_dir, name)
    return spread(df) if name in FACT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Parallelism floor for unsplittable inputs.

    A file written as one row group scans as one task, which would run every
    per-row expression on a single core.  When a scan yields fewer partitions
    than the cluster's default parallelism, redistribute it round-robin; on a
    cluster reading many input splits this is a no-op (no extra shuffle).
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover
        return df
    return df.repartition(want) if have < want else df


def event_tasks(events: DataFrame) -> int:
    """Tasks that the stored bytes and the rows of an event table call for.
    Given the scan itself, the rows are counted from the files' footers."""
    stored = events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(-(-int(str(stored)) // EVENT_TASK_BYTES), -(-events.count() // EVENT_TASK_ROWS))


def behaviour_events(spark: SparkSession, sf_dir: str, with_replays: bool = True) -> DataFrame:
    """Behaviour events (domain schema) + ``ingest_seq`` arrival order.

    Columns: ingest_seq, event_id, event_time, event_type, product_id, category_id,
    category_code, brand, price, user_id, user_session.
    """
    # a scan may be a few tasks however many rows it has, and what follows costs
    # far more a row than reading it, so the rows are first dealt evenly to tasks
    # whose number grows with the table
    scan = scan_table(spark, sf_dir, "events")
    tasks = event_tasks(scan)
    many = tasks > spark.sparkContext.defaultParallelism
    events = scan.repartition(tasks) if many else spread(scan)
    # the JSON property is extracted once per row (fenced), so filters on
    # derived columns do not re-extract it
    ev = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        once(F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), "p_brand", "p_type", "p_name")
    j = ev.join(bounded_broadcast(part), "k", "left")
    # a shuffle join deals the events by k, which may have few or hot values
    if many:
        j = j.repartition(tasks)
    et = F.col("event_type")
    mapped = None
    for src, dst in EVENT_TYPE_MAP.items():
        mapped = F.when(et == src, dst) if mapped is None else mapped.when(et == src, dst)
    mapped = mapped.otherwise(et)
    full_code = F.concat(F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", "."))
    base = j.select(
        (F.col("event_id") * 2).alias("ingest_seq"),
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        mapped.alias("event_type"),
        (F.col("k") + 1).alias("product_id"),
        (F.lit(CATEGORY_ID_BASE) + F.col("k") % CATEGORY_ID_MOD).alias("category_id"),
        F.when(F.col("k") % CATEGORY_NULL_MOD == 0, F.lit(None).cast("string"))
         .when(F.col("k") % CATEGORY_SHORT_MOD == 0, F.lower("p_type"))
         .otherwise(full_code).alias("category_code"),
        F.when(F.col("k") % BRAND_NULL_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("event_id") % FAULT_EVERY == 0, F.lit(FAULT_PRICE))
         .otherwise(F.round(F.col("value") * PRICE_FACTOR, 2)).alias("price"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyy-MM-dd")).alias("user_session"),
    )
    if not with_replays:
        return base
    # a row delivered twice is exploded in place: one scan, no self-union
    copies = F.when(F.col("event_id") % REPLAY_MOD == REPLAY_REM, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (base.select("*", F.explode(copies).alias("_copy"))
            .withColumn("ingest_seq", F.col("ingest_seq") + F.col("_copy")).drop("_copy"))


def raw_envelopes(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Self-describing JSON envelopes ``{"schema":…,"payload":…}`` with planted faults.

    Columns: ingest_seq, event_id, value (the record text), and any of ``keep``.
    """
    ev = behaviour_events(spark, sf_dir)
    payload = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    m = F.col("event_id") % 100
    payload = (
        F.when(m == ENV_DROP_SESSION, F.regexp_replace(payload, r',"user_session":"[^"]*"', ""))
        .when(m == ENV_PRODUCT_AS_TEXT, F.regexp_replace(payload, r'"product_id":(-?\d+)', '"product_id":"$1"'))
        .when(m == ENV_USER_NULL, F.regexp_replace(payload, r'"user_id":-?\d+', '"user_id":null'))
        .when(m == ENV_DROP_CATEGORY, F.regexp_replace(payload, r'"category_code":(null|"[^"]*"),', ""))
        .when(m == ENV_CATEGORY_FLOAT, F.regexp_replace(payload, r'"category_id":(-?\d+)', '"category_id":$1.0'))
        .otherwise(payload))
    text = F.concat(F.lit('{"schema":' + EVENT_SCHEMA_JSON + ',"payload":'), payload, F.lit("}"))
    text = F.when(m == ENV_TRUNCATED, F.substring(text, 1, 60)).otherwise(text)
    return ev.select("ingest_seq", "event_id", *(keep or []), once(text.alias("value")))


def cdc_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows as a CDC connector emits them (before/after images, op code).

    Derived by fixed rules: each event is created ('c'); event_id % 9 = 4 is later
    updated ('u', price raised by 1); event_id % 25 = 6 is deleted ('d', after null)
    and followed by a tombstone (op and images null).  event_time travels as epoch
    microseconds on even event_ids, as text on odd ones.
    Columns: ingest_seq, event_id, op, after (struct of the event row), ts_ms.
    """
    ev = behaviour_events(spark, sf_dir, with_replays=False)
    ts = F.try_to_timestamp(F.regexp_replace("event_time", " UTC$", ""), F.lit("yyyy-MM-dd HH:mm:ss"))

    def image(price_delta):
        return F.struct(
            F.when(F.col("event_id") % 2 == 0, F.unix_micros(ts).cast("string"))
             .otherwise(F.col("event_time")).alias("event_time"),
            "event_type", "product_id", "category_id", "category_code", "brand",
            (F.col("price") + price_delta).alias("price"), "user_id", "user_session")

    # the changes of one event, in order: (op, price raised by, has an image)
    def change(place: int, op: str | None, delta: float, image_there: bool):
        return F.struct(F.lit(place).alias("place"), F.lit(op).cast("string").alias("op"),
                        F.lit(delta).alias("delta"), F.lit(image_there).alias("there"))

    gone = F.array(change(2, "d", 0.0, False), change(3, None, 0.0, False))
    none = F.filter(gone, lambda _: F.lit(False))
    changes = F.concat(F.array(change(0, "c", 0.0, True)),
                       F.when(F.col("event_id") % 9 == 4, F.array(change(1, "u", 1.0, True))).otherwise(none),
                       F.when(F.col("event_id") % 25 == 6, gone).otherwise(none))
    per_change = ev.select("*", F.inline(changes))
    return per_change.select(
        (F.col("ingest_seq") * 4 + F.col("place")).alias("ingest_seq"), "event_id", "op",
        F.when(F.col("there"), image(F.col("delta"))).alias("after"))

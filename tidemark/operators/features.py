"""Streaming-feature preprocessing, latest-value serving, incremental materialisation.

The per-batch preprocessing runs, in order: keep VALID -> event_time renamed to
event_timestamp and parsed (unparsable rows dropped) -> activity_count per
session (before the quality filter, so later-dropped rows still count) ->
null defaults -> two-level category -> weekday -> is_purchased -> casts ->
conjunctive quality filter -> projection.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import category_two_levels, event_weekday, is_purchased, parse_event_time

# --- fixed values -----------------------------------------------------------
FILL_DEFAULTS = {"price": 0.0, "brand": "", "category_code": "", "event_type": ""}
FEATURE_COLUMNS = ["event_timestamp", "user_id", "product_id", "user_session", "price", "brand",
                   "category_code_level1", "category_code_level2", "event_weekday", "activity_count",
                   "is_purchased"]
SERVED_FEATURES = ["activity_count", "event_weekday", "is_purchased", "brand", "price",
                   "category_code_level1", "category_code_level2"]
ENTITY_KEYS = ["user_id", "product_id"]
FEATURE_TTL = "1 day"
# -----------------------------------------------------------------------------


def session_counts(df: DataFrame, key: str = "user_session", out: str = "activity_count") -> DataFrame:
    """count(*) per key attached to each row, via partial aggregate + key join.

    Equivalent to ``count(*) OVER (PARTITION BY key)`` (null keys form one
    group, hence the null-safe join) but a hot key is pre-combined map-side and
    the join side can be split by AQE skew handling.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).withColumnRenamed(key, "_k")
    j = df.join(counts, df[key].eqNullSafe(counts["_k"]), "left")
    return j.drop("_k")


def with_event_timestamp(df: DataFrame) -> DataFrame:
    if "event_time" in df.columns:
        df = df.withColumnRenamed("event_time", "event_timestamp")
    return (df.withColumn("event_timestamp", parse_event_time("event_timestamp"))
              .filter(F.col("event_timestamp").isNotNull()))


# Canonical types of the stored features.
FEATURE_TYPES = {"user_id": "long", "product_id": "long", "price": "double", "activity_count": "long"}


def with_feature_columns(df: DataFrame) -> DataFrame:
    """Defaults, two-level category, weekday, purchase flag and canonical types."""
    filled = df.fillna(FILL_DEFAULTS)
    level1, level2 = category_two_levels("category_code")
    derived = {"category_code_level1": level1, "category_code_level2": level2,
               "event_weekday": event_weekday("event_timestamp"), "is_purchased": is_purchased("event_type")}
    return filled.withColumns(derived | {c: F.col(c).cast(t) for c, t in FEATURE_TYPES.items()})


# --- fixed values: what a feature row must satisfy ---------------------------
# column -> rules; rows are rejected under the first rule that they break
QUALITY_RULES = {
    "user_id": ["present", ("above", 0)],
    "product_id": ["present", ("above", 0)],
    "price": ["present", ("at least", 0)],
    "brand": ["present", "text"],
    "category_code_level1": ["present", "text"],
    "category_code_level2": ["present", "text"],
    "user_session": ["present", "text"],
    "activity_count": ["present", ("above", 0)],
    "event_weekday": ["present", ("at least", 0), ("at most", 6)],
}
# -----------------------------------------------------------------------------


def _holds(column: str, rule: str | tuple[str, int]) -> Column:
    value = F.col(column)
    if rule == "present":
        return value.isNotNull()
    if rule == "text":
        return F.length(F.trim(value)) > 0
    kind, bound = rule
    return {"above": value > bound, "at least": value >= bound, "at most": value <= bound}[kind]


def reject_reason(rules: dict = QUALITY_RULES) -> Column:
    """``column: rule`` of the first rule that a row breaks; null if it keeps all."""
    checks = [F.when(~F.coalesce(_holds(column, rule), F.lit(False)),
                     F.lit(f"{column}: {rule if isinstance(rule, str) else ' '.join(map(str, rule))}"))
              for column, own in rules.items() for rule in own]
    return F.coalesce(*checks)


def rejected_by_reason(df: DataFrame) -> DataFrame:
    """How many rows the quality filter drops under each rule."""
    return (df.select(reject_reason().alias("reason")).filter(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def quality_filter(df: DataFrame) -> DataFrame:
    return df.filter(reject_reason().isNull())


def preprocess_batch(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One micro-batch (or a whole batch table) of validated events -> feature rows."""
    keep = keep or []
    if "valid" in df.columns:
        df = df.filter(F.col("valid") == "VALID")
    df = with_event_timestamp(df)
    df = session_counts(df)
    df = with_feature_columns(df)
    return quality_filter(df).select(*keep, *FEATURE_COLUMNS)


def offline_rows(features: DataFrame, clock: _dt.datetime | None = None,
                 batch_id: int | None = None) -> DataFrame:
    ts = F.lit(clock).cast("timestamp") if clock is not None else F.current_timestamp()
    out = features.withColumn("created_timestamp", ts)
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
    return out


def latest_per_key(df: DataFrame, keys: list[str] = ENTITY_KEYS, ts: str = "event_timestamp",
                   tiebreak: str | None = "ingest_seq") -> DataFrame:
    """Newest row per entity key (max_by on (ts, tiebreak)); partial-aggregated map-side."""
    cols = df.columns
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))


def feature_lookup(requests: DataFrame, latest: DataFrame, now_col: str = "request_ts",
                   ttl: str = FEATURE_TTL, features: list[str] = SERVED_FEATURES) -> DataFrame:
    """Online lookup: each request row gets the latest features of its key, or
    nulls when the key is unknown or its row is older than the TTL."""
    lat = latest.select(*ENTITY_KEYS, F.col("event_timestamp").alias("_fts"), *features)
    cond = [requests[k] == lat[k] for k in ENTITY_KEYS]
    cond.append(lat["_fts"] >= requests[now_col] - F.expr(f"INTERVAL {ttl}"))
    j = requests.join(lat, cond, "left")
    return j.select(*[requests[c] for c in requests.columns], *[lat[f] for f in features])


def materialise_incremental(snapshot: DataFrame, increment: DataFrame,
                            keys: list[str] = ENTITY_KEYS) -> DataFrame:
    """Merge the latest rows of a new time slice into a keyed snapshot."""
    return latest_per_key(snapshot.unionByName(latest_per_key(increment, keys)), keys)


def cart_purchase_label(df: DataFrame, grain: list[str] = ["user_session", "product_id"]) -> DataFrame:
    """(grain) pairs that had a cart event, labelled 1 when a purchase exists for
    the same pair.  A single aggregation (no self-join), pre-combined map-side."""
    g = df.groupBy(*grain).agg(
        F.count_if(F.col("event_type") == "cart").alias("cart_events"),
        F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("is_purchased"))
    return g.filter(F.col("cart_events") > 0)


def session_window_activity(df: DataFrame, key: str = "user_id", ts: str = "event_timestamp",
                            gap: str = "24 hours", chunks: int | None = None) -> DataFrame:
    """Gap-based sessions per key: a new session starts when the next event is
    ``gap`` or more after the previous one.  Output: key, session_start,
    session_end (= last event + gap, as ``session_window``), event_count,
    first_event, last_event.

    Skew-safe in batch (a key may hold a third of all events):
      1. range-partition on (key, ts): a hot key is cut into several
         contiguous time chunks handled by different tasks;
      2. within each (chunk, key), ordinary sessions via lag + running sum
         (window partitions are bounded by the chunk size) and a local
         aggregate per session;
      3. sessions strictly inside a chunk are final; only the first and last
         session of each (chunk, key) can touch a neighbouring chunk, so just
         those (at most two per chunk) are re-merged per key.
    """
    from pyspark.sql import Window
    gap_us = F.expr(f"INTERVAL {gap}")
    gap_micros = F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + gap_us)

    base = df.select(F.col(key).alias("_k"), F.col(ts).alias("_t")).filter(F.col("_t").isNotNull())
    # chunk count: explicit, or left to AQE (sized from the data; coalescing
    # keeps ranges contiguous, so chunks stay contiguous in (key, time))
    ranged = base.repartitionByRange(chunks, "_k", "_t") if chunks else base.repartitionByRange("_k", "_t")
    ev = ranged.withColumn("_chunk", F.spark_partition_id())
    w = Window.partitionBy("_chunk", "_k").orderBy("_t")
    prev = F.lag("_t").over(w)
    new = F.when(prev.isNull() | (F.unix_micros(F.col("_t")) - F.unix_micros(prev) >= gap_micros), 1).otherwise(0)
    local = (ev.withColumn("_new", new).withColumn("_lsid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("_chunk", "_k", "_lsid")
             .agg(F.count(F.lit(1)).alias("event_count"), F.min("_t").alias("first_event"),
                  F.max("_t").alias("last_event")))
    wl = Window.partitionBy("_chunk", "_k")
    local = local.withColumn("_nsess", F.max("_lsid").over(wl))
    edge = (F.col("_lsid") == 1) | (F.col("_lsid") == F.col("_nsess"))
    interior = local.filter(~edge).select("_k", "event_count", "first_event", "last_event")
    b = local.filter(edge).select("_k", "event_count", "first_event", "last_event")
    wb = Window.partitionBy("_k").orderBy("first_event", "last_event")
    bprev = F.max("last_event").over(wb.rowsBetween(Window.unboundedPreceding, -1))
    bnew = F.when(bprev.isNull() | (F.unix_micros(F.col("first_event")) - F.unix_micros(bprev) >= gap_micros), 1) \
        .otherwise(0)
    merged = (b.withColumn("_new", bnew).withColumn("_sid", F.sum("_new").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("_k", "_sid")
              .agg(F.sum("event_count").alias("event_count"), F.min("first_event").alias("first_event"),
                   F.max("last_event").alias("last_event"))
              .drop("_sid"))
    out = interior.unionByName(merged)
    return out.select(F.col("_k").alias(key), F.col("first_event").alias("session_start"),
                      (F.col("last_event") + gap_us).alias("session_end"),
                      F.col("event_count").cast("long").alias("event_count"), "first_event", "last_event")

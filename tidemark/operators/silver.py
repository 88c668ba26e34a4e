"""Silver layer: dedup, timestamps, derived columns, session metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import category_levels, day_name, parse_event_time, price_tier, to_ts_string

# Candidate timestamp columns, in preference order.
TIMESTAMP_CANDIDATES = ["event_time", "timestamp", "event_timestamp"]


def first_per_key(df: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    """Keep the earliest row per key (by ``order``).

    A grouped ``min_by`` is used rather than a window: the aggregate is computed
    partially before the shuffle, so a key holding a third of all rows collapses
    to one row per map task instead of landing whole in one window partition.
    """
    cols = df.columns
    packed = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*keys).agg(F.min_by(packed, F.col(order)).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))


def dedup_first(df: DataFrame) -> DataFrame:
    return first_per_key(df, ["record_hash"])


def duplicate_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_distinct("record_hash").alias("distinct_records")) \
             .withColumn("duplicate_count", F.col("total_records") - F.col("distinct_records"))


def timestamp_column(df: DataFrame) -> str:
    for c in TIMESTAMP_CANDIDATES:
        if c in df.columns:
            return c
    raise ValueError(f"No timestamp column found. Available columns: {df.columns}")


def silver_time(df: DataFrame) -> DataFrame:
    src = F.col(timestamp_column(df))
    ts = parse_event_time(src) if dict(df.dtypes)[timestamp_column(df)] == "string" else src.cast("timestamp")
    return (df.withColumn("event_timestamp", ts)
              .withColumns({"event_date": F.to_date("event_timestamp"),
                            "event_hour": F.hour("event_timestamp").cast("int"),
                            "day_of_week": day_name("event_timestamp")}))


def add_derived(df: DataFrame) -> DataFrame:
    l1, l2, l3 = category_levels("category_code")
    return df.withColumns({"price_tier": price_tier("price"),
                           "category_l1": l1, "category_l2": l2, "category_l3": l3})


def session_metrics(df: DataFrame) -> DataFrame:
    """Per-session count/min/max of event time and mean/min/max of price.

    The null session is left out, as a group-by on it would drop it.
    """
    return (df.filter(F.col("user_session").isNotNull())
            .groupBy("user_session")
            .agg(F.count("event_timestamp").alias("events_in_session"),
                 F.min("event_timestamp").alias("session_start"),
                 F.max("event_timestamp").alias("session_end"),
                 F.avg("price").alias("avg_price"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price")))


def with_session_metrics(df: DataFrame) -> DataFrame:
    """Attach session metrics: partial aggregate, then a key join.

    Aggregate-then-join (instead of an unordered window) keeps a hot session
    splittable: the aggregate pre-combines map-side, and AQE's skew-join can
    split the large side of the join; a window would pin the session to one task.
    """
    return df.join(session_metrics(df), "user_session", "left")


def silver(bronze_valid_rows: DataFrame) -> DataFrame:
    """dedup -> timestamps -> derived columns -> session metrics (post-dedup)."""
    return with_session_metrics(add_derived(silver_time(dedup_first(bronze_valid_rows))))


def silver_serialise(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "event_timestamp": to_ts_string("event_timestamp"),
        "session_start": to_ts_string("session_start"),
        "session_end": to_ts_string("session_end"),
        "event_date": F.col("event_date").cast("string"),
    })


def transform_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_distinct("user_id").alias("unique_users"),
                  F.count_distinct("user_session").alias("unique_sessions"),
                  F.avg("events_in_session").alias("avg_events_per_session"))


def price_tier_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("price_tier").agg(F.count(F.lit(1)).alias("n"))

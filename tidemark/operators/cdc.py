"""Change-data-capture rows: unwrap after-images, normalise, re-envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: the declared wire schema ------------------------------------
# Debezium-style field definitions (column name under "field", logical type under "name").
CDC_SCHEMA_JSON = (
    '{"type":"struct","fields":['
    '{"field":"event_time","type":"string","optional":false,"name":"io.debezium.time.ZonedTimestamp"},'
    '{"field":"event_type","type":"string","optional":true},'
    '{"field":"product_id","type":"int64","optional":false},'
    '{"field":"category_id","type":"int64","optional":false},'
    '{"field":"category_code","type":"string","optional":true},'
    '{"field":"brand","type":"string","optional":true},'
    '{"field":"price","type":"double","optional":true},'
    '{"field":"user_id","type":"int64","optional":false},'
    '{"field":"user_session","type":"string","optional":true}]}'
)
# -------------------------------------------------------------------------------


def cdc_unwrap(changes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """After-image of each change; deletes and tombstones are dropped."""
    keep = keep or [c for c in changes.columns if c not in ("op", "after")]
    live = changes.filter(F.col("op").isNotNull() & (F.col("op") != "d") & F.col("after").isNotNull())
    return live.select(*keep, "op", "after.*")


# A date and a time of day, at least; other texts are no event time.
DATE_AND_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}[ Tt]\d{1,2}:"


def cdc_normalise(df: DataFrame) -> DataFrame:
    """event_time as epoch microseconds (also before 1970) or text -> timestamp;
    a negative price becomes 0, a missing one stays missing.

    Texts may carry a ``T``, a fraction, and ``Z``, an offset or `` UTC``;
    without a zone they are read in the session's (UTC).  Other texts give null.
    """
    et = F.col("event_time")
    text = F.when(et.rlike(DATE_AND_TIME), F.upper(F.trim(et)).try_cast("timestamp"))
    ts = F.when(et.rlike(r"^-?\d+$"), F.timestamp_micros(et.try_cast("bigint"))).otherwise(text)
    price = F.when(F.col("price") < 0, F.lit(0.0)).otherwise(F.col("price"))
    return df.withColumns({"event_time": ts, "price": price})


def cdc_envelope(df: DataFrame, keep: list[str]) -> DataFrame:
    """Encode normalised rows as CDC envelopes (zoned UTC event time)."""
    payload = F.to_json(F.struct(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id",
        "user_session"), {"ignoreNullFields": "false"})
    value = F.concat(F.lit('{"schema":' + CDC_SCHEMA_JSON + ',"payload":'), payload, F.lit("}"))
    return df.select(*keep, value.alias("value"))

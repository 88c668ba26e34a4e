"""Self-describing envelope encode/decode (schema + payload JSON records)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import once
from tidemark.sources.testdata import EVENT_FIELDS, EVENT_SCHEMA_JSON

# Typed view of the event payload (ids as LongType, price as DoubleType).
EVENT_STRUCT = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])
ENVELOPE_STRUCT = T.StructType([T.StructField("payload", EVENT_STRUCT)])


def envelope_encode(df: DataFrame, keep: list[str] | None = None,
                    schema_json: str = EVENT_SCHEMA_JSON) -> DataFrame:
    """Serialise each row's event fields with the declared schema attached; nulls kept."""
    payload = F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS]), {"ignoreNullFields": "false"})
    value = F.concat(F.lit('{"schema":' + schema_json + ',"payload":'), payload, F.lit("}"))
    return df.select(*(keep or []), once(value.alias("value")))


def envelope_decode(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse envelope text with the typed event schema and flatten the payload."""
    parsed = F.from_json(F.col(value), ENVELOPE_STRUCT)
    # parsed once per row behind a generator, so later filters on payload
    # fields cannot re-inline the parse
    return df.select(*(keep or []), F.inline(F.array(parsed["payload"])))

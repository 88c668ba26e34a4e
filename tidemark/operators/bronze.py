"""Bronze layer: record hash, required-field rules, valid/invalid split, enrichment."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import falsy, once, record_hash, record_hash_json

# --- fixed values ---------------------------------------------------------
PIPELINE_NAME = "minio_etl"
BRONZE_VALID_FLAG = "TRUE"
# Required fields in check order, with their value kind for the falsy test.
REQUIRED_FIELDS = [("event_time", "string"), ("event_type", "string"),
                   ("product_id", "number"), ("user_id", "number")]
META_COLUMNS = ["record_hash", "processed_date", "processing_pipeline", "valid"]
# -------------------------------------------------------------------------


def with_record_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("record_hash", record_hash())


def bronze_error(df: DataFrame) -> Column:
    """First failing required field ('Missing X'); null when the record passes."""
    return F.coalesce(*[F.when(falsy(F.col(c), kind), F.lit(f"Missing {c}"))
                        for c, kind in REQUIRED_FIELDS])


def bronze_validate(df: DataFrame) -> DataFrame:
    return df.withColumn("error", bronze_error(df))


def bronze_valid(df: DataFrame) -> DataFrame:
    return bronze_validate(df).filter(F.col("error").isNull()).drop("error")


def bronze_errors(df: DataFrame) -> DataFrame:
    return bronze_validate(df).filter(F.col("error").isNotNull())


def bronze_metrics(df: DataFrame) -> DataFrame:
    """Totals and error breakdown in one aggregation: rollup gives the total row.

    Columns: status ('VALID', an error text, or 'TOTAL'), n.
    """
    v = bronze_validate(df).select(F.coalesce("error", F.lit("VALID")).alias("status"))
    return (v.rollup("status").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("status", F.lit("TOTAL")).alias("status"), "n"))


def bronze_enrich(df: DataFrame, clock: _dt.datetime | None = None) -> DataFrame:
    """Attach processed_date (taken as a parameter so results are testable)."""
    ts = F.lit(clock).cast("timestamp") if clock is not None else F.current_timestamp()
    return df.withColumns({
        "processed_date": ts,
        "processing_pipeline": F.lit(PIPELINE_NAME),
        "valid": F.lit(BRONZE_VALID_FLAG),
    })


def bronze_flatten(df: DataFrame, payload: str = "payload", strict: bool = False) -> DataFrame:
    """Metadata columns first, then payload fields; payload wins on a name clash.

    With ``strict`` a record without a payload keeps metadata only (the source
    behaviour); otherwise flat records keep their own fields.
    """
    if payload not in df.columns:
        return df
    pfields = df.schema[payload].dataType.fieldNames()
    meta = [c for c in META_COLUMNS if c in df.columns and c not in pfields]
    has = F.col(payload).isNotNull()
    cols = [F.col(c) for c in meta]
    for f in pfields:
        inner = F.col(f"{payload}.{f}")
        if not strict and f in df.columns and f != payload:
            cols.append(F.when(has, inner).otherwise(F.col(f)).alias(f))
        else:
            cols.append(inner.alias(f))
    return df.select(*cols)


UNPARSABLE = "Unparsable record"


def payload_of(record: Column) -> Column:
    """The payload of a parsed record (VARIANT) where it is an object, else the
    record itself."""
    payload = F.try_variant_get(record, "$.payload", "variant")
    is_object = F.try_variant_get(record, "$.payload", "struct<>").isNotNull()
    return F.when(is_object, payload).otherwise(record)


def _missing(data: Column, name: str) -> Column:
    """Absent, null, empty text, zero, false, or an empty object or array."""
    v = F.try_variant_get(data, f"$['{name}']", "variant")
    text = F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(v, "$", "double")
    return (v.isNull() | F.is_variant_null(v)
            | F.coalesce(text.isin("", "false", "{}", "[]"), F.lit(False)) & ~F.coalesce(
                (F.schema_of_variant(v) == "STRING") & (text != ""), F.lit(False))
            | F.coalesce((F.schema_of_variant(v) != "STRING") & (number == 0), F.lit(False)))


def bronze_from_text(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw record texts with ``record_hash`` and ``error``.

    Parsed once; a record without a payload object is its own payload.  A text
    that is not a JSON object is an error and has no hash.
    """
    others = [c for c in raw.columns if c != value]
    parsed = raw.select(*others, value, once(F.try_parse_json(F.col(value)).alias("_rec")))
    is_object = F.try_variant_get("_rec", "$", "struct<>").isNotNull()
    data = parsed.select(*others, value, once(F.when(is_object, payload_of(F.col("_rec"))).alias("_data")))
    d = F.col("_data")
    error = F.when(d.isNull(), F.lit(UNPARSABLE))
    for name, _ in REQUIRED_FIELDS:
        error = error.when(_missing(d, name), F.lit(f"Missing {name}"))
    return data.select(*others, value, F.when(d.isNotNull(), record_hash_json(d)).alias("record_hash"), error.alias("error"))

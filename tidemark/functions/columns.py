"""Scalar column expressions (all JVM-side, codegen'd; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that results depend on --------------------------------
# Price tier upper bounds (exclusive): low < 50 <= medium < 250 <= high < 1000 <= luxury.
PRICE_TIERS = [(50, "low"), (250, "medium"), (1000, "high")]
PRICE_TIER_TOP = "luxury"
# Event time text format on the wire, e.g. "2019-10-01 02:30:12 UTC".
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_tier(price) -> Column:
    """low / medium / high / luxury; NaN and null fall through to luxury."""
    p = _c(price)
    expr = None
    for bound, name in PRICE_TIERS:
        cond = p < F.lit(bound)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(PRICE_TIER_TOP)


def category_levels(code) -> list[Column]:
    """Exact tokens 0..2 of a dotted category code; null code gives nulls."""
    parts = F.split(_c(code), r"\.")
    return [F.get(parts, i) for i in range(3)]


def category_two_levels(code) -> list[Column]:
    """What stands before and after the first dot (no dot: no second level),
    each without any occurrence of the text 'null'."""
    parts = F.split(_c(code), r"\.", 2)
    return [F.replace(F.get(parts, i), F.lit("null"), F.lit("")) for i in range(2)]


def parse_event_time(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss[ UTC]' -> timestamp; unparsable -> null (ANSI-safe)."""
    return F.try_to_timestamp(F.regexp_replace(_c(text), " UTC$", ""), F.lit(EVENT_TIME_FORMAT))


def to_ts_string(ts) -> Column:
    return F.date_format(_c(ts), EVENT_TIME_FORMAT)


def day_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


def event_weekday(ts) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def is_purchased(event_type) -> Column:
    return F.when(F.lower(_c(event_type)) == "purchase", 1).otherwise(0).cast("int")


def _py_str(c: Column) -> Column:
    # str(None) in the hashed key text is 'None'.
    return F.coalesce(c.cast("string"), F.lit("None"))


def record_hash(product_id="product_id", event_time="event_time", user_id="user_id") -> Column:
    """sha256 hex of 'product_id|event_time|user_id' (type and session ignored)."""
    return F.sha2(F.concat_ws("|", _py_str(_c(product_id)), _py_str(_c(event_time)),
                              _py_str(_c(user_id))), 256)


def falsy(c, kind: str) -> Column:
    """Python truthiness failure: null, empty string, or numeric zero."""
    c = _c(c)
    if kind == "string":
        return c.isNull() | (c == "")
    return c.isNull() | (c == 0)


def once(*cols: Column) -> Column:
    """Emit ``cols`` through a one-element generator: an optimizer fence.

    Catalyst pushes filters through projections by substituting each column's
    defining expression into the predicate; for an expensive per-row
    derivation (JSON parse/build) that means evaluating it again for every
    reference.  A predicate on a generator's output cannot be substituted
    below it, so the derivation runs exactly once per row.
    Use as ``df.select(*keep, once(expr1.alias("a"), expr2.alias("b")))``.
    """
    return F.inline(F.array(F.struct(*cols)))


def _key_text(payload: Column, name: str) -> Column:
    """Text of a payload key as the hashed key string: absent -> '', JSON null
    -> 'None', booleans -> 'True'/'False', text as is, numbers as JSON text."""
    v = F.try_variant_get(payload, "$['" + name + "']", "variant")
    kind = F.schema_of_variant(v)
    s = F.try_variant_get(v, "$", "string")
    return (F.when(v.isNull(), F.lit(""))
            .when(F.is_variant_null(v), F.lit("None"))
            .when(kind == "BOOLEAN", F.when(s == "true", F.lit("True")).otherwise(F.lit("False")))
            .when(kind == "STRING", s)
            .otherwise(F.to_json(v)))


def record_hash_json(payload: Column) -> Column:
    """record_hash over a raw JSON payload (VARIANT object), telling an absent
    key ('') from a present null ('None')."""
    return F.sha2(F.concat_ws("|", *[_key_text(payload, k) for k in ("product_id", "event_time", "user_id")]),
                  256)

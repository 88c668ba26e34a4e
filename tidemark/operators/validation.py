"""Self-describing record validation (schema + payload envelopes), routing, alerts.

Each record carries its own schema: ``{"schema": {"fields": [...]}, "payload": {...}}``.
Fields are checked in schema order and the first failure wins:

  required  key absent and not ``optional``        -> "Field X is required"
  optional  key absent and ``optional``            -> skipped
  null      JSON null is valid iff the declared type is a union containing
            "null" (or, for a non-union type, iff ``optional``)
  type      string / int64|long / double / boolean / Debezium time types;
            integers accept booleans, doubles accept integers and booleans;
            unknown type names are accepted   -> "Field X has invalid type"
  value     price > 0; event_type in the allowed list

Unparsable text, a missing ``schema``/``payload``/``fields`` key, or an
impossible comparison (a text price) give a PROCESSING_ERROR verdict.

Everything runs in the JVM with no Python worker and no shuffle.  A record is
parsed once into a VARIANT, and the per-field checks are higher-order
expressions over its schema's field array.

Schemas that many records carry are known at plan time (declared ones, or those
that ``record_heads`` finds in a batch).  A record that begins with the text of a known one
is cut behind it, and only its payload is parsed.  From a known schema an
acceptance test is generated as well: the payload's type, as text, against one
pattern, and the few value checks that the schema calls for.  What passes is
valid; all else, and every record of an unknown schema, takes the general
checks, so what is known changes the cost and never a verdict.
``validate_static`` uses one schema for all records, ``validate_dynamic`` each
record's own.
"""

from __future__ import annotations

import datetime as _dt
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import once

# --- fixed values -----------------------------------------------------------
VALID, INVALID = "VALID", "INVALID"
SCHEMA_ERROR, PROCESSING_ERROR = "SCHEMA_VALIDATION_ERROR", "PROCESSING_ERROR"
EVENT_TYPES = ["view", "cart", "purchase", "remove_from_cart"]
EVENT_TYPE_MESSAGE = "Event type should be one of: view, cart, purchase, remove_from_cart"
PRICE_MESSAGE = "Price should be greater than 0"
DEBEZIUM_PREFIX = "io.debezium.time"
MICRO_TS, MILLI_TS, ZONED_TS = ("io.debezium.time.MicroTimestamp", "io.debezium.time.Timestamp",
                                "io.debezium.time.ZonedTimestamp")
# Accepted zoned-timestamp layouts (strptime style):
#   %Y-%m-%dT%H:%M:%S.%fZ   %Y-%m-%dT%H:%M:%SZ   %Y-%m-%d %H:%M:%S.%f%z   %Y-%m-%d %H:%M:%S%z
_DATE_RE = r"(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
_TIME_RE = r"(2[0-3]|[01]\d|\d):([0-5]\d|\d):([0-5]\d|\d)"
_FRAC_RE = r"(\.\d{1,6})?"
_ZONE_RE = r"([+-](?:[01]\d|2[0-3]):?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|Z)"
ZONED_UTC_RE = "^" + _DATE_RE + "[Tt]" + _TIME_RE + _FRAC_RE + "[Zz]$"
ZONED_OFFSET_RE = "^" + _DATE_RE + " " + _TIME_RE + _FRAC_RE + _ZONE_RE + "$"
# Python type names used in the comparison error text.
PY_TYPE_OF_KIND = {"STRING": "str", "OBJECT": "dict", "ARRAY": "list"}
# -----------------------------------------------------------------------------


def _kind(v: Column) -> Column:
    """Coarse JSON kind of a VARIANT: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT<..>."""
    return F.schema_of_variant(v)


def _is_int(k: Column) -> Column:
    # JSON integers; integers beyond 64 bits surface as DECIMAL(p,0) with p >= 19
    big = k.rlike(r"^DECIMAL\((19|[2-9]\d),0\)$")
    return k.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | big


def _is_number(k: Column) -> Column:
    return _is_int(k) | k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT")


def _zoned_ok(s: Column) -> Column:
    def valid_for(rx: str) -> Column:
        y, m, d = (F.regexp_extract(s, rx, i) for i in (1, 2, 3))
        cal = F.try_make_timestamp(y.cast("int"), m.cast("int"), F.trim(d).cast("int"),
                                   F.lit(0), F.lit(0), F.lit(0))
        return s.rlike(rx) & (y.cast("int") >= 1) & cal.isNotNull()
    return F.coalesce(valid_for(ZONED_UTC_RE) | valid_for(ZONED_OFFSET_RE), F.lit(False))


def _type_ok(val: Column, k: Column, eff_type: Column) -> Column:
    as_int = _is_int(k) | (k == "BOOLEAN")
    nonneg = F.coalesce(F.try_variant_get(val, "$", "double") >= 0, F.lit(False))
    return (F.when(eff_type == "string", k == "STRING")
            .when(eff_type.isin("int64", "long"), as_int)
            .when(eff_type == "double", as_int | _is_number(k))
            .when(eff_type == "boolean", k == "BOOLEAN")
            .when(eff_type.isin(MICRO_TS, MILLI_TS), as_int & nonneg)
            .when(eff_type == ZONED_TS, (k == "STRING") & _zoned_ok(F.try_variant_get(val, "$", "string")))
            .otherwise(F.lit(True)))


def _verdict(kind: str, msg: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), msg.alias("msg"))


def field_verdict(name: Column, present: Column, val: Column, k: Column, eff_type: Column,
                  is_union: Column, union_has_null: Column, optional: Column) -> Column:
    """Verdict struct<kind,msg> for one field, or null when the field passes.

    ``val`` is the field's VARIANT value and ``k`` its precomputed kind; both
    must be cheap references (columns or lambda-struct fields), never the parse
    expression itself, as they are read many times.
    """
    is_null = F.is_variant_null(val)
    null_ok = F.when(is_union, union_has_null).otherwise(optional)
    num = F.try_variant_get(val, "$", "double")
    kind_map = F.create_map(*[F.lit(x) for kv in PY_TYPE_OF_KIND.items() for x in kv])
    price_bad_kind = F.coalesce(F.element_at(kind_map, F.regexp_extract(k, r"^([A-Z]+)", 1)),
                                F.lit("object"))
    price_verdict = (
        F.when(_is_number(k) | (k == "BOOLEAN"),
               F.when(~(num > 0), _verdict(SCHEMA_ERROR, F.lit(PRICE_MESSAGE))))
        .otherwise(_verdict(PROCESSING_ERROR, F.concat(
            F.lit("Processing error: '>' not supported between instances of '"),
            price_bad_kind, F.lit("' and 'int'")))))
    etype = F.try_variant_get(val, "$", "string")
    etype_verdict = F.when((k != "STRING") | ~etype.isin(*EVENT_TYPES),
                           _verdict(SCHEMA_ERROR, F.lit(EVENT_TYPE_MESSAGE)))
    bad_type = _verdict(SCHEMA_ERROR, F.concat(F.lit("Field "), name, F.lit(" has invalid type")))
    return (
        F.when(~present & ~optional,
               _verdict(SCHEMA_ERROR, F.concat(F.lit("Field "), name, F.lit(" is required"))))
        .when(~present, F.lit(None))
        .when(is_null, F.when(~null_ok, bad_type))
        .when(~_type_ok(val, k, eff_type), bad_type)
        .when(name == "price", price_verdict)
        .when(name == "event_type", etype_verdict)
    )


def _is_object(v: Column) -> Column:
    # casting to an empty struct succeeds only for JSON objects (no schema walk)
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


# Text that begins the payload of a record, and most known schemas of a plan.
PAYLOAD_KEY = '"payload":'
MAX_KNOWN = 64
_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
# What ``schema_of_variant`` calls the values that a declared type admits.
_INTEGERS = r"BIGINT|BOOLEAN|DECIMAL\((?:19|[2-9]\d),0\)"
_KINDS = {"string": "STRING", "int64": _INTEGERS, "long": _INTEGERS, "double": r"BIGINT|BOOLEAN|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT",
          "boolean": "BOOLEAN", MICRO_TS: _INTEGERS, MILLI_TS: _INTEGERS, ZONED_TS: "STRING"}


def _accepts(fields: list) -> tuple[str, list[tuple[str, str]]] | None:
    """For a known schema: the pattern of the payload types that no field check
    rejects, and the fields whose values must be looked at, with their types;
    None where the general checks have to decide."""
    rules = []
    for f in fields:
        types = f.get("type") if isinstance(f, dict) else None
        union = types if isinstance(types, list) else [types]
        name = (f.get("field") or f.get("name")) if isinstance(f, dict) else None
        if (not union or not all(isinstance(t, str) for t in union) or not isinstance(f.get("optional", False), bool)
                or not isinstance(name, str) or not isinstance(f.get("name", ""), str) or not _PLAIN_NAME.fullmatch(name)):
            return None
        own = f["name"] if f.get("name", "").startswith(DEBEZIUM_PREFIX) else next((t for t in union if t != "null"), union[0])
        optional = f.get("optional", False)
        nulls = "null" in types if isinstance(types, list) else optional
        if own not in _KINDS or name == "price" and own not in ("double", "long", "int64") or name == "event_type" and own != "string":
            return None
        rules.append((name, own, optional, nulls))
    if len({r[0] for r in rules}) < len(rules):
        return None
    parts = [rf"{name}: (?:{_KINDS[own]}{'|VOID' if nulls else ''})(?:, |(?=>$))" for name, own, _, nulls in sorted(rules)]
    shape = "^OBJECT<" + "".join(f"(?:{p})?" if r[2] else p for p, r in zip(parts, sorted(rules))) + ">$"
    return shape, [(name, own) for name, own, _, _ in rules if name in ("price", "event_type") or own in (MICRO_TS, MILLI_TS, ZONED_TS)]


def _value_ok(value: Column, name: str, own: str) -> Column:
    """Value check of a field whose type is right; null and absent values pass."""
    number = F.try_variant_get(value, "$", "double")
    checks = []
    if name == "price":
        checks.append(number > 0)
    if name == "event_type":
        checks.append(F.try_variant_get(value, "$", "string").isin(*EVENT_TYPES))
    if own in (MICRO_TS, MILLI_TS):
        checks.append(number >= 0)
    if own == ZONED_TS:
        checks.append(_zoned_ok(F.try_variant_get(value, "$", "string")))
    ok = checks[0]
    for more in checks[1:]:
        ok = ok & more
    return value.isNull() | F.is_variant_null(value) | F.coalesce(ok, F.lit(False))


def _field_value(payload: Column, name: str) -> Column:
    return F.try_variant_get(payload, f"$['{name}']", "variant")


def _heads(known: list[str]) -> list[tuple[str, list]]:
    """What records of the known schemas begin with, up to the payload's key, and
    the schemas' fields.  ``known`` are schemas (JSON texts), or whole heads as
    ``record_heads`` finds them."""
    out = []
    for text in known:
        if re.match(r'\s*\{\s*"schema"\s*:', text) and text.rstrip().endswith(","):
            heads, schema = [text], json.loads(text.rstrip()[:-1] + "}")["schema"]
        else:
            heads, schema = ['{"schema":' + text + ",", '{"schema": ' + text + ", "], json.loads(text)
        if isinstance(schema, dict) and isinstance(schema.get("fields"), list):
            out += [(head, schema["fields"]) for head in heads]
    return out


def record_heads(df: DataFrame, value: str = "value", limit: int = MAX_KNOWN) -> list[str]:
    """Texts before the payload's key that the records begin with, the ``limit``
    most frequent ones: one pass that cuts and counts, without a parse.  Only
    those that are a whole schema are returned."""
    head = F.substring_index(value, PAYLOAD_KEY, 1)
    closed = F.concat(F.rtrim(F.regexp_replace("head", r",\s*$", "")), F.lit("}"))
    found = (df.select(head.alias("head")).filter(F.col("head").rlike(r'^\{\s*"schema"\s*:') & F.col("head").rlike(r",\s*$"))
             .groupBy("head").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "head").limit(limit))
    whole = F.json_object_keys(F.when(F.try_parse_json(closed).isNotNull(), closed)) == F.array(F.lit("schema"))
    return [r.head for r in found.filter(whole).orderBy(F.desc("n"), "head").collect()]


def _envelopes(df: DataFrame, value: str, keep: list[str], known: list[tuple[str, list]]) -> DataFrame:
    """Each record's ``_payload``, own ``_fields``, the processing error ``_p``
    and which known schema it begins with, ``_which``; one parse a record."""
    text, which, tail = F.col(value), F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, (head, _) in reversed(list(enumerate(known))):
        begins = text.startswith(head + PAYLOAD_KEY)
        which = F.when(begins, F.lit(i)).otherwise(which)
        tail = F.when(begins, F.substring(text, len(head) + 1, 1 << 30)).otherwise(tail)
    cut = df.select(*keep, which.alias("_which"), F.when(which.isNull(), text).otherwise(F.concat(F.lit("{"), tail)).alias("_json"))
    v, own = F.col("_v"), F.col("_which").isNull()
    parsed = cut.select(*keep, "_which", F.try_parse_json("_json").alias("_v"))
    schema, payload = F.try_variant_get(v, "$.schema", "variant"), F.try_variant_get(v, "$.payload", "variant")
    fields = F.when(own, F.try_variant_get(v, "$.schema.fields", "array<variant>"))
    problem = (F.when(v.isNull(), F.lit("Processing error: malformed JSON"))
               # what was cut off is a schema: another one is a key given twice
               .when(~own & schema.isNotNull(), F.lit("Processing error: malformed JSON"))
               .when(~_is_object(v), F.lit("Processing error: record is not a JSON object"))
               .when(own & schema.isNull(), F.lit("Processing error: 'schema'"))
               .when(payload.isNull(), F.lit("Processing error: 'payload'"))
               .when(own & fields.isNull(), F.lit("Processing error: 'fields'"))
               .when(~_is_object(payload), F.lit("Processing error: payload is not an object")))
    return parsed.select(*keep, "_which", payload.alias("_payload"), fields.alias("_fields"), problem.alias("_p"))


def _finish(df: DataFrame, first: Column, clock, keep: list[str]) -> DataFrame:
    """Final verdict columns.

    They are emitted through a one-element ``inline`` generator: a predicate
    on a generator's output cannot be substituted into the upstream per-row
    expressions, so a later ``valid = 'VALID'`` routing filter stays above the
    validation instead of being inlined (and re-parsing the JSON per
    reference).  The generator is evaluated once per row and stays in codegen.
    """
    ts = F.lit(clock).cast("timestamp") if clock is not None else F.current_timestamp()
    out = df.select(*keep, "_p", first.alias("_f"))
    valid = out["_p"].isNull() & out["_f"].isNull()
    err_type = F.when(out["_p"].isNotNull(), F.lit(PROCESSING_ERROR)).otherwise(out["_f.kind"])
    verdict = F.struct(
        F.when(valid, F.lit(VALID)).otherwise(F.lit(INVALID)).alias("valid"),
        err_type.alias("error_type"),
        F.coalesce(out["_p"], out["_f.msg"]).alias("error_message"),
        # processed_at is stamped on VALID and PROCESSING_ERROR verdicts only
        F.when(valid | (err_type == PROCESSING_ERROR), ts).alias("processed_at"),
    )
    return out.select(*keep, F.inline(F.array(verdict)))


def _validate(df: DataFrame, value: str, keep: list[str], clock, known: list[tuple[str, list]], all_by: list | None) -> DataFrame:
    """Verdicts by known schemas and general checks; ``all_by`` are the fields
    that every record is held against in place of its own."""
    env = _envelopes(df, value, keep, known)
    chosen = [all_by] if all_by is not None else [fields for _, fields in known]
    tests = [_accepts(fields) for fields in chosen]
    typed = F.col("_p").isNull() & (F.lit(True) if all_by is not None else F.col("_which").isNotNull())
    env = env.select(*keep, "_which", "_payload", "_fields", "_p",
                     F.when(typed, F.schema_of_variant("_payload")).alias("_type") if any(tests) else F.lit(None).cast("string").alias("_type"))

    # accepted, or the fields that the general checks are to use
    accepted, fields = F.lit(False), F.col("_fields")
    for i, (test, own) in enumerate(zip(tests, chosen)):
        this = F.lit(True) if all_by is not None else F.col("_which") == i
        fields = F.when(this, F.try_variant_get(F.parse_json(F.lit(json.dumps(own))), "$", "array<variant>")).otherwise(fields)
        if test is not None:
            passes = F.coalesce(F.col("_type").rlike(test[0]), F.lit(False))
            for name, kind in test[1]:
                passes = passes & _value_ok(_field_value(F.col("_payload"), name), name, kind)
            accepted = F.when(this, passes).otherwise(accepted)
    staged = env.select(*keep, "_p", "_payload", fields.alias("_fields"), F.coalesce(accepted, F.lit(False)).alias("_ok"))
    general = ~F.col("_ok") & F.col("_p").isNull()
    staged = staged.select(*keep, "_p", F.when(general, F.col("_fields")).alias("_fields"),
                           F.when(general, F.try_variant_get("_payload", "$", "map<string,variant>")).alias("_pmap"))
    pmap = F.col("_pmap")

    def describe(f: Column) -> Column:
        # per-field facts, computed once per field (lambda-struct as a let binding)
        fld = F.try_variant_get(f, "$.field", "string")
        nm_attr = F.try_variant_get(f, "$.name", "string")
        name = F.when(fld.isNotNull() & (fld != ""), fld).otherwise(nm_attr)
        # an array-typed declaration is a union; a plain string is not
        tlist = F.try_variant_get(f, "$.type", "array<string>")
        is_union = tlist.isNotNull()
        member = F.coalesce(F.get(F.filter(tlist, lambda t: t != "null"), 0), F.get(tlist, 0))
        eff = (F.when(F.coalesce(nm_attr, F.lit("")).startswith(DEBEZIUM_PREFIX), nm_attr)
               .when(is_union, member)
               .otherwise(F.try_variant_get(f, "$.type", "string")))
        return F.struct(
            name.alias("name"), eff.alias("eff"), is_union.alias("is_union"),
            F.coalesce(F.array_contains(tlist, "null"), F.lit(False)).alias("union_null"),
            F.coalesce(F.try_variant_get(f, "$.optional", "boolean"), F.lit(False)).alias("optional"))

    described = staged.select(*keep, "_p", F.transform("_fields", describe).alias("_d"), "_pmap")

    def lookup(d: Column) -> Column:
        # a missing key is SQL NULL; a JSON null is a (non-null) VARIANT null
        return F.struct(d.alias("d"), F.try_element_at(pmap, d["name"]).alias("val"),
                        _kind(F.try_element_at(pmap, d["name"])).alias("k"))

    with_kind = described.select(*keep, "_p", F.transform("_d", lookup).alias("_lk"))

    def verdict(x: Column) -> Column:
        d = x["d"]
        return field_verdict(d["name"], x["val"].isNotNull(), x["val"], x["k"], d["eff"], d["is_union"],
                             d["union_null"], d["optional"])

    first = F.get(F.filter(F.transform("_lk", verdict), lambda x: x.isNotNull()), 0)
    return _finish(with_kind, first, clock, keep)


def validate_dynamic(df: DataFrame, value: str = "value", keep: list[str] | None = None,
                     clock: _dt.datetime | None = None, known: list[str] = ()) -> DataFrame:
    """Validate each record against the schema it carries.

    ``known`` are schemas (JSON texts) that most records are expected to carry, or
    heads of records from ``record_heads``; at most ``MAX_KNOWN``.  They make
    validation cheaper and change no verdict.
    """
    if len(known) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known schemas")
    keep = keep if keep is not None else [c for c in df.columns if c != value]
    return _validate(df, value, keep, clock, _heads(list(known)), None)


def validate_static(df: DataFrame, fields: list[dict], value: str = "value",
                    keep: list[str] | None = None, clock: _dt.datetime | None = None) -> DataFrame:
    """Validate every record against one schema known at plan time, whatever
    schema it carries."""
    keep = keep if keep is not None else [c for c in df.columns if c != value]
    return _validate(df, value, keep, clock, [], fields)


def validation_summary(verdicts: DataFrame) -> DataFrame:
    return (verdicts.groupBy("valid", "error_type", "error_message")
            .agg(F.count(F.lit(1)).alias("n")))


def route(verdicts: DataFrame, which: str) -> DataFrame:
    """Route by verdict: ``which`` is VALID or INVALID."""
    return verdicts.filter(F.col("valid") == which)


VERDICT_KEYS = ["valid", "error_message", "error_type"]


def record_with_verdict(df: DataFrame, value: str = "value", out: str = "record_json") -> DataFrame:
    """``out``: the record's text as published after validation.

    The verdict keys and ``metadata`` (with ``processed_at`` where it was
    stamped, beside what the record's own ``metadata`` holds) replace keys of
    these names; a processing error wraps the raw text as ``raw_data`` instead.
    The record is taken apart and written anew, so white space around or within
    it does not matter.
    """
    verdict = [F.col(c).alias(c) for c in VERDICT_KEYS]
    keep_nulls = {"ignoreNullFields": "false"}
    stamp = F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    wrapped = F.to_json(F.struct(*verdict, F.col(value).alias("raw_data"),
                                 F.struct(stamp.alias("processed_at")).alias("metadata")), keep_nulls)
    others = [c for c in df.columns if c != "_rec"]
    parsed = df.select(*others, F.try_parse_json(F.col(value)).alias("_rec"))
    taken = parsed.select(
        *others,
        F.map_filter(F.try_variant_get("_rec", "$", "map<string,variant>"),
                     lambda k, _: ~k.isin(*VERDICT_KEYS, "metadata")).alias("_members"),
        F.map_filter(F.try_variant_get("_rec", "$.metadata", "map<string,variant>"),
                     lambda k, _: k != "processed_at").alias("_meta"))

    def members(c: str) -> Column:
        # a map's JSON text without braces, with a comma if there is anything
        text = F.to_json(c)
        inner = F.substring(text, F.lit(2), F.length(text) - 2)
        return F.when(F.col(c).isNull() | (F.size(c) == 0), F.lit("")).otherwise(F.concat(inner, F.lit(",")))

    stamped = F.when(F.col("processed_at").isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"processed_at":"'), stamp, F.lit('"')))
    meta = F.concat(F.lit('"metadata":{'), F.rtrim(F.concat(members("_meta"), stamped), F.lit(",")), F.lit("}"))
    said = F.to_json(F.struct(*verdict), keep_nulls)
    text = F.concat(F.lit("{"), members("_members"), F.substring(said, F.lit(2), F.length(said) - 2), F.lit(","), meta, F.lit("}"))
    return taken.select(*others, once(F.when(F.col("error_type") == PROCESSING_ERROR, wrapped).otherwise(text).alias(out)))


def invalid_record_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Invalid-topic text of each record, as ``invalid_json``."""
    return record_with_verdict(df, value, "invalid_json")


def invalid_alerts(df: DataFrame, value: str = "value") -> DataFrame:
    """Alert projection of invalid-topic records.

    error_type defaults to UNKNOWN and error_message to 'No error message' when
    the key is missing; severity is HIGH when the type mentions 'schema',
    else MEDIUM.  Unparsable text, or an error_type that is not text, gives a
    PROCESSING_ERROR alert of LOW severity carrying the raw event.
    Staged like the validator: the text is parsed once per row, then the two
    keys are read once, then the alert columns are derived from those.
    """
    others = [c for c in df.columns if c != value]
    v = F.col("_v")
    parsed = df.select(*others, value, F.try_parse_json(F.col(value)).alias("_v"))
    keys = parsed.select(
        *others, value, (v.isNull() | ~_is_object(v)).alias("_bad_record"),
        F.try_variant_get(v, "$.error_type", "variant").alias("_et"),
        F.try_variant_get(v, "$.error_message", "variant").alias("_em"))
    et_v, em_v = F.col("_et"), F.col("_em")
    typed = keys.select(
        *others, value, "_bad_record", et_v.isNull().alias("_et_missing"),
        F.try_variant_get(et_v, "$", "string").alias("_et_s"), _kind(et_v).alias("_et_k"),
        em_v.isNull().alias("_em_missing"), F.is_variant_null(em_v).alias("_em_null"),
        F.coalesce(F.try_variant_get(em_v, "$", "string"), F.to_json(em_v)).alias("_em_s"))
    broken = F.col("_bad_record") | ~(F.col("_et_missing") | (F.col("_et_k") == "STRING"))
    et = F.coalesce(F.col("_et_s"), F.lit("UNKNOWN"))
    em = (F.when(F.col("_em_missing"), F.lit("No error message"))
          .when(F.col("_em_null"), F.lit(None).cast("string")).otherwise(F.col("_em_s")))
    return typed.select(
        *others,
        F.when(broken, F.lit(PROCESSING_ERROR)).otherwise(et).alias("error_type"),
        F.when(broken, F.lit("unparsable event")).otherwise(em).alias("error_message"),
        F.when(broken, F.lit("LOW"))
         .when(F.lower(et).contains("schema"), F.lit("HIGH")).otherwise(F.lit("MEDIUM")).alias("severity"),
        F.when(broken, F.col(value)).alias("raw_event"),
    )

from pyspark.sql import functions as F
import json

from tidemark.operators import validation as V

SCHEMA = {"type": "struct", "fields": [
    {"name": "event_time", "type": "string"},
    {"name": "event_type", "type": "string"},
    {"name": "product_id", "type": "long"},
    {"name": "brand", "type": ["null", "string"], "default": None},
    {"name": "price", "type": "double"},
    {"name": "user_id", "type": "long"},
    {"name": "note", "type": "string", "optional": True},
    {"name": "extra", "type": "uuid"},
]}
GOOD = {"event_time": "2019-10-01 02:30:12 UTC", "event_type": "view", "product_id": 5,
        "brand": "x", "price": 1.5, "user_id": 7, "note": "n", "extra": "abc"}


def env(payload=None, schema=SCHEMA, **changes):
    p = dict(GOOD if payload is None else payload)
    for k, v in changes.items():
        if v is KeyError:
            p.pop(k, None)
        else:
            p[k] = v
    return json.dumps({"schema": schema, "payload": p})


CASES = [
    ("valid", env(), None),
    ("missing required", env(user_id=KeyError), "Field user_id is required"),
    ("missing optional", env(note=KeyError), None),
    ("missing union key", env(brand=KeyError), "Field brand is required"),
    ("null in union", env(brand=None), None),
    ("null in non-union", env(user_id=None), "Field user_id has invalid type"),
    ("text for long", env(product_id="7"), "Field product_id has invalid type"),
    ("float for long", env(product_id=7.0), "Field product_id has invalid type"),
    ("bool for long", env(product_id=True), None),
    ("int for double", env(price=3), None),
    ("unknown type", env(extra=[1, 2]), None),
    ("price zero", env(price=0), "Price should be greater than 0"),
    ("price negative", env(price=-100), "Price should be greater than 0"),
    ("price cent", env(price=0.01), None),
    ("event type click", env(event_type="click"), V.EVENT_TYPE_MESSAGE),
    ("two faults", env(event_type="click", price=-100), V.EVENT_TYPE_MESSAGE),
    ("no schema", json.dumps({"payload": GOOD}), "Processing error: 'schema'"),
    ("no payload", json.dumps({"schema": SCHEMA}), "Processing error: 'payload'"),
    ("not json", "{this is not json", "Processing error: malformed JSON"),
]

CDC_SCHEMA = {"type": "struct", "fields": [
    {"field": "event_time", "type": "string", "optional": True, "name": "io.debezium.time.ZonedTimestamp"},
    {"field": "ts_us", "type": "int64", "optional": True, "name": "io.debezium.time.MicroTimestamp"},
    {"field": "price", "type": "double", "optional": True},
]}
CDC_CASES = [
    ("zoned utc", {"event_time": "2019-10-01T02:30:12.123Z", "ts_us": 5, "price": 2.0}, None),
    ("zoned offset", {"event_time": "2019-10-01 02:30:12+0100", "ts_us": 5, "price": 2.0}, None),
    ("zoned no zone", {"event_time": "2019-10-01 02:30:12", "ts_us": 5, "price": 2.0},
     "Field event_time has invalid type"),
    ("zoned bad day", {"event_time": "2019-02-30T02:30:12Z", "ts_us": 5, "price": 2.0},
     "Field event_time has invalid type"),
    ("negative micros", {"event_time": "2019-10-01T02:30:12Z", "ts_us": -1, "price": 2.0},
     "Field ts_us has invalid type"),
    ("optional absent", {"ts_us": 5}, None),
    ("optional null", {"event_time": None, "ts_us": 5, "price": 2.0}, None),
]


def _run(spark, rows, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, value string")
    return {r["id"]: r for r in fn(df).collect()}


def test_dynamic_cases(spark):
    out = _run(spark, [c[1] for c in CASES], lambda d: V.validate_dynamic(d, keep=["id"]))
    for i, (label, _, expect) in enumerate(CASES):
        r = out[i]
        assert r["error_message"] == expect, (label, r)
        assert r["valid"] == ("VALID" if expect is None else "INVALID"), label
        if expect and expect.startswith("Processing error"):
            assert r["error_type"] == "PROCESSING_ERROR"
            assert r["processed_at"] is not None
        elif expect:
            assert r["error_type"] == "SCHEMA_VALIDATION_ERROR"
            assert r["processed_at"] is None


def test_static_matches_dynamic(spark):
    rows = [c[1] for c in CASES]
    dyn = _run(spark, rows, lambda d: V.validate_dynamic(d, keep=["id"]))
    sta = _run(spark, rows, lambda d: V.validate_static(d, SCHEMA["fields"], keep=["id"]))
    for i in dyn:
        assert dyn[i]["error_message"] == sta[i]["error_message"], CASES[i][0]


def test_debezium_types(spark):
    rows = [json.dumps({"schema": CDC_SCHEMA, "payload": p}) for _, p, _ in CDC_CASES]
    out = _run(spark, rows, lambda d: V.validate_dynamic(d, keep=["id"]))
    for i, (label, _, expect) in enumerate(CDC_CASES):
        assert out[i]["error_message"] == expect, (label, out[i])


def test_text_price_is_processing_error(spark):
    schema = {"fields": [{"name": "price", "type": "string"}]}
    rows = [json.dumps({"schema": schema, "payload": {"price": "abc"}})]
    out = _run(spark, rows, lambda d: V.validate_dynamic(d, keep=["id"]))
    assert out[0]["error_type"] == "PROCESSING_ERROR"
    assert "'>' not supported between instances of 'str' and 'int'" in out[0]["error_message"]


def test_alerts(spark):
    rows = [json.dumps({"error_type": "SCHEMA_VALIDATION_ERROR", "error_message": "m"}),
            json.dumps({"error_message": "m"}),
            json.dumps({"error_type": "OTHER"}),
            json.dumps({"error_type": None}),
            "not json"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, value string")
    out = {r["id"]: r for r in V.invalid_alerts(df).collect()}
    assert (out[0]["error_type"], out[0]["severity"]) == ("SCHEMA_VALIDATION_ERROR", "HIGH")
    assert (out[1]["error_type"], out[1]["severity"]) == ("UNKNOWN", "MEDIUM")
    assert (out[2]["error_message"], out[2]["severity"]) == ("No error message", "MEDIUM")
    assert (out[3]["error_type"], out[3]["severity"]) == ("PROCESSING_ERROR", "LOW")
    assert out[4]["raw_event"] == "not json" and out[4]["severity"] == "LOW"


def test_verdict_is_written_into_any_layout_of_the_record(spark):
    import json
    record = {"schema": {"fields": [{"name": "price", "type": "double"}]}, "payload": {"price": -1.0},
              "valid": "OLD", "metadata": {"source": "x", "processed_at": "old"}}
    texts = [json.dumps(record), json.dumps(record) + "\n", "  " + json.dumps(record, indent=2) + "  \n", "{ broken"]
    df = V.validate_dynamic(spark.createDataFrame(list(enumerate(texts)), "i int, value string"), keep=["i", "value"],
                            clock=__import__("datetime").datetime(2024, 2, 1))
    out = V.invalid_record_json(df)
    for r in out.collect():
        said = json.loads(r.invalid_json, object_pairs_hook=lambda pairs: pairs)
        names = [k for k, _ in said]
        assert len(names) == len(set(names))
        said = json.loads(r.invalid_json)
        assert said["valid"] == "INVALID"
        if r.i < 3:
            assert said["error_type"] == "SCHEMA_VALIDATION_ERROR" and said["payload"] == {"price": -1.0}
            assert said["metadata"] == {"source": "x"}      # not stamped on schema errors
        else:
            assert said["raw_data"] == "{ broken" and said["metadata"]["processed_at"].startswith("2024-02-01T00:00:00")
    alerts = V.invalid_alerts(out.select("i", F.col("invalid_json").alias("value"))).collect()
    assert {(a.i < 3, a.error_type, a.severity) for a in alerts} == {
        (True, "SCHEMA_VALIDATION_ERROR", "HIGH"), (False, "PROCESSING_ERROR", "MEDIUM")}


def test_valid_records_carry_the_verdict_too(spark):
    import json
    text = json.dumps({"schema": {"fields": []}, "payload": {}})
    df = V.validate_dynamic(spark.createDataFrame([(text,)], "value string"), keep=["value"])
    said = json.loads(V.record_with_verdict(df).first().record_json)
    assert said["valid"] == "VALID" and said["error_type"] is None and said["metadata"]["processed_at"]


def test_raw_records_without_payload_are_their_own(spark):
    from tidemark.operators import bronze as B
    rows = ['{"event_time":"t","event_type":"view","product_id":1,"user_id":2}',
            '{"payload":{"event_time":"t","event_type":"view","product_id":1,"user_id":2}}',
            '{"payload":null,"event_time":"t","event_type":"","product_id":1,"user_id":2}',
            '{"payload":{"event_time":"t","event_type":"view","product_id":0,"user_id":2}}',
            '{"payload":{"event_time":"t","event_type":"view","product_id":"0","user_id":false}}', "[1]", "nope", ""]
    got = [(r.error, r.record_hash) for r in B.bronze_from_text(spark.createDataFrame([(x,) for x in rows], "value string")).collect()]
    assert [e for e, _ in got] == [None, None, "Missing event_type", "Missing product_id", "Missing user_id"] + [B.UNPARSABLE] * 3
    assert got[0][1] == got[1][1] and got[5][1] is None


def test_known_schemas_change_no_verdict(spark):
    import json
    event = {"fields": [{"name": "price", "type": "double"}, {"name": "note", "type": ["null", "string"]}]}
    other = {"fields": [{"field": "price", "type": "double", "optional": True}]}
    payloads = [{"price": 1.0, "note": None}, {"price": -1, "note": "x"}, {"note": "x"}, {"price": "1", "note": 3}, {"price": True}, {}]
    shuffled = {"fields": [dict(reversed(list(f.items()))) for f in event["fields"]]}      # keys in another order
    texts = [json.dumps({"schema": s, "payload": p}) for s in (event, shuffled, other, {"fields": []}, {}) for p in payloads] + ["{", "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = [[(r.i, r.valid, r.error_type, r.error_message) for r in V.validate_dynamic(df, keep=["i"], known=known).orderBy("i").collect()]
           for known in ([], [json.dumps(event)], [json.dumps(event, indent=1), json.dumps(other)])]
    assert got[0] == got[1] == got[2] and {x[1] for x in got[0]} == {"VALID", "INVALID"}


def test_every_verdict_is_that_of_the_general_checks(spark):
    """Payloads of all kinds under schemas of all kinds, in several layouts:
    nothing known, the schemas known, heads found in the batch, one schema for all."""
    import itertools
    import json
    values = ["KEEP_OUT", None, "view", "x", "", 5, -5, 0, 7.0, 1e300, 1.5, -0.0, True, False, [1], {"a": 1}, 12345678901234567890, 2**63 - 1,
              "2019-10-01T02:30:12Z", "2019-02-30T02:30:12Z"]
    types = ["string", "long", "int64", "double", "boolean", "uuid", ["null", "string"], ["null", "double"], ["long"], "null", [],
             {"type": "array"}, None]
    schemas = [{"fields": [{"name": n, "type": t} | extra]} for n in ("price", "event_type", "other", "odd name") for t in types
               for extra in ({}, {"optional": True}, {"optional": "yes"})]
    schemas += [{"fields": [{"field": "at", "name": f"io.debezium.time.{k}", "type": "int64", "optional": o}]}
                for k in ("MicroTimestamp", "Timestamp", "ZonedTimestamp", "Date") for o in (True, False)]
    schemas += [{"fields": [{"name": "a", "type": "long"}, {"name": "B", "type": "string", "optional": True}, {"name": "c", "type": "double"}]},
                {"fields": [{"name": "a", "type": "long"}, {"name": "a", "type": "string"}]}, {"fields": {}}, {"fields": [3]}, {"fields": []}, {}]
    texts = []
    for k, (schema, value) in enumerate(itertools.product(schemas, values)):
        name = next((f.get("field") or f["name"] for f in schema.get("fields") or [] if isinstance(f, dict)), "z")
        payload = {name: value, "B": "s", "c": 1, "extra": [1]} if k % 3 else {name: value}
        payload = {a: b for a, b in payload.items() if b != "KEEP_OUT"}
        seps = (",", ":") if k % 2 else (", ", ": ")
        texts.append(json.dumps({"schema": schema, "payload": payload}, separators=seps))
    one = json.dumps(schemas[0], separators=(",", ":"))
    texts += [t % one for t in ('{"schema":%s,"payload":{"price":"s"},"schema":{}}', '{"schema":%s,"payload":{"price":"s"},"payload":{}}',
                                '{"schema":%s,"payload":{"price":"s"}', '{"schema":%s,"payload":null}', '{"schema":%s,"payload":[1]}',
                                ' {"schema":%s,"payload":{"price":"s"}}', '{"schema":%s,"payload":{"price":"s"}} \n', '{"schema":%s,"payload":{"price":"s"}} x',
                                '{"schema":%s,"payload":{"price":NaN}}', '{"schema":%s,"payload":{"price":"s","price":"t"}}', '{"schema":%s,"payload" :{"price":"s"}}',
                                '{"payload":{"price":"s"},"schema":%s}', '{"schema":%s,"payload":{"payload":{"schema":1},"price":"s"},"more":"payload"}')]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string").repartition(4)
    run = lambda **k: [(r.i, r.valid, r.error_type, r.error_message) for r in V.validate_dynamic(df, keep=["i"], **k).orderBy("i").collect()]
    plain = run()
    assert {r[1] for r in plain} == {"VALID", "INVALID"} and len(plain) == len(texts)
    heads = V.record_heads(df)
    assert 30 < len(heads) <= V.MAX_KNOWN
    for known in (heads, [json.dumps(s, separators=(",", ":")) for s in schemas[:60]], [json.dumps(s) for s in schemas[60:120]],
                  [json.dumps(s) for s in schemas[120:]]):
        assert [a for a, b in zip(run(known=known), plain) if a != b] == []
    # the static form against one schema is the general form on records that carry it
    for schema in (schemas[0], schemas[9], schemas[-6]):
        carrying = df.filter(F.col("value").contains('"payload"')).select("i", F.regexp_replace(
            "value", r'^\{"schema": ?\{.*?\}, ?"payload":', '{"schema":' + json.dumps(schema).replace("\\", "\\\\").replace("$", "\\$") + ',"payload":').alias("value"))
        both = [[(r.i, r.error_message) for r in out.orderBy("i").collect()] for out in (
            V.validate_dynamic(carrying, keep=["i"]), V.validate_static(carrying.filter(F.col("value").contains('"schema"')), schema["fields"], keep=["i"]))]
        own = {i: t for i, t in carrying.collect()}
        alike = {i for i, t in own.items() if t.startswith('{"schema":' + json.dumps(schema) + ',"payload":')}
        assert alike and [x for x in both[0] if x[0] in alike] == [x for x in both[1] if x[0] in alike]


def test_too_many_known_schemas_are_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        V.validate_dynamic(spark.createDataFrame([("{}",)], "value string"), known=["{}"] * 65)

"""CDC change rows: unwrap, normalise, re-envelope and validate."""
import datetime as dt

from tidemark.operators import cdc as C
from tidemark.operators import validation as V

AFTER = ("event_time string, event_type string, product_id long, category_id long, category_code string, "
         "brand string, price double, user_id long, user_session string")


def _changes(spark):
    img = ("1704067207000000", "view", 1, 1000, "a.b", "x", -100.0, 7, "s")
    img2 = ("2024-01-01 00:00:08 UTC", "click", 2, 1001, None, None, 5.0, 8, "s")
    rows = [(1, 1, "c", img), (2, 1, "u", img), (3, 2, "c", img2), (4, 2, "d", None), (5, 2, None, None)]
    return spark.createDataFrame(rows, f"ingest_seq long, event_id long, op string, after struct<{AFTER}>")


def test_unwrap_drops_deletes_and_tombstones(spark):
    out = C.cdc_unwrap(_changes(spark)).collect()
    assert sorted((r["ingest_seq"], r["op"]) for r in out) == [(1, "c"), (2, "u"), (3, "c")]


def test_normalise_times_and_price(spark):
    out = {r["ingest_seq"]: r for r in C.cdc_normalise(C.cdc_unwrap(_changes(spark))).collect()}
    assert out[1]["event_time"] == dt.datetime(2024, 1, 1, 0, 0, 7)     # epoch micros
    assert out[3]["event_time"] == dt.datetime(2024, 1, 1, 0, 0, 8)     # text with UTC suffix
    assert out[1]["price"] == 0.0 and out[3]["price"] == 5.0


def test_cdc_envelope_validates_with_debezium_rules(spark):
    rows = C.cdc_normalise(C.cdc_unwrap(_changes(spark)))
    env = C.cdc_envelope(rows, keep=["ingest_seq"])
    out = {r["ingest_seq"]: r["error_message"] for r in V.validate_dynamic(env, keep=["ingest_seq"]).collect()}
    assert out[1] == "Price should be greater than 0"            # clamped to 0
    assert out[3] == V.EVENT_TYPE_MESSAGE                         # 'click' is not an allowed type


def test_normalise_iso_zoned_and_early_times(spark):
    texts = {"2019-10-01T02:30:12Z": (2, 30), "2019-10-01T02:30:12+00:00": (2, 30), "2019-10-01 02:30:12+02:00": (0, 30),
             "2019-10-01T02:30:12.250Z": (2, 30), "2019-10-01 02:30:12 UTC": (2, 30), "2019-10-01 02:30:12": (2, 30)}
    rows = [(t, 1.0) for t in texts] + [("-1000000", None), ("soon", -2.0), ("2019-10", 0.0), (None, None)]
    got = {r.t: r for r in C.cdc_normalise(spark.createDataFrame(rows, "event_time string, price double")
                                          .selectExpr("event_time as t", "event_time", "price")).collect()}
    for t, (hour, minute) in texts.items():
        assert (got[t].event_time.date(), got[t].event_time.hour, got[t].event_time.minute) == (dt.date(2019, 10, 1), hour, minute)
    assert got["-1000000"].event_time == dt.datetime(1969, 12, 31, 23, 59, 59) and got["-1000000"].price is None
    assert got["soon"].event_time is None and got["soon"].price == 0.0
    assert got["2019-10"].event_time is None and got[None].event_time is None

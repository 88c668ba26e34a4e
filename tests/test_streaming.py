"""Streaming shells equal their batch operators; restarts do not duplicate."""
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import validation as V
from tidemark.session import scratch_path
from tidemark.sources.testdata import raw_envelopes
from tidemark.streaming import jobs as J


def _p(spark, n):
    return scratch_path(spark, f"test-{n}-{uuid.uuid4().hex[:8]}")


def test_stream_routing_equals_batch_and_restart_is_idempotent(spark):
    src, valid, invalid, ck = (_p(spark, x) for x in ("src", "valid", "invalid", "ck"))
    env = raw_envelopes(spark, SF_SMALL).select("ingest_seq", "value")
    halves = [env.filter(F.col("ingest_seq") % 2 == i) for i in (0, 1)]
    halves[0].write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    J.start_validation_routing(J.file_source(spark, src, schema), valid, invalid, ck, ["ingest_seq"]).awaitTermination()
    # a second run with the same checkpoint only sees the new files
    halves[1].write.mode("append").parquet(src)
    J.start_validation_routing(J.file_source(spark, src, schema), valid, invalid, ck, ["ingest_seq"]).awaitTermination()
    J.start_validation_routing(J.file_source(spark, src, schema), valid, invalid, ck, ["ingest_seq"]).awaitTermination()
    got_valid = spark.read.parquet(valid)
    batch = V.validate_dynamic(env, keep=["ingest_seq"])
    assert got_valid.count() == got_valid.select("ingest_seq").distinct().count()
    assert sorted(r[0] for r in got_valid.select("ingest_seq").collect()) == \
        sorted(r[0] for r in batch.filter("valid = 'VALID'").select("ingest_seq").collect())
    assert spark.read.parquet(invalid).count() == batch.filter("valid = 'INVALID'").count()


def test_session_activity_stream(spark):
    import datetime as dt
    src, ck = _p(spark, "sess"), _p(spark, "sessck")
    rows = [("s1", dt.datetime(2024, 1, 1, 0, 0)), ("s1", dt.datetime(2024, 1, 1, 1, 0)),
            ("s1", dt.datetime(2024, 1, 3, 0, 0)), ("s2", dt.datetime(2024, 1, 5, 0, 0))]
    spark.createDataFrame(rows, "user_session string, event_timestamp timestamp").write.parquet(src)
    stream = J.file_source(spark, src, spark.read.parquet(src).schema)
    out = J.session_activity_stream(stream, gap="1 hour 30 minutes")
    q = (out.writeStream.outputMode("append").format("memory").queryName("sess_test")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["user_session"], r["activity_count"]) for r in spark.sql("select * from sess_test").collect())
    # append mode: a session is emitted once the watermark passes its end, so
    # the still-open last session (s2) is held in state
    assert got == [("s1", 1), ("s1", 2)]


def test_late_rows_are_counted_and_dropped(spark):
    import datetime as dt
    src, out, ck = _p(spark, "late"), _p(spark, "lateout"), _p(spark, "lateck")
    schema = "user_session string, event_timestamp timestamp"
    spark.createDataFrame([("s1", dt.datetime(2024, 1, 2, 0, 0))], schema).write.mode("append").parquet(src)
    rschema = spark.read.parquet(src).schema

    def run():
        stream = J.file_source(spark, src, rschema, max_files=1)
        q = (J.session_activity_stream(stream, gap="30 minutes").writeStream.outputMode("append")
             .format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    run()
    # a row two hours behind the watermark (watermark = 2024-01-02 00:00 - 1 minute)
    spark.createDataFrame([("s9", dt.datetime(2024, 1, 1, 22, 0))], schema).write.mode("append").parquet(src)
    q = run()
    assert J.late_rows(q) == 1
    assert J.processing_ms_per_1000(q) > 0


def test_session_counter_state_runs_and_expires(spark):
    import datetime as dt
    src, ck = _p(spark, "ctr"), _p(spark, "ctrck")
    schema = "user_session string, event_timestamp timestamp"
    batches = [[("s1", dt.datetime(2024, 1, 1, 0, 0)), ("s1", dt.datetime(2024, 1, 1, 0, 5))],
               [("s1", dt.datetime(2024, 1, 1, 1, 0)), ("s2", dt.datetime(2024, 1, 1, 1, 0))],
               [("s2", dt.datetime(2024, 1, 3, 0, 0))]]   # moves the watermark past s1 + 24 h
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    stream = J.file_source(spark, src, spark.read.parquet(src).schema, max_files=1)
    q = (J.session_counter_stream(stream).writeStream.outputMode("update").format("memory")
         .queryName("ctr_test").option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("select * from ctr_test").collect()
    s1 = sorted(r["activity_count"] for r in rows if r["user_session"] == "s1" and not r["expired"])
    assert s1 == [2, 3]
    assert max(r["activity_count"] for r in rows if r["user_session"] == "s2") == 2
    assert any(r["expired"] and r["user_session"] == "s1" for r in rows)


FEATURE_SCHEMA = "ingest_seq long, user_id long, product_id long, event_timestamp timestamp, price double"


def _features(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(i, u, 1, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), float(i)) for i, u, m in rows], FEATURE_SCHEMA)


def test_online_store_merges_batches_and_survives_replay(spark):
    path = _p(spark, "online")
    assert J.online_snapshot(spark, path) is None
    batches = [[(1, 1, 5), (2, 2, 1)], [(3, 1, 4), (4, 3, 0)], [(5, 2, 9), (6, 2, 9)]]
    latest = lambda: sorted((r.user_id, r.ingest_seq) for r in J.online_snapshot(spark, path).collect())
    for k, rows in enumerate(batches):
        J.online_merge(_features(spark, rows), path, k)
    want = [(1, 1), (2, 6), (3, 4)]      # the later event wins, not the later arrival
    assert latest() == want
    J.online_merge(_features(spark, batches[2]), path, 2)     # replayed
    assert latest() == want


def _files(spark, path):
    """Data files of a store with their times of change."""
    import os
    from urllib.parse import urlparse
    root = urlparse(path).path
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_merge_leaves_other_buckets_alone(spark):
    path = _p(spark, "buckets")
    store = J.online_store(spark, path, 8)
    assert len(store.merge(_features(spark, [(i, i, 1) for i in range(1, 200)]), 0)) == 8
    before, where = _files(spark, path), store.manifest()
    touched = store.merge(_features(spark, [(500, 7, 9), (501, 7, 3), (502, 1000, 1)]), 1)
    assert 1 <= len(touched) <= 2
    after = _files(spark, path)
    assert before.items() <= after.items()      # no file of the first merge was touched
    assert {b: v for b, v in store.manifest().items() if v == 0} == {b: 0 for b in where if b not in touched}
    rows = {r.user_id: r.ingest_seq for r in store.snapshot().collect()}
    assert len(rows) == 200 and rows[7] == 500 and rows[1000] == 502 and rows[8] == 8
    # the number of buckets is the first merge's, whatever a later caller asks for
    assert J.online_store(spark, path, 3).merge(_features(spark, [(600, 7, 10)]), 2) == [b for b in touched
                                                                                         if store.manifest()[b] == 2]
    assert sorted(r.ingest_seq for r in store.lookup(spark.createDataFrame([(7, 1), (9, 1), (5, 5)], "user_id long, product_id long")).collect()) == [9, 600]


def test_merge_that_broke_off_is_made_again(spark, monkeypatch):
    path = _p(spark, "crash")
    store = J.online_store(spark, path, 4)
    store.merge(_features(spark, [(1, 1, 1), (2, 2, 1)]), 0)
    rows = _features(spark, [(3, 1, 5), (4, 3, 0)])
    real = spark.createDataFrame

    def fail(*a, **k):
        raise RuntimeError("lost before the manifest")

    monkeypatch.setattr(type(spark), "createDataFrame", fail)
    try:
        store.merge(rows, 1)
        raise AssertionError("no failure")
    except RuntimeError:
        pass
    finally:
        monkeypatch.undo()
    assert spark.createDataFrame == real
    assert sorted((r.user_id, r.ingest_seq) for r in store.snapshot().collect()) == [(1, 1), (2, 2)]   # not in force
    store.merge(rows, 1)
    want = [(1, 3), (2, 2), (3, 4)]
    assert sorted((r.user_id, r.ingest_seq) for r in store.snapshot().collect()) == want
    files = _files(spark, path)
    assert store.merge(rows, 1) == [] and _files(spark, path) == files           # replay of a merge in force
    assert sorted((r.user_id, r.ingest_seq) for r in store.snapshot(1).collect()) == [(1, 1), (2, 2)]


def test_old_merges_are_cleaned_and_hot_keys_collapse(spark):
    path = _p(spark, "clean")
    store = J.online_store(spark, path, 2)
    for v in range(7):
        store.merge(_features(spark, [(100 * v + i, 1 + i % 2, v) for i in range(50)]), v)
    assert store.versions() == [4, 5, 6] and store.snapshot().count() == 2
    assert store.merge(_features(spark, []), 7) == [] and store.snapshot().count() == 2


def test_hourly_materialisation_saves_how_far_it_came(spark):
    import datetime as dt
    offline, online = _p(spark, "off"), _p(spark, "on")
    rows = _features(spark, [(1, 1, 5), (2, 1, 65), (3, 2, 70), (4, 2, 130)]).selectExpr("*", "0L as batch_id", "current_timestamp() as created_timestamp")
    rows.write.parquet(offline)
    seen = []
    for hour in (1, 2, 2, 3):
        J.materialise_hourly(spark, offline, online, dt.datetime(2024, 1, 1, hour))
        seen.append(sorted((r.user_id, r.ingest_seq) for r in J.online_snapshot(spark, online).collect()))
    assert seen == [[(1, 1)], [(1, 2), (2, 3)], [(1, 2), (2, 3)], [(1, 2), (2, 4)]]


def test_dedup_for_good_keeps_the_first_of_out_of_order_files(spark):
    src, out, ck = (_p(spark, x) for x in ("ddsrc", "ddout", "ddck"))
    schema = "ingest_seq long, record_hash string, event_type string"
    files = [[(7, "a", "late"), (5, "a", "first"), (6, "b", "x")], [(1, "a", "earlier number, later file"), (8, "c", "y")], [(9, "b", "again")]]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        J.start_dedup(J.file_source(spark, src, spark.read.parquet(src).schema), out, ck).awaitTermination()
    assert sorted((r.record_hash, r.ingest_seq) for r in spark.read.parquet(out).collect()) == [("a", 5), ("b", 6), ("c", 8)]


def test_filters_hold_every_key_and_few_others(spark):
    from tidemark.streaming import key_filters as KF
    keys = spark.range(3000).selectExpr("sha2(cast(id as string), 256) as k")
    rows = KF.build_filter(keys, "k", 4)
    assert rows.count() == 4
    asked = spark.range(0, 40_000).selectExpr("id", "sha2(cast(id as string), 256) as k").select(
        "id", KF._block(F.col("k"), 4).alias("block"), KF._places(F.col("k")).alias("p"))
    passed = {r.id for r in asked.join(rows, "block").filter(KF.holds(F.col("bitmap"), F.col("p"))).select("id").collect()}
    assert passed >= set(range(3000)) and len(passed) < 3010


def test_dedup_reads_only_batches_that_may_hold_its_keys(spark):
    src, out, ck = (_p(spark, x) for x in ("bfsrc", "bfout", "bfck"))
    schema = "ingest_seq long, record_hash string"
    files = [[(k * 100 + i, f"key{k}-{i}") for i in range(50)] for k in range(4)]
    files.append([(500, "key2-7"), (501, "new"), (502, None), (503, None)])
    files.append([(600, "new"), (601, "key2-7"), (602, None), (603, "key0-1")])
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        J.start_dedup(J.file_source(spark, src, spark.read.parquet(src).schema), out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 200 + 2 and got.filter("batch_id = 5").count() == 0
    asked = lambda *keys: J.dedup_candidates(spark.createDataFrame([(k,) for k in keys], "record_hash string"), out, "record_hash", 9)
    assert asked("key2-7") == [2] and asked("key1-3", "new") == [1, 4] and asked("none of them") == [] and asked(None) == [4]
    # a batch without a filter is read
    J._write_batch(spark.createDataFrame([(900, "elsewhere")], schema), out, 7)
    assert asked("none of them") == [7]


def test_rate_and_alert_streams(spark):
    import datetime as dt
    src, ck = _p(spark, "rate"), _p(spark, "rateck")
    t = dt.datetime(2024, 1, 1)
    rows = [(t, "VALID"), (t, "INVALID"), (t + dt.timedelta(milliseconds=900), "VALID"), (t + dt.timedelta(seconds=60), "VALID")]
    spark.createDataFrame(rows, "ts timestamp, valid string").write.parquet(src)
    q = (J.rate_stream(J.file_source(spark, src, spark.read.parquet(src).schema), "ts").writeStream.outputMode("append")
         .format("memory").queryName("rate_test").option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [tuple(r) for r in spark.sql("select * from rate_test").collect()] == [(t, 2, 1)]
    bad, ck2 = _p(spark, "bad"), _p(spark, "badck")
    spark.createDataFrame([('{"valid":"INVALID","error_type":"SCHEMA_VALIDATION_ERROR","error_message":"m"}',), ("x",)], "value string").write.parquet(bad)
    J.start_alert_stream(J.file_source(spark, bad, spark.read.parquet(bad).schema), ck2, sink="memory", trigger={"availableNow": True}).awaitTermination()
    assert sorted(r.severity for r in spark.sql("select * from alerts").collect()) == ["HIGH", "LOW"]


def test_lake_sink_layout(spark):
    import datetime as dt
    src, out, ck = _p(spark, "lsrc"), _p(spark, "lout"), _p(spark, "lck")
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 10), 1), (dt.datetime(2024, 1, 1, 6, 0), 2)], "ts timestamp, n int").write.parquet(src)
    J.start_lake_sink(J.file_source(spark, src, spark.read.parquet(src).schema), "ts", out, ck, trigger={"availableNow": True}).awaitTermination()
    assert sorted((r.hour, r.n) for r in spark.read.json(out).collect()) == [(5, 1), (6, 2)]


def test_session_counter_snapshot_counts_and_forgets(spark):
    import datetime as dt
    src, out, ck = _p(spark, "scsrc"), _p(spark, "scout"), _p(spark, "scck")
    t = dt.datetime(2024, 1, 1)
    seen = []
    for rows in ([("a", 0), ("a", 1), ("b", 0)], [("a", 20)], [("c", 40)]):
        spark.createDataFrame([(k, t + dt.timedelta(hours=h)) for k, h in rows], "user_session string, event_timestamp timestamp") \
            .write.mode("append").parquet(src)
        J.start_session_counter(J.file_source(spark, src, spark.read.parquet(src).schema), out, ck).awaitTermination()
        seen.append(sorted((r.user_session, r.activity_count) for r in J.live_sessions(spark, out).collect()))
    assert seen == [[("a", 2), ("b", 1)], [("a", 3), ("b", 1)], [("a", 3), ("c", 1)]]


def test_late_rows_go_to_their_own_table_and_replay_alike(spark):
    import datetime as dt
    src, ok, late, ck = (_p(spark, x) for x in ("lrsrc", "lrok", "lrlate", "lrck"))
    t = dt.datetime(2024, 1, 1)
    schema = "n long, event_timestamp timestamp"
    batches = [[(1, 0), (2, 60), (3, None)], [(4, 58), (5, 59), (6, 70), (7, 0), (8, None)], [(9, 69), (10, 68), (11, 100)]]
    for rows in batches:
        spark.createDataFrame([(n, None if m is None else t + dt.timedelta(minutes=m)) for n, m in rows], schema).coalesce(1).write.mode("append").parquet(src)
        J.start_late_split(J.file_source(spark, src, spark.read.parquet(src).schema), "event_timestamp", ok, late, ck).awaitTermination()
    on_time, behind = ({r.n for r in spark.read.parquet(p).collect()} for p in (ok, late))
    assert behind == {4, 7, 10} and on_time == set(range(1, 12)) - behind
    # the same batches again, with nothing committed: the saved watermarks decide
    J.start_late_split(J.file_source(spark, src, spark.read.parquet(src).schema, max_files=1), "event_timestamp", ok, late, _p(spark, "lrck2")).awaitTermination()
    assert {r.n for r in spark.read.parquet(late).collect()} == behind and spark.read.parquet(ok).count() == 8


def test_live_metrics_add_up_and_replace_replayed_batches(spark):
    src, valid, invalid, metrics = (_p(spark, x) for x in ("lmsrc", "lmv", "lmi", "lmm"))
    raw_envelopes(spark, SF_SMALL).select("ingest_seq", "value").repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):      # the second job replays all batches from the start
        J.start_validation_routing(J.file_source(spark, src, schema, max_files=1), valid, invalid, _p(spark, "lmck"), ["ingest_seq"],
                                   metrics_path=metrics).awaitTermination()
        m = J.live_metrics(spark, metrics).first()
        assert m.batches >= 3 and m.ms_per_1000 > 0
        assert (m.success_count, m.failure_count) == (spark.read.parquet(valid).count(), spark.read.parquet(invalid).count())
    one = J.live_metrics(spark, metrics, last=1).first()
    assert one.batches == 1 and one.success_count < m.success_count


def test_hot_session_reaches_the_state_as_few_rows_and_may_begin_anew(spark):
    import datetime as dt

    import pyarrow as pa
    t = dt.datetime(2024, 1, 1)
    batch = pa.RecordBatch.from_pydict({"user_session": ["hot"] * 9000 + ["b"], "ms": [*range(9000), 5]})
    assert sorted(map(tuple, (r.values() for b in J._combined([batch, batch.slice(0, 0)]) for r in b.to_pylist()))) == [("b", 1, 5), ("hot", 9000, 8999)]
    src, out, ck = _p(spark, "anew"), _p(spark, "anewout"), _p(spark, "anewck")
    schema = "user_session string, event_timestamp timestamp"
    loads = [[("a", 0), ("a", 1), (None, 1), ("z", None)], [("b", 48)], [("a", 2), ("c", 49)], [("d", 120)]]
    for rows in loads:
        spark.createDataFrame([(k, None if h is None else t + dt.timedelta(hours=h)) for k, h in rows], schema).write.mode("append").parquet(src)
        said = J.session_counter_stream(J.file_source(spark, src, spark.read.parquet(src).schema))
        (said.writeStream.outputMode("update").foreachBatch(lambda b, n: J._write_batch(b, out, n))
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    rows = [(r.user_session, r.activity_count, r.expired) for r in spark.read.parquet(out).collect()]
    # a is closed by b's time; its late row begins a session that closes at once
    assert sorted(x for x in rows if x[0] == "a") == [("a", 1, False), ("a", 1, True), ("a", 2, False), ("a", 2, True)]
    assert {x for x in rows if x[0] in "bcd"} == {("b", 1, False), ("b", 1, True), ("c", 1, False), ("c", 1, True), ("d", 1, False)}

"""The session counter keeps state by bucket, not by session."""
import datetime as dt
import uuid

import pytest

from tidemark.session import scratch_path
from tidemark.streaming import jobs as J

START = dt.datetime(2024, 1, 1)


@pytest.fixture()
def folders(spark):
    tag = uuid.uuid4().hex[:8]
    return [scratch_path(spark, f"{name}-{tag}") for name in ("src", "out", "ck")]


def _load(spark, folders, rows):
    """One load of (session, milliseconds) and a run of the counter; the run's query."""
    src, out, ck = folders
    schema = "user_session string, event_timestamp timestamp"
    spark.createDataFrame([(k, START + dt.timedelta(milliseconds=ms)) for k, ms in rows], schema).write.mode("append").parquet(src)
    said = J.session_counter_stream(J.file_source(spark, src, spark.read.parquet(src).schema))
    query = (said.writeStream.outputMode("update").foreachBatch(lambda b, n: J._write_batch(b, out, n))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def test_sessions_of_a_bucket_share_one_state_row_and_one_timer(spark, folders, monkeypatch):
    monkeypatch.setattr(J, "SESSION_BUCKETS", 4)
    hour = 3600 * 1000
    first = [(f"s{i}", i * 1000 + copy) for i in range(600) for copy in range(1 + i % 3)]
    again = [(f"s{i}", 20 * hour) for i in range(0, 600, 5)]
    far = [("last", 50 * hour)]
    held = []
    for rows in (first, again, far):
        query = _load(spark, folders, rows)
        held.append(max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]))
    # far fewer than the 600 sessions: values and timers of 4 buckets
    assert max(held) <= 4 * 4
    got = {}
    for r in spark.read.parquet(folders[1]).collect():
        got.setdefault(r.user_session, []).append((r.activity_count, r.last_seen, r.expired))
    assert len(got) == 601
    for i in range(600):
        n = 1 + i % 3
        last = START + dt.timedelta(milliseconds=i * 1000 + n - 1)
        want = [(n, last, False)]
        if i % 5 == 0:
            n, last = n + 1, START + dt.timedelta(hours=20)
            want.append((n, last, False))
        assert sorted(got[f"s{i}"]) == sorted([*want, (n, last, True)])
    assert got["last"] == [(1, START + dt.timedelta(hours=50), False)]


def test_a_session_closes_when_the_watermark_is_a_day_past_it(spark, folders):
    minute, day = 60_000, 24 * 3600 * 1000
    for rows in ([("a", 0), ("b", 1)], [("m", day + minute)], [("n", day + minute + 1)]):
        _load(spark, folders, rows)
    closed = {(r.user_session, r.batch_id) for r in spark.read.parquet(folders[1]).collect() if r.expired}
    assert {k for k, _ in closed} == {"a", "b"} and dict(closed)["a"] < dict(closed)["b"]

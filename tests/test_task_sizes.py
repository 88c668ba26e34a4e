"""Tasks and micro-batches stay bounded when the event table grows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import q_lake
from tidemark.plans.registry import queries
from tidemark.sources import testdata as TD
from tidemark.streaming import jobs as J


@pytest.fixture()
def tables(spark, tmp_path):
    """2,000 events that all name the same part, and that part."""
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i % 50, ("view", "click", "purchase")[i % 3], 1.5 * i + 1, '{"k": 1}')
            for i in range(2000)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    part = spark.createDataFrame([(1, "Brand#1", "STANDARD STEEL", "red box")], "p_partkey long, p_brand string, p_type string, p_name string")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def _rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def test_events_of_one_part_are_dealt_to_tasks_that_grow_with_the_table(spark, tables, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(TD, "bounded_broadcast", lambda df: df)
    try:
        before = sorted(TD.behaviour_events(spark, tables).collect())
        stored = TD.event_tasks(spark.read.parquet(f"{tables}/events.parquet")) * TD.EVENT_TASK_BYTES
        assert stored == TD.EVENT_TASK_BYTES   # a small table calls for no further tasks
        size = spark.read.parquet(f"{tables}/events.parquet")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        monkeypatch.setattr(TD, "EVENT_TASK_BYTES", int(str(size)) // 20)
        found = TD.behaviour_events(spark, tables)
        by_task = _rows_by_task(found)
        assert len(by_task) >= 20 and max(by_task) < 2100 / 10
        assert sorted(found.collect()) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_bound_a_task_however_few_bytes_they_take(spark, tables, monkeypatch):
    before = sorted(TD.behaviour_events(spark, tables).collect())
    monkeypatch.setattr(TD, "EVENT_TASK_ROWS", 100, raising=False)
    found = TD.behaviour_events(spark, tables)
    by_task = _rows_by_task(found)
    assert len(by_task) >= 20 and max(by_task) < 2100 / 10
    assert sorted(found.collect()) == before


def test_events_are_dealt_before_anything_is_derived_from_them(spark, tables, monkeypatch):
    before = sorted(TD.behaviour_events(spark, tables).collect())
    monkeypatch.setattr(TD, "EVENT_TASK_ROWS", 100)
    found = TD.behaviour_events(spark, tables)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    # the raw rows, before the JSON property is taken out, and what is joined
    assert plan.count("RoundRobinPartitioning(20)") == plan.count("RoundRobinPartitioning") == 2
    raw = plan.rindex("RoundRobinPartitioning(20)")
    assert plan.index("get_json_object") < raw < plan.index("FileScan parquet [event_id")
    assert sorted(found.collect()) == before


def test_routing_batches_are_bounded_and_route_the_same_rows(spark, tables, monkeypatch):
    whole = sorted(r.ingest_seq for r in queries()["route_valid"](spark, tables).collect())
    monkeypatch.setattr(q_lake, "FILE_RECORDS", 100)
    monkeypatch.setattr(q_lake, "ROUTING_BATCH", 30_000)
    valid, invalid = q_lake._stream_validated(spark, tables)
    assert len(J.batch_numbers(spark, valid)) > 3
    assert sorted(r.ingest_seq for r in spark.read.parquet(valid).collect()) == whole
    assert spark.read.parquet(valid).count() + spark.read.parquet(invalid).count() == 2100


def test_metrics_over_bounded_files(spark, tables, monkeypatch):
    monkeypatch.setattr(q_lake, "FILE_RECORDS", 100)
    src = q_lake._record_files(spark, tables, "few", 3)
    held = spark.read.parquet(src).groupBy(F.input_file_name()).count()
    assert held.agg(F.max("count")).first()[0] <= 100
    seen = []
    monkeypatch.setattr(J, "live_metrics", lambda s, path, old=J.live_metrics: seen.append(J.batch_numbers(s, path)) or old(s, path))
    row = queries()["stream_metrics"](spark, tables).first()
    assert row.success_count + row.failure_count == 2100 and row.has_time
    assert len(seen[0]) >= 3

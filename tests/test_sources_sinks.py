"""Lake scans, CSV extract, exports, views, streaming metrics."""
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import sinks as K
from tidemark.operators.envelope import EVENT_STRUCT
from tidemark.session import materialize, scratch_path
from tidemark.sources import lake as L
from tidemark.sources.testdata import behaviour_events


def _p(spark, n):
    return scratch_path(spark, f"test-{n}-{uuid.uuid4().hex[:8]}")


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_multiline_json_object_array_and_corrupt(spark):
    d = _local(_p(spark, "mljson"))
    os.makedirs(d, exist_ok=True)
    rec = {"event_time": "2024-01-01 00:00:00 UTC", "event_type": "view", "product_id": 1,
           "category_id": 2, "category_code": None, "brand": "b", "price": 3.5, "user_id": 4,
           "user_session": "s"}
    with open(f"{d}/one.json", "w") as f:
        json.dump(rec, f, indent=2)
    with open(f"{d}/many.json", "w") as f:
        json.dump([dict(rec, user_id=i) for i in range(5, 8)], f, indent=2)
    with open(f"{d}/bad.json", "w") as f:
        f.write("{ not json")
    scan = L.lake_json_scan(spark, d, EVENT_STRUCT, multiline=True)
    rows = scan.select("user_id", F.col(L.CORRUPT).isNotNull().alias("bad"), "file_path").collect()
    ok = sorted(r["user_id"] for r in rows if not r["bad"])
    assert ok == [4, 5, 6, 7]
    assert sum(r["bad"] for r in rows) == 1
    open(f"{d}/empty.json", "w").close()
    listing = L.lake_files(spark, d)
    stats = {os.path.basename(r["file_path"]): r for r in L.ingest_stats(materialize(scan), listing).collect()}
    assert stats["bad.json"]["status"] == "error" and stats["many.json"]["records"] == 3
    assert stats["empty.json"]["status"] == "error" and stats["empty.json"]["bytes"] == 0
    totals = L.ingest_totals(L.ingest_stats(materialize(scan), listing), 2).first()
    assert (totals.processed_files, totals.error_files, totals.skipped_files) == (2, 2, 2)
    assert (totals.records, totals.error_records) == (4, 1) and totals.bytes > 0


def test_incremental_runs_read_new_files_and_retry_bad_ones(spark):
    d, log = _local(_p(spark, "runs")), _p(spark, "runlog")
    os.makedirs(d)
    with pytest.raises(ValueError, match="no files"):
        L.ingest_new(spark, d, EVENT_STRUCT, log)

    def put(name, *users):
        with open(f"{d}/{name}", "w") as f:
            f.write("".join(json.dumps({"user_id": u}) + "\n" for u in users) if users else "{ not json")

    def run():
        rows, totals = L.ingest_new(spark, d, EVENT_STRUCT, log)
        t = totals.first()
        return (sorted(r.user_id for r in rows.filter("user_id is not null").collect()),
                (t.processed_files, t.error_files, t.skipped_files), rows)

    put("bad.json")
    with pytest.raises(ValueError, match="no valid JSON"):
        L.ingest_new(spark, d, EVENT_STRUCT, log)
    put("a.json", 1, 2)
    put("b.json", 3)
    assert run()[:2] == ([1, 2, 3], (2, 1, 0))
    put("c.json", 4)
    assert run()[:2] == ([4], (1, 1, 2))      # bad.json is tried again, a and b are not opened
    put("bad.json", 9)                          # mended in place
    assert run()[:2] == ([9], (1, 0, 3))
    assert run()[:2] == ([], (0, 0, 4))


def test_incremental_runs_take_each_file_once(spark):
    """Batches of one file; a run takes what the stream's log does not hold."""
    d, state = _local(_p(spark, "opened")), _p(spark, "openedlog")
    os.makedirs(f"{d}/day=2024-01-01")
    seen = []
    for names in (["a.json", "day=2024-01-01/b.json"], ["c.json"], []):
        for name in names:
            with open(f"{d}/{name}", "w") as f:
                f.write('{"user_id": 1}\n')
        rows, _ = L.ingest_new(spark, d, EVENT_STRUCT, state, max_files=1)
        seen.append(sorted(os.path.basename(r.file_path) for r in rows.select("file_path").collect()))
    assert seen == [["a.json", "b.json"], ["c.json"], []]
    assert L.source_log(spark, f"{state}/checkpoint").count() == 3
    assert spark.read.parquet(f"{state}/files").groupBy("file_path").count().filter("count > 1").count() == 0


def test_run_that_broke_off_goes_on(spark, monkeypatch):
    """The stream has taken its files and the run's counters were not written."""
    d, state = _local(_p(spark, "broken")), _p(spark, "brokenlog")
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        f.write('{"user_id": 1}\n{"user_id": 2}\n')

    def fail(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "ingest_stats", fail)
    with pytest.raises(RuntimeError):
        L.ingest_new(spark, d, EVENT_STRUCT, state)
    monkeypatch.undo()
    with open(f"{d}/b.json", "w") as f:
        f.write('{"user_id": 3}\n')
    rows, totals = L.ingest_new(spark, d, EVENT_STRUCT, state)
    assert sorted(r.user_id for r in rows.collect()) == [1, 2, 3]
    assert (totals.first().processed_files, totals.first().records) == (2, 3)


def test_csv_extract_with_row_cap(spark):
    src, dst = _p(spark, "csv"), _p(spark, "csvpq")
    ev = behaviour_events(spark, SF_SMALL).select("ingest_seq", "event_type", "price")
    ev.write.option("header", True).option("compression", "gzip").csv(src)
    L.csv_to_parquet(spark, src, dst, schema=ev.schema, row_cap=50)
    assert spark.read.parquet(dst).count() == 50
    L.csv_to_parquet(spark, src, dst, schema=ev.schema)      # no cap unless asked for
    assert spark.read.parquet(dst).count() == ev.count()


def test_existing_inputs(spark):
    real = _p(spark, "exists")
    spark.range(3).write.parquet(real)
    assert L.existing_inputs(spark, [real, real + "-missing"]) == [real]


def test_exports_and_views(spark):
    out = _p(spark, "head")
    head = behaviour_events(spark, SF_SMALL).orderBy("ingest_seq").limit(20)
    K.export(head, out, fmt="csv", single_file=True)
    assert spark.read.option("header", True).csv(out).count() == 20
    ok = K.register_views(spark, {"tm_head_view": head})
    assert ok == {"tm_head_view": True}
    m = spark.createDataFrame([("brand", "a", 0), ("brand", "b", 1)], "feature string, value string, idx int")
    mp = _p(spark, "mapping")
    K.mapping_json_lines(m, mp)
    assert sorted(r["idx"] for r in spark.read.json(mp).collect()) == [0, 1]


def test_metrics_and_schema_only(spark):
    path = _p(spark, "metrics")
    K.metrics_json(spark.createDataFrame([(0.5, 3)], "rmse double, n long"), path)
    assert [tuple(r) for r in spark.read.json(path).select("rmse", "n").collect()] == [(0.5, 3)]
    assert L.schema_only(spark.range(1)).fieldNames() == ["id"]


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    from tidemark import session as S
    assert S.is_local("local[8]") and S.is_local("local") and not S.is_local("local-cluster[2,1,512]") and not S.is_local("yarn")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(spark)


def test_measured_bytes_sees_long_keys(spark):
    from tidemark.functions.joins import measured_bytes
    assert measured_bytes(spark.createDataFrame([("x" * 10_240,), (None,)], "k string")) > 10_240

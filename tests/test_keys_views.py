"""Generated keys over several loads; tables and views in the catalog."""
import uuid

import pytest

from tidemark.operators import distinct as D
from tidemark.operators import keys as K
from tidemark.operators import sinks as S
from tidemark.session import scratch_path


def _p(spark, n):
    return scratch_path(spark, f"test-{n}-{uuid.uuid4().hex[:8]}")


def _rows(spark, a, b):
    return spark.range(a, b).selectExpr("id % 97 as file", "id as position", "'x' as _note").repartition(5)


def test_keys_are_gapless_in_order_and_go_on(spark):
    path = _p(spark, "keys")
    assert K.last_key(spark, path) == 0
    assert K.load_with_keys(_rows(spark, 0, 1000), path, 0, ["file", "position"], "sk")
    first = {(r.file, r.position): r.sk for r in K.keyed_rows(spark, path).collect()}
    assert [first[k] for k in sorted(first)] == list(range(1, 1001))
    assert K.load_with_keys(_rows(spark, 1000, 1000), path, 1, ["file", "position"], "sk")       # an empty load
    assert K.load_with_keys(_rows(spark, 2000, 2500), path, 2, ["file", "position"], "sk")
    assert not K.load_with_keys(_rows(spark, 2000, 2500), path, 2, ["file", "position"], "sk")   # replay
    rows = {(r.file, r.position): r.sk for r in K.keyed_rows(spark, path).collect()}
    assert rows.items() >= first.items() and sorted(rows.values()) == list(range(1, 1501))
    assert K.last_key(spark, path) == 1500 and K.last_key(spark, path, 2) == 1000


def test_load_that_broke_off_gives_its_keys_again(spark, monkeypatch):
    path = _p(spark, "brokenkeys")
    K.load_with_keys(_rows(spark, 0, 10), path, 0, ["position"], "sk")

    def fail(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(type(spark), "createDataFrame", fail)
    with pytest.raises(RuntimeError):
        K.load_with_keys(_rows(spark, 10, 15), path, 1, ["position"], "sk")
    monkeypatch.undo()
    assert K.keyed_rows(spark, path).count() == 10 and K.last_key(spark, path) == 10
    K.load_with_keys(_rows(spark, 10, 17), path, 1, ["position"], "sk")
    assert sorted(r.sk for r in K.keyed_rows(spark, path).collect()) == list(range(1, 18))


def test_views_are_found_by_other_sessions_and_replaced(spark):
    db, path = f"test_{uuid.uuid4().hex[:8]}", _p(spark, "published")
    S.publish_tables(spark, db, {"t": spark.range(3)}, path)
    views = {"v": "SELECT count(*) AS n FROM {db}.t"}
    assert S.publish_views(spark, db, views) == {"v": False}
    other = spark.newSession()
    assert other.catalog.tableExists(f"{db}.v") and other.table(f"{db}.v").first().n == 3
    S.publish_tables(spark, db, {"t": spark.range(5)}, path)
    assert S.publish_views(spark, db, {"v": "SELECT sum(id) AS n FROM {db}.t"}) == {"v": True}
    other.catalog.refreshTable(f"{db}.t")
    assert other.table(f"{db}.v").first().n == 10


def test_distinct_counts_merge_over_runs(spark):
    path = _p(spark, "distinct")
    runs = [spark.range(0, 50_000).selectExpr("id % 40000 as a", "cast(id % 7 as string) as b"),
            spark.range(0, 60_000).selectExpr("id + 39990 as a", "if(id % 3 = 0, null, concat('x', id % 9)) as b"),
            spark.range(0).selectExpr("id as a", "'' as b")]
    for version, rows in enumerate(runs + runs[2:] + runs[1:2]):
        D.add_run(rows, path, min(version, 3), ["a", "b"])
    both = runs[0].unionByName(runs[1]).selectExpr("count(distinct a)", "count(distinct b)").first()
    assert tuple(D.distinct_counts(spark, path, ["a", "b"]).first()) == tuple(both)
    assert tuple(D.distinct_counts(spark, path, ["a", "b"], versions=[0]).first()) == (40_000, 7)
    assert tuple(D.distinct_counts(spark, path, ["a", "b"], versions=[2]).first()) == (0, 0)
    plan = D.distinct_counts(spark, path, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan

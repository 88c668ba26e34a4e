"""Plan-shape guards for the scale properties the design relies on."""
import re

from conftest import SF_SMALL

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parsed_once_under_routing_filters(spark):
    # a filter on the verdict / decoded fields must not re-inline the parse
    # one parse per step of a text: the envelope by the validator; for alerts
    # also the record into which the verdict is written, and the result
    for name, parses in (("route_valid", 1), ("validate_schema_static", 1), ("validate_schema_dynamic", 1),
                         ("invalid_alerts", 3)):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert len(re.findall(r"parseJson", plan)) == parses, name


def test_first_and_latest_per_key_aggregate_before_shuffle(spark):
    plan = _plan(E.queries()["dedup_first"](spark, SF_SMALL))
    assert "partial_min_by" in plan
    plan = _plan(E.queries()["latest_features"](spark, SF_SMALL))
    assert "partial_max_by" in plan


def test_star_join_broadcasts_measured_dimensions(spark):
    plan = _plan(E.queries()["vw_category_performance"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_lake_scan_prunes_columns(spark):
    plan = _plan(E.queries()["latency_histogram"](spark, SF_SMALL))
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and set(x.split(":")[0] for x in m.group(1).split(",")) == {"l_extendedprice", "l_returnflag", "l_shipdate"}


def test_no_python_in_category_index(spark):
    plan = _plan(E.queries()["category_mapping"](spark, SF_SMALL))
    assert "PythonRDD" not in plan and "BatchEvalPython" not in plan


def test_derived_tables_scan_events_once(spark):
    for name in ("scan_events", "cdc_unwrap", "validation_rate_1s"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert len(re.findall(r"FileScan parquet [^\n]*/events\.parquet", plan)) == 1, name


def test_large_vocabulary_leaves_small_ones_broadcast(spark):
    from tidemark.operators import training as TR
    rows = [(f"brand{i}", i % 7, "a", "b", 1.0, 1, 0) for i in range(400)]
    df = spark.createDataFrame(rows, "brand string, event_weekday int, category_code_level1 string, "
                                     "category_code_level2 string, price double, activity_count long, is_purchased int")
    plan = _plan(TR.encode_categories(df, TR.category_mapping(df), max_bytes=4000))
    assert plan.count("BroadcastHashJoin") == 3 and plan.count("SortMergeJoin") == 1

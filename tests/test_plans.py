"""Physical-plan shape: the scale properties checked with explain() stay true."""

import re

from tests.conftest import SF001
from verdant.operators.decode import accepted, decode_events
from verdant.operators.windows import window_metrics
from verdant.plans import catalog
from verdant.plans.panels import PANELS, panel
from verdant.sinks.publish import to_keyed_records
from verdant.sources.testdata import sensor_events


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_window_metrics_two_phase_and_pruned(spark):
    plan = _plan(window_metrics(sensor_events(spark, SF001)))
    assert "partial_avg" in plan and "partial_count" in plan
    assert "Exchange hashpartitioning(window" in plan
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in scan.split(",")) == {"ts", "user_id", "value", "props"}
    assert "PushedFilters: [IsNotNull(ts)]" in plan


def test_decode_parses_json_once(spark):
    ev = sensor_events(spark, SF001, with_text_time=True)
    df = window_metrics(accepted(decode_events(to_keyed_records(ev))))
    assert _optimized(df).count("from_json(") == 1
    assert "Generate inline" in _plan(df)


def _scan(df, n=0) -> str:
    return [line for line in df._jdf.queryExecution().toString().split("== Physical Plan ==")[1].splitlines() if "FileScan" in line][n]


def test_panel_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        scan = _scan(catalog.queries()["panel_01"](spark, SF001))
        assert "GreaterThan(window_start,2024-01-29" in scan and "LessThan(window_start,2024-01-30" in scan
        assert "In(greenhouse_id, [gh-0,gh-1])" in scan
        # over raw events the range is on the event time
        scan = _scan(catalog.q_panel_01_raw(spark, SF001))
        assert "GreaterThan(ts,2024-01-28T23:59:59.999999)" in scan and "LessThan(ts,2024-01-30T00:00)" in scan
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_ordinals_have_no_one_task_window_over_splits(spark):
    plan = _plan(catalog.q_row_ordinals(spark, SF001))
    # split offsets come summed from the count pass: rows look them up and are neither shuffled nor gathered
    assert "SinglePartition" not in plan and "Window" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_latest_view_is_one_shuffle_on_the_key(spark):
    plan = _plan(catalog.q_upsert_latest(spark, SF001))
    assert "row_number()" in plan and plan.count("Exchange hashpartitioning(data_source") == 1

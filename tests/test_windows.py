"""Tumbling-window aggregation (AGG1-AGG5)."""

import datetime as dt

from verdant.operators.windows import window_metrics, window_metrics_by_source


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "greenhouse_id string, data_source string, source_topic string, temperature_c double, "
              "humidity_pct double, co2_ppm double, event_time timestamp")


def test_avg_skips_nulls_count_counts_rows(spark):
    t = dt.datetime(2026, 1, 1, 12, 1)
    df = _events(spark, [
        ("gh", "s", "a", 10.0, None, 400.0, t),
        ("gh", "s", "a", None, 50.0, 500.0, t + dt.timedelta(minutes=3)),
        ("gh", "s", "a", 30.0, 70.0, None, t + dt.timedelta(minutes=4)),  # 12:05 -> next window
        ("gh", "s", "a", 99.0, 99.0, 99.0, None),  # no time -> dropped
    ])
    out = {r["window_start"]: r for r in window_metrics(df).collect()}
    w0 = out[dt.datetime(2026, 1, 1, 12, 0)]
    assert w0["event_count"] == 2 and w0["avg_temperature"] == 10.0 and w0["avg_humidity"] == 50.0
    assert w0["avg_co2"] == 450.0 and w0["window_end"] == dt.datetime(2026, 1, 1, 12, 5)
    w1 = out[dt.datetime(2026, 1, 1, 12, 5)]
    assert w1["event_count"] == 1 and w1["avg_co2"] is None
    assert len(out) == 2


def test_all_null_metric_stays_null(spark):
    t = dt.datetime(2026, 1, 1, 12, 1)
    df = _events(spark, [("gh", "s", "a", None, None, None, t)])
    r = window_metrics(df).first()
    assert r["avg_temperature"] is None and r["event_count"] == 1


def test_by_source_counts_sum_to_greenhouse_counts(spark):
    from tests.conftest import SF001
    from verdant.sources.testdata import sensor_events
    ev = sensor_events(spark, SF001)
    a = window_metrics(ev).groupBy().sum("event_count").first()[0]
    b = window_metrics_by_source(ev).groupBy().sum("event_count").first()[0]
    assert a == b == ev.count()
    cols = window_metrics_by_source(ev).columns
    assert cols[:3] == ["data_source", "source_topic", "greenhouse_id"]


def test_batch_job_writes_table(spark, workdir):
    import datetime as dt
    from verdant.plans.batch_job import run_batch_job
    from verdant.schemas import BATCH_EVENT_SCHEMA
    rows = [("s1", "gh-a", "north", 20.0, 50.0, 400.0, 30.0, 1000.0, 1767225599999),
            ("s2", "gh-a", "south", 22.0, 52.0, 420.0, 30.0, 1000.0, 1767225600000)]
    df = spark.createDataFrame(rows, BATCH_EVENT_SCHEMA)
    table = run_batch_job(spark, df, workdir + "/tables", batch_id=0, millis_col="event_ts")
    got = sorted((r["window_start"], r["event_count"]) for r in table.latest(spark).collect())
    assert got == [(dt.datetime(2025, 12, 31, 23, 55), 1), (dt.datetime(2026, 1, 1, 0, 0), 1)]


def test_legacy_events_without_source_fields_form_null_group(spark):
    from verdant.operators.decode import accepted, decode_events
    raw = spark.createDataFrame(
        [('{"event_id":1,"greenhouse_id":"alm-aemet","temperature_c":20.0,"event_ts":"2026-01-01T12:00:00+00:00"}',),
         ('{"event_id":2,"greenhouse_id":"alm-nijar","temperature_c":22.0,"data_source":"csv",'
          '"source_topic":"greenhouse.sensors.csv","event_ts":"2026-01-01T12:01:00+00:00"}',)], "value string")
    rows = window_metrics_by_source(accepted(decode_events(raw))).collect()
    got = sorted((r["data_source"] or "", r["greenhouse_id"], r["event_count"]) for r in rows)
    assert got == [("", "alm-aemet", 1), ("csv", "alm-nijar", 1)]


def test_single_scan_backfill_matches_direct_aggregates(spark, workdir):
    from tests.conftest import SF001
    from verdant.plans.batch_job import run_batch_tables
    from verdant.plans.catalog import _round_doubles
    from verdant.sources.testdata import sensor_events
    ev = sensor_events(spark, SF001)
    tables = run_batch_tables(spark, ev, workdir + "/tables")
    for name, direct in (("window_metrics", window_metrics(ev)), ("window_metrics_by_source", window_metrics_by_source(ev))):
        got = _round_doubles(tables[name].latest(spark))
        exp = _round_doubles(direct).select(*got.columns)
        assert got.count() == exp.count()
        assert got.exceptAll(exp).count() == 0


def test_by_source_rollup_equals_greenhouse_counts_per_window(spark):
    from pyspark.sql import functions as F
    from tests.conftest import SF001
    from verdant.sources.testdata import sensor_events
    ev = sensor_events(spark, SF001)
    a = window_metrics(ev).select("greenhouse_id", "window_start", "event_count")
    b = (window_metrics_by_source(ev).groupBy("greenhouse_id", "window_start")
         .agg(F.sum("event_count").alias("event_count")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_backfill_of_batch_rows_never_outranks_the_stream(spark, workdir):
    import datetime as dt
    from verdant.plans.batch_job import run_batch_tables
    from verdant.schemas import BATCH_EVENT_SCHEMA, WINDOW_METRICS
    from verdant.sinks.upsert import UpsertTable
    t0 = dt.datetime(2026, 1, 1, 12, 0)
    live = UpsertTable(workdir + "/tables/window_metrics", WINDOW_METRICS)
    live.write_batch(spark.createDataFrame([("gh-a", t0, t0 + dt.timedelta(minutes=5), 9.0, 9.0, 9.0, 9)],
                                           WINDOW_METRICS.schema), 0)
    rows = [("s1", "gh-a", "north", 20.0, 50.0, 400.0, 30.0, 1000.0, 1767268800000),   # 12:00 window
            ("s2", "gh-b", "south", 22.0, 52.0, 420.0, 30.0, 1000.0, 1767268800000)]
    tables = run_batch_tables(spark, spark.createDataFrame(rows, BATCH_EVENT_SCHEMA), workdir + "/tables",
                              millis_col="event_ts")
    got = {r["greenhouse_id"]: r["event_count"] for r in tables["window_metrics"].latest(spark).collect()}
    assert got == {"gh-a": 9, "gh-b": 1}  # the live row stays; the backfill fills the rest
    src = tables["window_metrics_by_source"].latest(spark).collect()
    assert {r["data_source"] for r in src} == {None}

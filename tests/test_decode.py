"""Decode cases (FIXTURES F1) and batch epoch time (F2)."""

import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.operators.decode import accepted, batch_events_with_time, decode_events, rejects

SMALL = T.StructType([
    T.StructField("event_id", T.IntegerType()),
    T.StructField("t", T.DoubleType()),
    T.StructField("event_ts", T.StringType()),
])


def _decode(spark, values, schema=SMALL, **kw):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos int, value string")
    return {r["pos"]: r for r in decode_events(raw, schema=schema, keep=("pos",), **kw).collect()}


def test_f1_decode_cases(spark):
    rows = _decode(spark, [
        "garbage",
        "[1, 2]",
        None,
        '{"event_id":3000000000,"t":2,"event_ts":"2026-01-01T00:00:00+00:00"}',
        '{"event_id":2,"t":"1.5"}',
        '{"event_id":1,"t":2,"event_ts":"x"}',
        '{"event_id":1,"t":NaN,"event_ts":"2026-01-01T12:00:00.123456+00:00"}',
    ])
    assert rows[0]["reject_reason"] == "unparseable_payload"
    assert rows[1]["reject_reason"] == "unparseable_payload"
    assert rows[2]["reject_reason"] == "unparseable_payload"
    # int overflow -> NULL field, row kept and counted
    assert rows[3]["event_id"] is None and rows[3]["t"] == 2.0 and rows[3]["reject_reason"] is None
    assert rows[3]["event_time"] == dt.datetime(2026, 1, 1, 0, 0)
    # number as text -> NULL; no time -> reject
    assert rows[4]["t"] is None and rows[4]["reject_reason"] == "missing_event_ts"
    # bad time text kept, row rejected instead of failing the query
    assert rows[5]["event_ts"] == "x" and rows[5]["event_time"] is None
    assert rows[5]["reject_reason"] == "bad_event_ts"
    assert math.isnan(rows[6]["t"])
    assert rows[6]["event_time"] == dt.datetime(2026, 1, 1, 12, 0, 0, 123456)


def test_accepted_and_rejects_partition_rows(spark):
    raw = spark.createDataFrame([("garbage",), ('{"event_id":1,"t":1.0,"event_ts":"2026-01-01T00:00:00Z"}',)],
                                "value string")
    dec = decode_events(raw, schema=SMALL)
    assert accepted(dec).count() == 1
    assert rejects(dec).count() == 1
    assert "reject_reason" not in accepted(dec).columns


def test_binary_value_and_corrupt_record(spark):
    raw = spark.createDataFrame([(bytearray(b'{"event_id":5,"t":"x","event_ts":"2026-01-01T00:00:00Z"}'),)],
                                "value binary")
    row = decode_events(raw, schema=SMALL, keep_corrupt=True).collect()[0]
    assert row["event_id"] == 5 and row["t"] is None
    assert row["_corrupt_record"] is not None


def test_f2_epoch_millis_boundary(spark):
    df = spark.createDataFrame([(1767225599999,), (1767225600000,)], "event_ts long")
    out = batch_events_with_time(df).select(
        "event_ts", F.window("event_time", "5 minutes").start.alias("ws")).collect()
    got = {r["event_ts"]: r["ws"] for r in out}
    assert got[1767225599999] == dt.datetime(2025, 12, 31, 23, 55)
    assert got[1767225600000] == dt.datetime(2026, 1, 1, 0, 0)
    # milliseconds are kept
    t = batch_events_with_time(df).orderBy("event_ts").first()["event_time"]
    assert t.microsecond == 999000


def test_epoch_millis_out_of_range_is_null(spark):
    df = spark.createDataFrame([(9223372036854775807,), (1767225600000,)], "event_ts long")
    got = [r["event_time"] for r in batch_events_with_time(df).orderBy("event_ts").collect()]
    assert got[0] is not None and got[1] is None


def test_extreme_epoch_millis_do_not_fail_the_window_job(spark):
    from verdant.operators.windows import window_metrics
    df = spark.createDataFrame([(9223372036854775,), (253402300799999,), (1767225600000,)], "event_ts long")
    rows = window_metrics(batch_events_with_time(df).withColumns(
        {"greenhouse_id": F.lit("g"), "temperature_c": F.lit(1.0), "humidity_pct": F.lit(1.0),
         "co2_ppm": F.lit(1.0)})).select("event_count").collect()  # (a year-10000 window end has no Python datetime)
    assert sorted(r["event_count"] for r in rows) == [1, 1]

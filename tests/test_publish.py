"""Keyed JSON records (SNK1/NRM22), sent log (SNK9), formatted rows (SNK8/PRJ10)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from verdant import schemas as S
from verdant.functions.numeric import fixed2_text, round_half_away
from verdant.operators.decode import accepted, decode_events
from verdant.sinks.publish import formatted_rows, sent_log, to_keyed_records


def test_records_roundtrip(spark):
    from tests.conftest import SF001
    from verdant.sources.testdata import sensor_events
    ev = sensor_events(spark, SF001, with_text_time=True).withColumn("event_id", F.col("event_id").try_cast("int"))
    rec = to_keyed_records(ev)
    assert rec.columns == ["key", "value", "topic"]
    first = json.loads(rec.first()["value"])
    assert list(first) == list(S.STREAM_EVENT_FIELDS)
    back = accepted(decode_events(rec)).select(*S.STREAM_EVENT_FIELDS)
    assert back.exceptAll(ev.select(*S.STREAM_EVENT_FIELDS)).count() == 0


def test_null_fields_written(spark):
    df = spark.createDataFrame([("gh", None)], "greenhouse_id string, zone string")
    assert json.loads(to_keyed_records(df, "t").first()["value"]) == {"greenhouse_id": "gh", "zone": None}


def test_sent_log_fields(spark):
    df = spark.createDataFrame([(1, "csv", "gh", 1.5, 2.0, "t")],
                               "event_id int, data_source string, greenhouse_id string, temperature_c double, "
                               "humidity_pct double, source_topic string")
    assert json.loads(sent_log(df).first()["sent"]) == {
        "topic": "t", "event_id": 1, "data_source": "csv", "greenhouse_id": "gh",
        "temperature_c": 1.5, "humidity_pct": 2.0}


def test_fixed2_and_rounding(spark):
    df = spark.createDataFrame([(12.345,), (-0.004,), (2.0,), (-1.5,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(fixed2_text("x")).collect()]
    assert got == ["12.35", "0.00", "2.00", "-1.50", "nan"]
    r = spark.createDataFrame([(2.5,), (-2.5,)], "x double").select(round_half_away("x", 0)).collect()
    assert [x[0] for x in r] == [3.0, -3.0]


def test_formatted_rows(spark):
    t = dt.datetime(2026, 1, 1, 12, 0)
    df = spark.createDataFrame([("gh-a", t, t, 21.456, 1.0, 1.0, 7)], S.WINDOW_METRICS_SCHEMA)
    assert formatted_rows(df).first()["line"] == "  gh-a: 2026-01-01 12:00:00 - avg_temp=21.46°C, events=7"


def test_fixed2_large_and_infinite(spark):
    df = spark.createDataFrame([(12345678901234.5,), (float("inf"),), (float("-inf"),)], "x double")
    got = [r[0] for r in df.select(fixed2_text("x")).collect()]
    assert got == ["12345678901234.50", "inf", "-inf"]


def test_fixed2_beyond_decimal_division_range(spark):
    df = spark.createDataFrame([(1e35,), (0.05,), (-0.5,), (1e36,)], "x double")
    got = [r[0] for r in df.select(fixed2_text("x")).collect()]
    # beyond 2^53 the digits are the shortest round-trip decimal (Python prints the exact binary expansion)
    assert got == ["1" + "0" * 35 + ".00", "0.05", "-0.50", "1" + "0" * 36 + ".00"]

"""Results do not depend on the session time zone (naive times are UTC wall clock)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from verdant.functions.decode import timestamp_to_iso_text, utc_instant, utc_wall_clock
from verdant.plans import catalog


@pytest.fixture()
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_conversions_round_trip(new_york):
    df = new_york.createDataFrame([(dt.datetime(2024, 1, 1, 12, 0, 0, 123456),)], "w timestamp_ntz")
    r = df.select(
        timestamp_to_iso_text("w", is_utc_wall_clock=True).alias("a"),
        timestamp_to_iso_text(utc_instant("w")).alias("b"),
        utc_wall_clock(utc_instant("w")).alias("w2"),
        F.unix_micros(utc_instant("w")).alias("us"),
    ).first()
    assert r["a"] == r["b"] == "2024-01-01T12:00:00.123456+00:00"
    assert r["w2"] == dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    assert r["us"] == 1704110400123456


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["decode_events", "epoch_millis_time", "publish_records", "panel_01"])
def test_queries_same_in_any_zone(spark, name):
    q = catalog.queries()[name]
    utc_rows = _rows(q(spark, SF001))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        other = _rows(q(spark, SF001))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc_rows == other


def test_conversions_exact_across_daylight_saving_fall_back(new_york):
    # 05:30Z and 06:30Z are both 01:30 local time in New York on 2026-11-01
    df = new_york.createDataFrame([(dt.datetime(2026, 11, 1, 5, 30),), (dt.datetime(2026, 11, 1, 6, 30),)],
                                  "w timestamp_ntz")
    got = [r[0] for r in df.select(timestamp_to_iso_text(utc_instant("w")).alias("t")).orderBy("t").collect()]
    assert got == ["2026-11-01T05:30:00.000000+00:00", "2026-11-01T06:30:00.000000+00:00"]


def test_string_bound_with_offset(spark):
    from verdant.operators.serving import time_range
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 22, 30),), (dt.datetime(2025, 12, 31, 23, 30),)],
                               "t timestamp_ntz")
    got = [r[0] for r in time_range(df, "t", "2026-01-01T00:00:00+01:00", None).collect()]
    assert got == [dt.datetime(2025, 12, 31, 23, 30)]


@pytest.mark.parametrize("bound", ["2026-01-01T00:00:00+01:00", "2026-01-01T00:00:00+01", "2026-01-01 00:00:00+0100",
                                   "2025-12-31T23:00:00Z"])
def test_bound_spellings(spark, bound):
    from verdant.operators.serving import time_range
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 22, 30),), (dt.datetime(2025, 12, 31, 23, 30),)],
                               "t timestamp_ntz")
    assert [r[0] for r in time_range(df, "t", bound, None).collect()] == [dt.datetime(2025, 12, 31, 23, 30)]


def test_unreadable_bound_is_an_error(spark):
    from verdant.operators.serving import time_range
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 22, 30),)], "t timestamp_ntz")
    with pytest.raises(ValueError):
        time_range(df, "t", "2026-01-01 00:00:00 CET", None)


@pytest.mark.parametrize("bound,expected", [("2026-01", 1), ("0001-01-01T00:00:00", 2)])
def test_short_and_early_bounds(spark, bound, expected):
    from verdant.operators.serving import time_range
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 22, 30),), (dt.datetime(2026, 1, 1, 0, 30),)],
                               "t timestamp_ntz")
    assert time_range(df, "t", bound, None).count() == expected


@pytest.mark.parametrize("bound", ["2026-02-30", "2026-13", "yesterday"])
def test_impossible_bounds_fail_at_once(spark, bound):
    from verdant.operators.serving import time_range
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 22, 30),)], "t timestamp_ntz")
    with pytest.raises(ValueError):
        time_range(df, "t", bound, None)

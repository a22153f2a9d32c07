"""Dashboard read path: bands (F6), exclusive range, reducers, panels."""

import datetime as dt

from pyspark.sql import functions as F

from verdant import schemas as S
from verdant.functions.bands import band
from verdant.operators.serving import (
    cap_rows,
    column_sums,
    reduce_series,
    relative_range,
    table_count,
    table_head,
    time_range,
    weighted_rollup,
)
from verdant.plans.panels import PANELS, TEMPERATURE_BANDS, detail_table, panel, panel_at

T0 = dt.datetime(2026, 1, 1, 12, 0)


def _wm(spark, rows):
    return spark.createDataFrame(rows, S.WINDOW_METRICS_SCHEMA)


def test_f6_bands(spark):
    df = spark.createDataFrame([(27.99,), (28.0,), (32.0,), (None,), (float("nan"),)], "v double")
    got = [r[0] for r in df.select(band("v", TEMPERATURE_BANDS)).collect()]
    assert got == ["green", "yellow", "red", None, None]


def test_time_range_is_exclusive(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(minutes=5),), (T0 + dt.timedelta(minutes=10),)], "t timestamp")
    out = time_range(df, "t", T0, T0 + dt.timedelta(minutes=10)).collect()
    assert [r[0] for r in out] == [T0 + dt.timedelta(minutes=5)]
    assert relative_range(T0) == (T0 - dt.timedelta(hours=24), T0)


def test_last_not_null_and_tie_break(spark):
    rows = [("a", 1.0, T0, "x"), ("a", None, T0 + dt.timedelta(minutes=5), "x"),
            ("b", 1.0, T0, "x"), ("b", 2.0, T0, "y")]
    df = spark.createDataFrame(rows, "s string, v double, window_start timestamp, tie string")
    out = {r["series"]: r for r in reduce_series(df, "s", "v", reducers=("last", "mean", "max"),
                                                 tie=("tie",)).collect()}
    assert out["a"]["last_value"] == 1.0 and out["a"]["mean_value"] == 1.0
    assert out["b"]["last_value"] == 2.0 and out["b"]["max_value"] == 2.0


def test_panel_filters_and_bands(spark):
    rows = [("gh-0", T0, T0, 27.0, 50.0, 900.0, 10), ("gh-0", T0 + dt.timedelta(minutes=5), T0, 33.0, 50.0, 900.0, 10),
            ("gh-1", T0, T0, 29.0, 50.0, 900.0, 10), ("gh-2", T0, T0, 40.0, 50.0, 900.0, 10)]
    df = _wm(spark, rows)
    out = {r["series"]: r for r in panel_at(df, PANELS[1], ["gh-0", "gh-1"],
                                            T0 + dt.timedelta(minutes=30)).collect()}
    assert set(out) == {"gh-0", "gh-1"}
    assert out["gh-0"]["last_value"] == 33.0 and out["gh-0"]["band"] == "red"
    assert out["gh-1"]["band"] == "yellow"
    # range start is exclusive: rows exactly at lo are out
    out = panel(df, PANELS[1], None, T0, T0 + dt.timedelta(hours=1)).collect()
    assert [(r["series"], r["last_value"]) for r in out] == [("gh-0", 33.0)]


def test_detail_table_and_footer(spark):
    df = _wm(spark, [("gh-0", T0, T0, 1300.0, 10.0, 1299.99, 1400)])
    r = detail_table(df).first()
    assert (r["avg_temperature_band"], r["avg_co2_band"], r["event_count_band"]) == ("red", "green", "red")
    s = column_sums(detail_table(df), ["event_count"]).first()
    assert s["sum_event_count"] == 1400


def test_weighted_rollup(spark):
    rows = [("s", "t1", "gh-0", T0, T0, 10.0, None, 1.0, 1), ("s", "t2", "gh-1", T0, T0, 20.0, 5.0, None, 3)]
    df = spark.createDataFrame(rows, S.WINDOW_METRICS_BY_SOURCE_SCHEMA)
    r = weighted_rollup(df, "data_source").first()
    assert r["avg_temperature"] == 17.5 and r["avg_humidity"] == 5.0 and r["avg_co2"] == 1.0
    assert r["event_count"] == 4


def test_count_head_cap(spark):
    df = _wm(spark, [("gh-0", T0 + dt.timedelta(minutes=5 * i), T0, 1.0, 1.0, 1.0, i) for i in range(10)])
    assert table_count(df).first()["row_count"] == 10
    head = table_head(df, ["greenhouse_id", F.col("window_start").desc()], 5).collect()
    assert [r["event_count"] for r in head] == [9, 8, 7, 6, 5]
    assert cap_rows(df, 3).count() == 3 and cap_rows(df, 0).count() == 10


def test_aware_bounds_are_taken_to_utc(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(hours=2),)], "t timestamp_ntz")
    lo = (T0 + dt.timedelta(hours=1)).replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=5)))
    assert [r[0] for r in time_range(df, "t", lo, None).collect()] == [T0 + dt.timedelta(hours=2)]

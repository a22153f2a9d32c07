"""The twelve dashboard panels as one parameterised DataFrame plan.

Each panel reads an aggregate table, keeps the selected series values
(multi-select) inside an exclusive time range, reduces each series and
bands the result.  Stages run as one lazy plan; the table's files are sorted
by its partition column and time, so both filters prune row groups at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.bands import band
from verdant.operators.serving import multi_select, reduce_series, relative_range, time_range

# ---------------------------------------------------------------------------
# Panel thresholds (band starts at the value; base band below).
# ---------------------------------------------------------------------------
TEMPERATURE_BANDS = ((None, "green"), (28, "yellow"), (32, "red"))
HUMIDITY_BANDS = ((None, "green"), (75, "yellow"), (85, "red"))
CO2_BANDS = ((None, "green"), (1000, "yellow"), (1300, "red"))
EVENTS_BANDS = ((None, "green"), (200, "yellow"), (350, "red"))
SOURCE_EVENTS_BANDS = ((None, "green"), (140, "yellow"), (260, "red"))
DETAIL_BANDS = ((None, "green"), (1300, "red"))
DEFAULT_RANGE_HOURS = 24.0
# ---------------------------------------------------------------------------

# "last" tie-break when one series has several rows at one time
# (by-source rows also vary by greenhouse and topic).
SOURCE_TIE = ("greenhouse_id", "source_topic")


@dataclass(frozen=True)
class PanelSpec:
    panel_id: int
    title: str
    table: str  # window_metrics | window_metrics_by_source
    series: str
    value: str
    filter_col: str
    reducers: tuple[str, ...] = ("last",)
    bands: tuple | None = None
    tie: tuple[str, ...] = ()


PANELS: dict[int, PanelSpec] = {
    1: PanelSpec(1, "temperature KPI", "window_metrics", "greenhouse_id", "avg_temperature", "greenhouse_id",
                 bands=TEMPERATURE_BANDS),
    2: PanelSpec(2, "humidity KPI", "window_metrics", "greenhouse_id", "avg_humidity", "greenhouse_id",
                 bands=HUMIDITY_BANDS),
    3: PanelSpec(3, "CO2 KPI", "window_metrics", "greenhouse_id", "avg_co2", "greenhouse_id", bands=CO2_BANDS),
    4: PanelSpec(4, "events per window KPI", "window_metrics", "greenhouse_id", "event_count", "greenhouse_id",
                 bands=EVENTS_BANDS),
    5: PanelSpec(5, "temperature trend", "window_metrics", "greenhouse_id", "avg_temperature", "greenhouse_id",
                 reducers=("last", "mean")),
    6: PanelSpec(6, "humidity trend", "window_metrics", "greenhouse_id", "avg_humidity", "greenhouse_id",
                 reducers=("last", "max"), bands=HUMIDITY_BANDS),
    7: PanelSpec(7, "CO2 trend", "window_metrics", "greenhouse_id", "avg_co2", "greenhouse_id",
                 reducers=("last", "max"), bands=CO2_BANDS),
    8: PanelSpec(8, "events bar", "window_metrics", "greenhouse_id", "event_count", "greenhouse_id",
                 bands=EVENTS_BANDS),
    9: PanelSpec(9, "temperature by source", "window_metrics_by_source", "data_source", "avg_temperature",
                 "data_source", tie=SOURCE_TIE),
    10: PanelSpec(10, "events by source", "window_metrics_by_source", "data_source", "event_count", "data_source",
                  bands=SOURCE_EVENTS_BANDS, tie=SOURCE_TIE),
    11: PanelSpec(11, "CO2 by topic", "window_metrics_by_source", "source_topic", "avg_co2", "data_source",
                  tie=("greenhouse_id", "data_source")),
}

DETAIL_COLUMNS = ("greenhouse_id", "window_start", "avg_temperature", "avg_humidity", "avg_co2", "event_count")


def panel_frame(table: DataFrame, spec: PanelSpec, selected: Sequence[str] | None,
                lo: datetime | str | None, hi: datetime | str | None) -> DataFrame:
    """The panel's (series, value, time) rows after filters (stages 1-4): what a trend panel plots."""
    df = panel_rows(table, spec, selected, lo, hi)
    return df.select(F.col(spec.series).alias("series"), F.col(spec.value).alias("value"), F.col("window_start").alias("time"))


def panel_rows(table: DataFrame, spec: PanelSpec, selected: Sequence[str] | None,
               lo: datetime | str | None, hi: datetime | str | None) -> DataFrame:
    """The table's rows that the panel selects."""
    return time_range(multi_select(table, spec.filter_col, selected), "window_start", lo, hi)


def events_of_range(events: DataFrame, lo: datetime, hi: datetime, time_col: str = "event_time",
                    window_minutes: int = 5) -> DataFrame:
    """Events that windows starting inside ``lo < window_start < hi`` can hold, for panels over raw events.

    Unlike the range on the computed window start, these bounds reach the scan.  Both ends are naive UTC.
    """
    width = timedelta(minutes=window_minutes)
    epoch = datetime(1970, 1, 1)
    last = epoch - (epoch - hi) // width * width  # hi, up to a window's edge
    return time_range(events, time_col, lo - timedelta(microseconds=1), last)


def panel(table: DataFrame, spec: PanelSpec, selected: Sequence[str] | None = None,
          lo: datetime | str | None = None, hi: datetime | str | None = None) -> DataFrame:
    """One row per series: reducers (``last_value``, ``mean_value``, ``max_value``) and ``band`` of the last value."""
    out = reduce_series(panel_rows(table, spec, selected, lo, hi), spec.series, spec.value, "window_start", spec.reducers, spec.tie)
    if spec.bands:
        out = out.withColumn("band", band("last_value", spec.bands))
    return out


def panel_at(table: DataFrame, spec: PanelSpec, selected: Sequence[str] | None, as_of: datetime,
             hours: float = DEFAULT_RANGE_HOURS) -> DataFrame:
    """Panel over ``now-<hours>h .. now`` with ``now = as_of``."""
    lo, hi = relative_range(as_of, hours)
    return panel(table, spec, selected, lo, hi)


def detail_table(table: DataFrame, selected: Sequence[str] | None = None,
                 lo: datetime | str | None = None, hi: datetime | str | None = None) -> DataFrame:
    """Panel 12: the window rows themselves, each value banded green/red at 1300."""
    df = time_range(multi_select(table, "greenhouse_id", selected), "window_start", lo, hi)
    bands = {f"{c}_band": band(c, DETAIL_BANDS) for c in ("avg_temperature", "avg_humidity", "avg_co2")}
    bands["event_count_band"] = band(F.col("event_count").cast("double"), DETAIL_BANDS)
    return df.select(*DETAIL_COLUMNS).withColumns(bands)

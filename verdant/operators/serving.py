"""Dashboard read path: selection filters, time range, series reducers, bands."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.bands import band
from verdant.functions.decode import utc_instant

REDUCERS = ("last", "mean", "max", "sum")


# Short zone-less forms ("2026-01", "2026-1-5 7:00") on top of ISO-8601
_SHORT_TIME = re.compile(r"^(\d{4})(?:-(\d{1,2})(?:-(\d{1,2})(?:[ T](\d{1,2})(?::(\d{1,2})(?::(\d{1,2}))?)?)?)?)?$")


def _parse_bound(text: str) -> datetime:
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        m = _SHORT_TIME.match(text)
        if not m:
            raise ValueError(f"time bound {text!r}: use ISO-8601 (offset optional)") from None
        parts = [int(g) if g else d for g, d in zip(m.groups(), (None, 1, 1, 0, 0, 0))]
        return datetime(*parts)  # raises ValueError for impossible dates such as 2026-02-30


def _time_literal(value: datetime | str, like: T.DataType) -> Column:
    """A bound as a literal of the column's type.

    Naive bounds are UTC wall clock; aware datetimes and ISO-8601 texts with
    an offset are converted to UTC first.  Bounds are parsed here, on the
    driver, so a bad one fails at once instead of turning into a NULL filter.
    """
    if isinstance(value, str):
        value = _parse_bound(value.strip())
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    wall = F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return utc_instant(wall) if isinstance(like, T.TimestampType) else wall


def multi_select(df: DataFrame, column: str, selected: Sequence[str] | None) -> DataFrame:
    """``column IN (selected)``; ``None`` = all values."""
    if selected is None:
        return df
    return df.filter(F.col(column).isin(*selected))


def time_range(df: DataFrame, column: str, lo: datetime | str | None, hi: datetime | str | None) -> DataFrame:
    """Rows with ``lo < column < hi`` (both ends exclusive)."""
    dtype = df.schema[column].dataType
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(column) > _time_literal(lo, dtype))
    if hi is not None:
        cond = cond & (F.col(column) < _time_literal(hi, dtype))
    return df.filter(cond)


def relative_range(as_of: datetime, hours: float = 24.0) -> tuple[datetime, datetime]:
    """``now-<hours>h .. now`` with ``now`` given explicitly."""
    return as_of - timedelta(hours=hours), as_of


def cap_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """Cap on the number of events; 0 or less = no cap."""
    return df.limit(max_rows) if max_rows and max_rows > 0 else df


def reduce_series(df: DataFrame, series: str, value: str, time: str = "window_start",
                  reducers: Sequence[str] = ("last",), tie: Sequence[str] = ()) -> DataFrame:
    """One row per series with the requested reducers over ``value``.

    ``last`` = value at the greatest (time, tie...) among non-NULL values
    (an order-free ``max_by``, not the order-dependent ``last``).
    ``mean``/``max``/``sum`` skip NULLs.  A series has as many rows
    as it has distinct series values, so the partial aggregate collapses
    each task's rows to a handful before the shuffle.
    """
    v = F.col(value)
    aggs = []
    for r in reducers:
        if r == "last":
            # A bare time ordering keeps fixed-width buffers (hash aggregate);
            # a tie-break on text columns needs a struct (sort aggregate).
            key = F.struct(*[F.col(c) for c in (time, *tie)]) if tie else F.col(time)
            aggs.append(F.max_by(v, F.when(v.isNotNull(), key)).alias("last_value"))
        elif r == "mean":
            aggs.append(F.avg(v).alias("mean_value"))
        elif r == "max":
            aggs.append(F.max(v).alias("max_value"))
        elif r == "sum":
            aggs.append(F.sum(v).alias("sum_value"))
        else:
            raise ValueError(f"unknown reducer {r!r}; known: {', '.join(REDUCERS)}")
    return df.groupBy(F.col(series).alias("series")).agg(*aggs)


def weighted_rollup(df: DataFrame, series: str, time: str = "window_start") -> DataFrame:
    """Per (series, window): total events and count-weighted averages.

    Rows of one series and window come from several greenhouses/topics;
    this sums them instead of plotting several points at one time.
    """
    n = F.col("event_count")

    def wavg(c: str) -> Column:
        weight = F.when(F.col(c).isNotNull(), n)
        return F.sum(F.col(c) * n) / F.sum(weight)

    return df.groupBy(F.col(series).alias("series"), F.col(time).alias(time)).agg(
        wavg("avg_temperature").alias("avg_temperature"),
        wavg("avg_humidity").alias("avg_humidity"),
        wavg("avg_co2").alias("avg_co2"),
        F.sum(n).alias("event_count"),
    )


def with_band(df: DataFrame, value: str, steps, name: str = "band") -> DataFrame:
    return df.withColumn(name, band(value, steps))


def table_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*)`` of a table."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a total order (a top-n: sorted per task, merged)."""
    return df.orderBy(*order).limit(n)


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Footer row: the sum of each column."""
    return df.agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])

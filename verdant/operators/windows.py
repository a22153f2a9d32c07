"""Tumbling-window aggregation shared by the batch and the streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant import schemas as S

GREENHOUSE_KEYS = ("greenhouse_id",)
SOURCE_KEYS = ("data_source", "source_topic", "greenhouse_id")


def window_metrics(events: DataFrame, keys: Sequence[str] = GREENHOUSE_KEYS, time_col: str = "event_time",
                   window: str = S.WINDOW_DURATION, watermark: str | None = None) -> DataFrame:
    """Per (epoch-aligned ``[start, end)`` window, keys): three averages and a row count.

    ``avg`` skips NULL readings, ``event_count`` counts every row with a
    time; rows without a time fall out at the window's NULL filter.  With
    ``watermark`` the same plan runs as a stateful streaming aggregation.
    The aggregate is two-phase (partial per task, final after the shuffle
    on (window, keys)), so a hot key costs one partial row per task.
    """
    if watermark:
        events = events.withWatermark(time_col, watermark)
    agg = events.groupBy(F.window(F.col(time_col), window).alias("window"), *keys).agg(
        F.avg("temperature_c").alias("avg_temperature"),
        F.avg("humidity_pct").alias("avg_humidity"),
        F.avg("co2_ppm").alias("avg_co2"),
        F.count(F.lit(1)).alias("event_count"),
    )
    return agg.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "avg_temperature",
        "avg_humidity",
        "avg_co2",
        "event_count",
    )


def window_metrics_by_source(events: DataFrame, time_col: str = "event_time", window: str = S.WINDOW_DURATION,
                             watermark: str | None = None) -> DataFrame:
    return window_metrics(events, SOURCE_KEYS, time_col, window, watermark)


def window_tables(events: DataFrame, tables: dict[str, Sequence[str]], time_col: str = "event_time", window: str = S.WINDOW_DURATION,
                  watermark: str | None = None) -> DataFrame:
    """The rows of several tables, each with its own keys, by one aggregate: ``table_name``, all keys (NULL where a
    table has them not), and the metrics.

    Every event stands once for each table, with that table's name and keys, before the partial aggregate of its task;
    what is shuffled, and kept as a stream's state, is the windows of all tables.
    """
    if watermark:
        events = events.withWatermark(time_col, watermark)
    keys = list(dict.fromkeys(k for ks in tables.values() for k in ks))
    stand = F.array(*[F.struct(F.lit(name).alias("table_name"), *[F.col(k).alias(k) if k in ks else F.lit(None).cast("string").alias(k) for k in keys])
                      for name, ks in tables.items()])
    rows = events.select(F.col(time_col).alias("_time"), "temperature_c", "humidity_pct", "co2_ppm", F.inline(stand))
    return window_metrics(rows, ("table_name", *keys), "_time", window)


# ---- one scan, several key sets: keep sums and non-NULL counts, divide last ----

_SUM_SPECS = (("temperature_c", "avg_temperature"), ("humidity_pct", "avg_humidity"), ("co2_ppm", "avg_co2"))


SUM_COLUMNS = tuple(c for _, out in _SUM_SPECS for c in (f"sum_{out}", f"n_{out}")) + ("event_count",)


def window_sums(events: DataFrame, keys: Sequence[str] = SOURCE_KEYS, time_col: str = "event_time",
                window: str = S.WINDOW_DURATION, watermark: str | None = None) -> DataFrame:
    """Re-aggregatable window state: per metric the sum and the non-NULL count, plus the row count.

    Coarser key sets are roll-ups of it (``rollup_window_sums``): counts are
    exact, averages equal the direct ones up to the order in which floating
    point sums are added.  One scan of the events serves every table.
    """
    if watermark:
        events = events.withWatermark(time_col, watermark)
    aggs = []
    for src, out in _SUM_SPECS:
        aggs += [F.sum(src).alias(f"sum_{out}"), F.count(src).alias(f"n_{out}")]
    agg = events.groupBy(F.window(F.col(time_col), window).alias("window"), *keys).agg(
        *aggs, F.count(F.lit(1)).alias("event_count"))
    return agg.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *[c for c in agg.columns if c not in ("window", *keys)])


def rollup_window_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Window sums re-aggregated to a coarser key set (same windows)."""
    return sums.groupBy(*keys, "window_start", "window_end").agg(*[F.sum(c).alias(c) for c in SUM_COLUMNS])


def finish_window_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Window sums -> the table row (averages = sum / non-NULL count, NULL when none)."""
    avgs = [F.when(F.col(f"n_{out}") > 0, F.col(f"sum_{out}") / F.col(f"n_{out}")).alias(out)
            for _, out in _SUM_SPECS]
    return sums.select(*keys, "window_start", "window_end", *avgs, F.col("event_count").cast("long"))

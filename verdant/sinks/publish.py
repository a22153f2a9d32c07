"""Event publishing: keyed JSON records, the "sent" log line, formatted window rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant import schemas as S
from verdant.functions.decode import json_text, utc_wall_clock
from verdant.functions.numeric import fixed2_text

SENT_FIELDS = ("topic", "event_id", "data_source", "greenhouse_id", "temperature_c", "humidity_pct")


def _topic(topic: str | Column | None) -> Column:
    if topic is None:
        return F.col("source_topic")
    return F.lit(topic) if isinstance(topic, str) else topic


def to_keyed_records(events: DataFrame, topic: str | Column | None = None) -> DataFrame:
    """Event rows -> (key, value, topic) records: key = greenhouse id,
    value = JSON of every event field present (NULLs written as ``null``)."""
    fields = [c for c in S.STREAM_EVENT_FIELDS if c in events.columns]
    return events.select(
        F.col("greenhouse_id").cast("string").alias("key"),
        json_text(*fields).alias("value"),
        _topic(topic).alias("topic"),
    )


def write_records(records: DataFrame, fmt: str = "kafka", path: str | None = None,
                  options: Mapping[str, str] | None = None, mode: str = "append") -> None:
    """Publish records.  ``kafka`` needs ``kafka.bootstrap.servers`` in ``options``
    (and the Kafka connector on the classpath); file formats need ``path``."""
    writer = records.write.options(**dict(options or {}))
    if fmt == "kafka":
        writer.format("kafka").save()
    else:
        writer.mode(mode).format(fmt).save(path)


def sent_log(events: DataFrame, topic: str | Column | None = None) -> DataFrame:
    """The per-event "sent" line: a JSON object with 6 of the event fields."""
    fields = [_topic(topic).alias("topic") if f == "topic" else F.col(f) for f in SENT_FIELDS]
    return events.select(json_text(*fields).alias("sent"))


def formatted_rows(metrics: DataFrame) -> DataFrame:
    """One printable line per window row: ``gh: start - avg_temp=12.34°C, events=7``.

    Window starts print as UTC wall clock; a NULL average prints as ``null``.
    """
    start = F.col("window_start")
    if isinstance(metrics.schema["window_start"].dataType, T.TimestampType):
        start = utc_wall_clock(start)
    line = F.format_string(
        "  %s: %s - avg_temp=%s°C, events=%d",
        F.col("greenhouse_id"),
        F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
        F.coalesce(fixed2_text("avg_temperature"), F.lit("null")),
        F.col("event_count"),
    )
    return metrics.select(line.alias("line"))

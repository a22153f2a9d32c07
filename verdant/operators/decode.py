"""Keyed JSON records -> typed sensor events, with a reject reason per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant import schemas as S
from verdant.functions.decode import epoch_millis_to_timestamp, iso_text_to_timestamp, parse_json_struct

REASON_UNPARSEABLE = "unparseable_payload"
REASON_MISSING_TIME = "missing_event_ts"
REASON_BAD_TIME = "bad_event_ts"


def decode_events(raw: DataFrame, value_col: str = "value", schema: T.StructType = S.STREAM_EVENT_SCHEMA,
                  keep: Sequence[str] = (), keep_corrupt: bool = False) -> DataFrame:
    """Decode the message value into the event fields plus ``event_time`` and ``reject_reason``.

    A binary value is read as UTF-8 text.  Wrong-typed fields become NULL and
    the row is kept (it still counts); rows whose time is missing or not
    ISO-8601 get a reject reason and a NULL ``event_time``.
    """
    value = F.col(value_col)
    if isinstance(raw.schema[value_col].dataType, T.BinaryType):
        value = value.cast("string")
    parsed = raw.select(*keep, parse_json_struct(value, schema, keep_corrupt).alias("data"))
    fields = [f.name for f in schema.fields]
    # Flatten through a generator (one output row per input row, a NULL
    # struct gives a row of NULLs).  Filters cannot be pushed below a
    # Generate, so the JSON is parsed once per row; flattening with
    # ``data.field`` selects lets the optimizer inline ``from_json`` into
    # every pushed-down predicate and parse the same text many times.
    flat = parsed.select(*keep, F.inline(F.array(F.col("data"))))
    flat = flat.withColumn("event_time", iso_text_to_timestamp("event_ts"))
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f).isNull()
    reason = (
        F.when(F.col("event_time").isNotNull(), F.lit(None).cast("string"))
        .when(all_null, F.lit(REASON_UNPARSEABLE))
        .when(F.col("event_ts").isNull(), F.lit(REASON_MISSING_TIME))
        .otherwise(F.lit(REASON_BAD_TIME))
    )
    return flat.withColumn("reject_reason", reason)


def accepted(decoded: DataFrame) -> DataFrame:
    """Rows with a usable time (exactly those without a reject reason)."""
    return decoded.filter(F.col("event_time").isNotNull()).drop("reject_reason")


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNotNull())


def batch_rejects(df: DataFrame, millis_col: str = "event_ts") -> DataFrame:
    """Batch rows that the aggregates leave out, with their ``reject_reason``: no time, or one beyond the years 1 to 9999."""
    reason = (F.when(F.col(millis_col).isNull(), F.lit(REASON_MISSING_TIME))
              .when(epoch_millis_to_timestamp(millis_col).isNull(), F.lit(REASON_BAD_TIME)))
    return df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def batch_events_with_time(df: DataFrame, millis_col: str = "event_ts") -> DataFrame:
    """Batch rows with epoch-millisecond time: add ``event_time`` (milliseconds kept)."""
    return df.withColumn("event_time", epoch_millis_to_timestamp(millis_col))

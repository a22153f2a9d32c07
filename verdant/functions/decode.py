"""Decode expressions: bytes -> text -> struct, and text/epoch time -> timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.colref import col_of as _c


def value_as_text(c="value") -> Column:
    """Message value (binary) as UTF-8 text."""
    return _c(c).cast("string")


def parse_json_struct(c, schema: T.DataType, keep_corrupt: bool = False) -> Column:
    """Permissive JSON decode against a fixed schema.

    Unparseable text gives a struct of NULLs; a wrong-typed field gives NULL
    for that field only.  With ``keep_corrupt`` a ``_corrupt_record`` field
    carries the original text of such rows (diagnostics only).
    """
    if keep_corrupt and isinstance(schema, T.StructType):
        schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        return F.from_json(_c(c), schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.from_json(_c(c), schema)


def iso_text_to_timestamp(c) -> Column:
    """ISO-8601 text (offset, 0-6 fractional digits) -> timestamp; NULL if unparseable.

    ``try_to_timestamp`` instead of ``to_timestamp``: under ANSI mode the
    latter fails the whole query on one bad row.
    """
    return F.try_to_timestamp(_c(c))


# Time-zone policy: a timestamp without zone (TIMESTAMP_NTZ) is a UTC wall
# clock; an instant (TIMESTAMP) is rendered and converted through UTC.  The
# two helpers below convert between them through epoch microseconds, never
# through the session zone's wall clock (which repeats or skips an hour at
# daylight-saving changes).

def _epoch_ntz() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def utc_instant(ntz) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> the instant (TIMESTAMP)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(ntz)))


def utc_wall_clock(ts) -> Column:
    """Instant (TIMESTAMP) -> its UTC wall clock (TIMESTAMP_NTZ)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), _epoch_ntz())


def timestamp_to_iso_text(c, is_utc_wall_clock: bool = False) -> Column:
    """Timestamp -> ISO-8601 text in UTC with microseconds: ``2026-01-01T12:00:00.123456+00:00``.

    An instant is first taken to its UTC wall clock, so the text does not
    depend on the session time zone.
    """
    wall = _c(c) if is_utc_wall_clock else utc_wall_clock(c)
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


# Epoch milliseconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59.999 UTC:
# Spark's timestamp range, with room for window arithmetic on top.
_MIN_EPOCH_MS = -62_135_596_800_000
_MAX_EPOCH_MS = 253_402_300_799_999


def epoch_millis_to_timestamp(c) -> Column:
    """Epoch milliseconds -> timestamp, keeping the milliseconds, no zone round trip.
    Values outside years 0001-9999 give NULL (a reject) instead of failing the job."""
    ms = _c(c)
    return F.when(ms.between(_MIN_EPOCH_MS, _MAX_EPOCH_MS), F.timestamp_millis(ms))


def json_text(*cols, keep_nulls: bool = True) -> Column:
    """Row -> JSON object text, NULL fields written as ``null``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts)

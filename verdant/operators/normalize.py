"""Source rows -> sensor events, as column expressions (no per-row Python).

Crop CSV rows and weather observation arrays are turned into the 12-field
event, with provenance columns, an ``imputed`` list of filled readings and
a ``reject_reason`` for rows the upstream producer would have raised on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant import schemas as S
from verdant.functions.colref import col_of
from verdant.functions.decode import timestamp_to_iso_text
from verdant.functions.impute import hash_pick, impute_between
from verdant.functions.numeric import (
    clamp,
    cycle_pick,
    first_number,
    int_prefix,
    round_half_away,
    strip_ws,
    text_to_double,
)

EVENT_COLUMNS = S.STREAM_EVENT_FIELDS


def add_source_metadata(df: DataFrame, source: str, topic: str) -> DataFrame:
    """Provenance columns (constant per source)."""
    return df.withColumns({"data_source": F.lit(source), "source_topic": F.lit(topic)})


def member_or_first(value, allowed: Sequence[str]) -> Column:
    """``value`` if it is one of ``allowed``, else the first allowed value."""
    v = F.lit(value) if isinstance(value, str) or value is None else value
    return F.when(v.isin(*allowed), v).otherwise(F.lit(allowed[0]))


def _ingest_text(ingest_time) -> Column:
    t = F.current_timestamp() if ingest_time is None else ingest_time
    return timestamp_to_iso_text(t)


def normalize_crop_rows(rows: DataFrame, id_col: str = "event_id", ingest_time: Column | None = None,
                        source: str = S.SOURCE_CSV, topic: str = S.TOPIC_CSV,
                        impute_keys: Sequence[Column] | None = None) -> DataFrame:
    """Crop CSV rows (all text) with a 1-based row ordinal -> events.

    * greenhouse: integer part of the id text, floored at 1, mapped round-robin
      onto the greenhouse list; non-numeric text -> reject.
    * readings: text -> double; empty -> imputed from the row key; non-empty
      unparseable text, blanks included -> reject.  ``"0"`` is a value, not a
      missing one.
    * soil moisture: irrigation x6 clamped to [5, 90], else imputed.
    * sensor id ``crop-<crop type, lower case>-<ordinal, 4+ digits>``; a
      missing or empty crop type gives ``sensor``; blanks around it stay.
    * imputed values and the zone are keyed by ``impute_keys`` (default the
      ordinal; per-file ordinals need the file as well).
    """
    present = set(rows.columns)

    def text(c):
        return F.col(c) if c in present else F.lit(None).cast("string")

    key = F.col(id_col)
    keys = list(impute_keys) if impute_keys else [key]
    readings = {  # in event field order
        "temperature_c": "avg_temperature_C",
        "humidity_pct": "humidity_percent",
        "co2_ppm": "co2_ppm",
        "soil_moisture_pct": "irrigation_mm",
        "light_lux": "light_intensity_lux",
    }
    parsed = {out: text_to_double(text(src)) for out, src in readings.items()}
    missing = {out: F.nullif(text(src), F.lit("")).isNull() for out, src in readings.items()}
    bad = {out: (~missing[out]) & parsed[out].isNull() for out in readings}

    values = {}
    for out in readings:
        lo, hi = S.CROP_IMPUTE[out]
        given = parsed[out]
        if out == "soil_moisture_pct":
            given = clamp(given * F.lit(S.IRRIGATION_SCALE), S.SOIL_MIN, S.SOIL_MAX)
        values[out] = round_half_away(F.when(missing[out], impute_between(out, lo, hi, *keys)).otherwise(given), 2)

    gh_num = int_prefix(text("greenhouse_id"))
    crop_type = F.lower(F.coalesce(F.nullif(text("crop_type"), F.lit("")), F.lit(S.CROP_TYPE_DEFAULT)))
    reason = F.when(gh_num.isNull(), F.lit("bad_greenhouse_id"))
    for out in readings:
        reason = reason.when(bad[out], F.lit(f"bad_number:{readings[out]}"))
    imputed = F.array_compact(F.array(*[F.when(missing[o], F.lit(o)) for o in readings]))

    return rows.select(
        key.cast("long").alias("event_id"),
        F.format_string(S.CROP_SENSOR_PREFIX + "%s-%04d", crop_type, key).alias("sensor_id"),
        cycle_pick(S.GREENHOUSES, gh_num).alias("greenhouse_id"),
        hash_pick(S.ZONES, "zone", *keys).alias("zone"),
        values["temperature_c"].alias("temperature_c"),
        values["humidity_pct"].alias("humidity_pct"),
        values["co2_ppm"].alias("co2_ppm"),
        values["soil_moisture_pct"].alias("soil_moisture_pct"),
        values["light_lux"].alias("light_lux"),
        F.lit(source).alias("data_source"),
        F.lit(topic).alias("source_topic"),
        _ingest_text(ingest_time).alias("event_ts"),
        imputed.alias("imputed"),
        reason.alias("reject_reason"),
    )


def latest_observation(observations) -> Column:
    """Last element of the observation array (by position); NULL for an empty or NULL array."""
    return F.try_element_at(col_of(observations), F.lit(-1))


def normalize_observations(obs: DataFrame, observations_col: str = "observations", id_col: str = "event_id",
                           station: Column | None = None, greenhouse_id: str | Column = "alm-poniente",
                           ingest_time: Column | None = None, source: str = S.SOURCE_WEATHER,
                           topic: str = S.TOPIC_WEATHER, impute_keys: Sequence[Column] | None = None) -> DataFrame:
    """Weather responses (one array of observations per row) -> one event per response.

    The last observation is used.  Each reading is the first candidate key
    that parses as a number (decimal comma accepted), else a fixed default;
    light is scaled x100.  CO2 and soil are imputed (keyed by ``impute_keys``,
    default the id).  An empty or missing array, or no station id, is a reject.
    """
    last = latest_observation(observations_col)
    station = last["idema"] if station is None else station
    key = F.col(id_col)
    temperature = first_number([last[k] for k in S.WEATHER_TEMPERATURE_KEYS])
    humidity = first_number([last[k] for k in S.WEATHER_HUMIDITY_KEYS])
    light = first_number([last[k] for k in S.WEATHER_LIGHT_KEYS])
    co2_lo, co2_hi = S.WEATHER_IMPUTE["co2_ppm"]
    soil_lo, soil_hi = S.WEATHER_IMPUTE["soil_moisture_pct"]
    keys = list(impute_keys) if impute_keys else [key]
    reason = (F.when(last.isNull(), F.lit("empty_observations"))
              .when(station.isNull() | (strip_ws(station.cast("string")) == ""), F.lit("missing_station")))
    imputed = F.array_compact(F.array(
        F.when(temperature.isNull(), F.lit("temperature_c")),
        F.when(humidity.isNull(), F.lit("humidity_pct")),
        F.lit("co2_ppm"),
        F.lit("soil_moisture_pct"),
        F.when(light.isNull(), F.lit("light_lux")),
    ))
    return obs.select(
        key.cast("long").alias("event_id"),
        F.concat(F.lit(S.WEATHER_SENSOR_PREFIX), station.cast("string")).alias("sensor_id"),
        member_or_first(greenhouse_id, S.GREENHOUSES).alias("greenhouse_id"),
        F.lit(S.WEATHER_ZONE).alias("zone"),
        round_half_away(F.coalesce(temperature, F.lit(S.WEATHER_TEMPERATURE_DEFAULT)), 2).alias("temperature_c"),
        round_half_away(F.coalesce(humidity, F.lit(S.WEATHER_HUMIDITY_DEFAULT)), 2).alias("humidity_pct"),
        impute_between("co2_ppm", co2_lo, co2_hi, *keys).alias("co2_ppm"),
        impute_between("soil_moisture_pct", soil_lo, soil_hi, *keys).alias("soil_moisture_pct"),
        round_half_away(F.coalesce(light, F.lit(S.WEATHER_LIGHT_DEFAULT)) * F.lit(S.WEATHER_LIGHT_SCALE), 2)
        .alias("light_lux"),
        F.lit(source).alias("data_source"),
        F.lit(topic).alias("source_topic"),
        _ingest_text(ingest_time).alias("event_ts"),
        imputed.alias("imputed"),
        reason.alias("reject_reason"),
    )


def valid_events(normalized: DataFrame) -> DataFrame:
    """Drop rejects and the bookkeeping columns: the 12-field event."""
    return normalized.filter(F.col("reject_reason").isNull()).select(*EVENT_COLUMNS)

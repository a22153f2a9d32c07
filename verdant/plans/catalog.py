"""Registered queries (Spark plans over the provided tables) and their SQL twins.

Every query reads the given tables (or data Spark derives from them) in
full.  Averages are rounded to 6 decimals by rounding ``x * 1e6`` to an
integer, which every engine does the same way, so the DuckDB twin can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant import schemas as S
from verdant.functions.decode import epoch_millis_to_timestamp, utc_instant, utc_wall_clock
from verdant.functions.numeric import first_number, round_half_away
from verdant.operators.decode import accepted, batch_rejects, decode_events, rejects
from verdant.operators.normalize import (
    add_source_metadata,
    latest_observation,
    member_or_first,
    normalize_crop_rows,
    normalize_observations,
)
from verdant.operators.ordinals import with_file_ordinals
from verdant.operators.serving import cap_rows, column_sums, table_count, table_head, weighted_rollup
from verdant.operators.union import union_sources
from verdant.operators.windows import (
    GREENHOUSE_KEYS,
    finish_window_sums,
    rollup_window_sums,
    window_metrics,
    window_metrics_by_source,
    window_sums,
)
from verdant.plans import fixtures as FX
from verdant.plans.batch_job import batch_window_metrics, run_batch_job, run_batch_tables
from verdant.plans.panels import PANELS, detail_table, events_of_range, panel, panel_at, panel_frame, panel_rows
from verdant.session import scratch_path
from verdant.sinks.publish import formatted_rows, sent_log, to_keyed_records, write_records
from verdant.sinks.upsert import BACKFILL, UpsertTable
from verdant.sources.csv import read_crop_csv, read_crop_header
from verdant.sources.events import read_events_stream
from verdant.sources.observations import loose_reading, parse_loose_observations, parse_observation_array
from verdant.sources.tables import open_table, read_table, stored_places
from verdant.sources.testdata import SENSOR_VIEW_SQL, load_table, sensor_events
from verdant.streaming.ingest import start_crop_ingest
from verdant.streaming.job import start_table_queries

QueryFn = Callable[[SparkSession, str], DataFrame]

# Dashboard parameters used by the registered panel queries.
AS_OF = datetime(2024, 1, 30, 0, 0, 0)
RANGE_LO = datetime(2024, 1, 29, 0, 0, 0)  # AS_OF - 24 h
SELECTED_GREENHOUSES = ("gh-0", "gh-1")
SELECTED_SOURCES = ("click", "view", "purchase")
TREND_PANELS = (5, 6, 7, 9, 11)
TABLE_NAMES = (S.WINDOW_METRICS.name, S.WINDOW_METRICS_BY_SOURCE.name)
# Fixed ingest time stamped on normalised source rows in the registered queries.
INGEST_TIME = "2024-02-01 00:00:00"

# ----------------------------------------------------------------- helpers

def _round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(round_half_away(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _ntz(df: DataFrame, cols=("window_start", "window_end")) -> DataFrame:
    """Instants -> UTC wall clock (the test tables' naive timestamps are UTC)."""
    out = {}
    for c in cols:
        if c in df.columns:
            is_instant = isinstance(df.schema[c].dataType, T.TimestampType)
            out[c] = utc_wall_clock(c) if is_instant else F.col(c)
    return df.withColumns(out)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return window_metrics(sensor_events(spark, sf))


def _metrics_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return window_metrics_by_source(sensor_events(spark, sf))


def _ingest() -> Column:
    return F.to_timestamp(F.lit(INGEST_TIME))


# SQL helpers (DuckDB)

def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_round(expr: str, digits: int) -> str:
    scale = _d(10 ** digits)
    return f"(round(({expr}) * {scale}) / {scale})"


def sql_r6(expr: str) -> str:
    return sql_round(expr, 6)


def sql_hash_u32(salt: str, key_sql: str) -> str:
    key = f"coalesce(CAST({key_sql} AS VARCHAR), '\\N')"
    return f"CAST(('0x' || substr(md5('{salt}:' || {key}), 1, 8)) AS BIGINT)"


def sql_impute(salt: str, lo: float, hi: float, key_sql: str) -> str:
    unit = f"({sql_hash_u32(salt, key_sql)} / {_d(4294967296.0)})"
    return sql_round(f"{_d(lo)} + {unit} * {_d(hi - lo)}", 2)


def sql_band(expr: str, steps) -> str:
    parts = [f"WHEN ({expr}) IS NULL OR isnan(CAST({expr} AS DOUBLE)) THEN NULL"]
    for threshold, label in reversed(steps[1:]):
        parts.append(f"WHEN ({expr}) >= {_d(threshold)} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{steps[0][1]}' END"


def sql_fixed2(expr: str) -> str:
    cents = f"TRY_CAST(round(abs({expr}) * {_d(100)}) AS HUGEINT)"
    return (f"CASE WHEN isnan({expr}) THEN 'nan' WHEN ({expr}) = 'inf'::DOUBLE THEN 'inf' "
            f"WHEN ({expr}) = '-inf'::DOUBLE THEN '-inf' "
            f"WHEN abs({expr}) >= {_d(2.0 ** 53)} THEN printf('%.2f', {expr}) ELSE "
            f"(CASE WHEN ({expr}) < 0 AND {cents} > 0 THEN '-' ELSE '' END) || CAST({cents} // 100 AS VARCHAR)"
            f" || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') END")


def _ts(dt: datetime) -> str:
    return f"TIMESTAMP '{dt.strftime('%Y-%m-%d %H:%M:%S')}'"


def metrics_sql(keys: tuple[str, ...], rounded: bool = True) -> str:
    k = ", ".join(keys)
    avg = (lambda e: sql_r6(e)) if rounded else (lambda e: e)
    return f"""
SELECT {k},
       time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES AS window_end,
       {avg('avg(temperature_c)')} AS avg_temperature,
       {avg('avg(humidity_pct)')} AS avg_humidity,
       {avg('avg(co2_ppm)')} AS avg_co2,
       count(*) AS event_count
FROM ({SENSOR_VIEW_SQL}) s
WHERE event_time IS NOT NULL
GROUP BY ALL"""


WM_SQL = metrics_sql(("greenhouse_id",))
WMS_SQL = metrics_sql(("data_source", "source_topic", "greenhouse_id"))
WM_RAW_SQL = metrics_sql(("greenhouse_id",), rounded=False)
# A stream's first watermark is the epoch: a window ending at or before
# 1970-01-01 00:00 is late from the start and never counted.
STREAM_WM_SQL = f"SELECT * FROM ({WM_SQL}) w WHERE window_end > TIMESTAMP '1970-01-01 00:00:00'"
STREAM_WMS_SQL = f"SELECT * FROM ({WMS_SQL}) w WHERE window_end > TIMESTAMP '1970-01-01 00:00:00'"
WMS_RAW_SQL = metrics_sql(("data_source", "source_topic", "greenhouse_id"), rounded=False)


# ------------------------------------------------------------ aggregation

def q_window_metrics(spark, sf):
    return _round_doubles(_metrics(spark, sf))


def q_window_metrics_by_source(spark, sf):
    return _round_doubles(_metrics_by_source(spark, sf))


def q_batch_millis_window_metrics(spark, sf):
    """Batch rows carrying epoch-millisecond time (the batch job's input shape)."""
    rows = sensor_events(spark, sf).withColumn("event_ts", F.unix_millis(utc_instant("event_time")))
    out = batch_window_metrics(rows.drop("event_time"), millis_col="event_ts")
    return _ntz(_round_doubles(out))


def q_window_metrics_rollup(spark, sf):
    """Greenhouse windows derived from the finest (source x topic x greenhouse) window sums."""
    fine = window_sums(sensor_events(spark, sf))
    return _round_doubles(finish_window_sums(rollup_window_sums(fine, GREENHOUSE_KEYS), GREENHOUSE_KEYS))


def q_epoch_millis_time(spark, sf):
    ev = load_table(spark, sf, "events")
    ms = F.unix_millis(utc_instant("ts"))
    return ev.select(
        "event_id",
        ms.alias("event_ts"),
        utc_wall_clock(epoch_millis_to_timestamp(ms)).alias("event_time"),
    )


# floor division to milliseconds, also before 1970 (DuckDB // truncates toward zero)
_FLOOR_MS = "((epoch_us(ts) - ((epoch_us(ts) % 1000) + 1000) % 1000) // 1000)"
EPOCH_MILLIS_SQL = (f"SELECT event_id, {_FLOOR_MS} AS event_ts, make_timestamp({_FLOOR_MS} * 1000) AS event_time "
                    f"FROM events")


# ------------------------------------------------------------ decode path

def _published(spark, sf) -> DataFrame:
    """Events as keyed JSON records; error events carry a broken payload,
    signup events an unparseable time, purchase events humidity as text."""
    ev = sensor_events(spark, sf, with_text_time=True)
    ev = ev.withColumn("event_ts", F.when(F.col("data_source") == "signup", F.lit("not-a-time"))
                       .otherwise(F.col("event_ts")))
    rec = to_keyed_records(ev)
    value = F.col("value")
    value = F.when(F.col("topic").startswith("error."), F.concat(F.lit("#"), value)).otherwise(value)
    value = F.when(F.col("topic").startswith("purchase."),
                   F.regexp_replace(value, r'"humidity_pct":([0-9.Ee+-]+)', '"humidity_pct":"$1"')).otherwise(value)
    return rec.withColumn("value", value)


DECODED_COLUMNS = ("event_id", "sensor_id", "greenhouse_id", "zone", "temperature_c", "humidity_pct", "co2_ppm",
                   "soil_moisture_pct", "light_lux", "data_source", "source_topic", "event_time")


def q_decode_events(spark, sf):
    dec = accepted(decode_events(_published(spark, sf)))
    return dec.select(
        *[F.col(c).cast("long") if c == "event_id" else
          (utc_wall_clock(c).alias(c) if c == "event_time" else F.col(c)) for c in DECODED_COLUMNS]
    )


def q_decode_rejects(spark, sf):
    rej = rejects(decode_events(_published(spark, sf), keep=("topic",)))
    return rej.groupBy("topic", "reject_reason").agg(F.count(F.lit(1)).alias("rows"))


DECODE_EVENTS_SQL = f"""
SELECT event_id, sensor_id, greenhouse_id, zone, temperature_c,
       CASE WHEN data_source = 'purchase' THEN NULL ELSE humidity_pct END AS humidity_pct,
       co2_ppm, soil_moisture_pct, light_lux, data_source, source_topic, event_time
FROM ({SENSOR_VIEW_SQL}) s
WHERE (data_source IS NULL OR data_source NOT IN ('error', 'signup')) AND event_time IS NOT NULL"""

DECODE_REJECTS_SQL = f"""
SELECT topic, reject_reason, count(*) AS rows FROM (
  SELECT source_topic AS topic,
         CASE WHEN data_source = 'error' THEN 'unparseable_payload'
              WHEN data_source = 'signup' THEN 'bad_event_ts'
              WHEN event_time IS NULL THEN 'missing_event_ts' END AS reject_reason
  FROM ({SENSOR_VIEW_SQL}) s) r
WHERE reject_reason IS NOT NULL
GROUP BY ALL"""


# ------------------------------------------------------ publish and print

def q_publish_records(spark, sf):
    return to_keyed_records(sensor_events(spark, sf, with_text_time=True))


def q_sent_log(spark, sf):
    return sent_log(sensor_events(spark, sf))


def q_formatted_rows(spark, sf):
    return formatted_rows(_metrics(spark, sf))


PUBLISH_SQL = f"""
SELECT greenhouse_id AS key,
       json_object('event_id', event_id, 'sensor_id', sensor_id, 'greenhouse_id', greenhouse_id, 'zone', zone,
                   'temperature_c', temperature_c, 'humidity_pct', humidity_pct, 'co2_ppm', co2_ppm,
                   'soil_moisture_pct', soil_moisture_pct, 'light_lux', light_lux, 'data_source', data_source,
                   'source_topic', source_topic,
                   'event_ts', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')::VARCHAR AS value,
       source_topic AS topic
FROM ({SENSOR_VIEW_SQL}) s"""

SENT_SQL = f"""
SELECT json_object('topic', source_topic, 'event_id', event_id, 'data_source', data_source,
                   'greenhouse_id', greenhouse_id, 'temperature_c', temperature_c,
                   'humidity_pct', humidity_pct)::VARCHAR AS sent
FROM ({SENSOR_VIEW_SQL}) s"""

FORMATTED_SQL = f"""
SELECT printf('  %s: %s - avg_temp=%s°C, events=%d', coalesce(greenhouse_id, 'null'),
              strftime(window_start, '%Y-%m-%d %H:%M:%S'),
              coalesce({sql_fixed2('avg_temperature')}, 'null'), event_count) AS line
FROM ({WM_RAW_SQL}) w"""


# ------------------------------------------------------ normalisation

_derived: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """A folder derived from the given tables, written once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _derived:
        path = scratch_path(spark, name)
        write(path)
        _derived[key] = path
    return _derived[key]


def _crop_csv(spark, sf) -> str:
    """customer -> crop CSV files, written in key order."""
    rows = FX.crop_csv_rows(load_table(spark, sf, "customer"))
    return _once(spark, sf, "crop_csv", lambda path: rows.orderBy("c_custkey").drop("c_custkey").write
                 .option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _crop_events(spark, sf) -> DataFrame:
    """Crop CSV files -> CSV scan with ordinals -> events."""
    return normalize_crop_rows(read_crop_csv(spark, _crop_csv(spark, sf)), ingest_time=_ingest())


INGEST_TEXT = "2024-02-01T00:00:00.000000+00:00"
CROP_COLUMNS = ("event_id", "sensor_id", "greenhouse_id", "zone", "temperature_c", "humidity_pct", "co2_ppm",
                "soil_moisture_pct", "light_lux", "data_source", "source_topic", "event_ts")


def q_crop_events(spark, sf):
    ev = _crop_events(spark, sf)
    return ev.select(*CROP_COLUMNS,
                     F.array_join("imputed", ",").alias("imputed"), "reject_reason")


def crop_sql(raw: str = FX.CROP_CSV_SQL, key: str = "event_id") -> str:
    """Events of crop rows; ``key`` is what imputed values are drawn from."""
    lo_hi = S.CROP_IMPUTE
    src = {"temperature_c": "avg_temperature_C", "humidity_pct": "humidity_percent", "co2_ppm": "co2_ppm",
           "soil_moisture_pct": "irrigation_mm", "light_lux": "light_intensity_lux"}
    vals, miss, bad = [], [], []
    def strip(x):  # Python strip(): all leading/trailing whitespace
        return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"

    for out, col in src.items():
        parsed = f"TRY_CAST(nullif({strip(col)}, '') AS DOUBLE)"
        missing = f"(nullif({col}, '') IS NULL)"  # blanks are not missing: they are no number
        given = parsed
        if out == "soil_moisture_pct":
            given = (f"CASE WHEN {parsed} IS NULL THEN NULL ELSE greatest({_d(S.SOIL_MIN)}, "
                     f"least({_d(S.SOIL_MAX)}, {parsed} * {_d(S.IRRIGATION_SCALE)})) END")
        lo, hi = lo_hi[out]
        vals.append(f"{sql_round(f'CASE WHEN {missing} THEN {sql_impute(out, lo, hi, key)} ELSE {given} END', 2)}"
                    f" AS {out}")
        miss.append(f"CASE WHEN {missing} THEN '{out}' END")
        bad.append(f"WHEN NOT {missing} AND {parsed} IS NULL THEN 'bad_number:{col}'")
    head = "split_part(coalesce(greenhouse_id, ''), '.', 1)"
    num = f"TRY_CAST({strip(head)} AS INTEGER)"
    gh_num = f"CASE WHEN {head} = '' THEN 1 WHEN {num} IS NULL THEN NULL ELSE greatest(1, {num}) END"
    greenhouses = "[" + ", ".join(f"'{g}'" for g in S.GREENHOUSES) + "]"
    zones = "[" + ", ".join(f"'{z}'" for z in S.ZONES) + "]"
    crop_type = f"lower(coalesce(nullif(crop_type, ''), '{S.CROP_TYPE_DEFAULT}'))"
    return f"""
WITH raw AS ({raw}),
p AS (SELECT *, {gh_num} AS gh_num FROM raw)
SELECT event_id,
       printf('crop-%s-%04d', {crop_type}, event_id) AS sensor_id,
       CASE WHEN gh_num IS NULL THEN NULL ELSE {greenhouses}[((gh_num - 1) % 3 + 3) % 3 + 1] END AS greenhouse_id,
       {zones}[{sql_hash_u32('zone', key)} % 4 + 1] AS zone,
       {', '.join(vals)},
       '{S.SOURCE_CSV}' AS data_source,
       '{S.TOPIC_CSV}' AS source_topic,
       '{INGEST_TEXT}' AS event_ts,
       concat_ws(',', {', '.join(miss)}) AS imputed,
       CASE WHEN gh_num IS NULL THEN 'bad_greenhouse_id' {' '.join(bad)} END AS reject_reason
FROM p"""


CROP_SQL = crop_sql()


def _responses(spark, sf) -> DataFrame:
    """(response_id, payload): weather-response texts derived from ``events``."""
    responses = FX.observation_responses(load_table(spark, sf, "events"))
    return spark.read.parquet(_once(spark, sf, "weather_responses", lambda path: responses.write.parquet(path)))


def _parsed_responses(spark, sf) -> DataFrame:
    """(response_id, observations array) from the weather-response texts derived from ``events``."""
    return _responses(spark, sf).select("response_id", parse_observation_array("payload").alias("observations"))


def _weather_events(spark, sf) -> DataFrame:
    return normalize_observations(_parsed_responses(spark, sf), id_col="response_id",
                                  greenhouse_id=FX.response_greenhouse(), ingest_time=_ingest())


WEATHER_COLUMNS = ("event_id", "sensor_id", "greenhouse_id", "zone", "temperature_c", "humidity_pct", "co2_ppm",
                   "soil_moisture_pct", "light_lux", "data_source", "source_topic", "event_ts")


def q_weather_events(spark, sf):
    ev = _weather_events(spark, sf)
    return ev.select(*WEATHER_COLUMNS,
                     F.array_join("imputed", ",").alias("imputed"), "reject_reason")


def _first_sql(keys) -> str:
    return "coalesce(" + ", ".join(f"TRY_CAST(replace({k}, ',', '.') AS DOUBLE)" for k in keys) + ")"


def _weather_sql() -> str:
    temp = _first_sql(S.WEATHER_TEMPERATURE_KEYS)
    hum = _first_sql(S.WEATHER_HUMIDITY_KEYS)
    light = _first_sql(S.WEATHER_LIGHT_KEYS)
    co2_lo, co2_hi = S.WEATHER_IMPUTE["co2_ppm"]
    soil_lo, soil_hi = S.WEATHER_IMPUTE["soil_moisture_pct"]
    return f"""
SELECT response_id AS event_id,
       '{S.WEATHER_SENSOR_PREFIX}' || idema AS sensor_id,
       CASE WHEN response_id % 2 = 0 THEN 'alm-nijar' ELSE '{S.GREENHOUSES[0]}' END AS greenhouse_id,
       '{S.WEATHER_ZONE}' AS zone,
       {sql_round(f'coalesce({temp}, {_d(S.WEATHER_TEMPERATURE_DEFAULT)})', 2)} AS temperature_c,
       {sql_round(f'coalesce({hum}, {_d(S.WEATHER_HUMIDITY_DEFAULT)})', 2)} AS humidity_pct,
       {sql_impute('co2_ppm', co2_lo, co2_hi, 'response_id')} AS co2_ppm,
       {sql_impute('soil_moisture_pct', soil_lo, soil_hi, 'response_id')} AS soil_moisture_pct,
       {sql_round(f'coalesce({light}, {_d(S.WEATHER_LIGHT_DEFAULT)}) * {_d(S.WEATHER_LIGHT_SCALE)}', 2)} AS light_lux,
       '{S.SOURCE_WEATHER}' AS data_source,
       '{S.TOPIC_WEATHER}' AS source_topic,
       '{INGEST_TEXT}' AS event_ts,
       concat_ws(',', CASE WHEN {temp} IS NULL THEN 'temperature_c' END,
                      CASE WHEN {hum} IS NULL THEN 'humidity_pct' END,
                      'co2_ppm', 'soil_moisture_pct',
                      CASE WHEN {light} IS NULL THEN 'light_lux' END) AS imputed,
       CASE WHEN empty THEN 'empty_observations' WHEN coalesce(trim(idema), '') = '' THEN 'missing_station' END AS reject_reason
FROM ({FX.OBSERVATION_LAST_SQL}) o"""


WEATHER_SQL = _weather_sql()


# Focused views of the two normalisers (one registered query per survey item).

def q_crop_ids(spark, sf):
    """NRM3/NRM4/NRM7/NRM11: ordinal, derived sensor id, greenhouse from the id text."""
    return q_crop_events(spark, sf).select("event_id", "sensor_id", "greenhouse_id", "reject_reason")


def q_crop_metrics(spark, sf):
    """NRM5/NRM6/NRM9: readings parsed, imputed when empty, irrigation scaled and clamped, rounded."""
    return q_crop_events(spark, sf).select("event_id", "temperature_c", "humidity_pct", "co2_ppm",
                                           "soil_moisture_pct", "light_lux")


def q_impute_flags(spark, sf):
    """NRM5/NRM8: which readings were filled, and the hashed zone pick."""
    return q_crop_events(spark, sf).select("event_id", "zone", "imputed")


def _last_observations(spark, sf) -> DataFrame:
    return _parsed_responses(spark, sf).select("response_id", latest_observation("observations").alias("last"))


def q_latest_observation(spark, sf):
    """NRM14: last array element by position; its readings as numbers."""
    last = _last_observations(spark, sf)
    num = {k: F.replace(F.col("last")[k], F.lit(","), F.lit(".")).try_cast("double").alias(k)
           for k in ("ta", "t", "hr", "hrMedia", "sol", "vis")}
    return last.select("response_id", F.col("last")["idema"].alias("idema"), *num.values())


def q_pick_first_float(spark, sf):
    """NRM12/NRM13: first candidate key that parses (decimal comma accepted); NULL when none does."""
    last = F.col("last")
    return _last_observations(spark, sf).select(
        "response_id",
        first_number([last[k] for k in S.WEATHER_TEMPERATURE_KEYS]).alias("temperature"),
        first_number([last[k] for k in S.WEATHER_HUMIDITY_KEYS]).alias("humidity"),
        first_number([last[k] for k in S.WEATHER_LIGHT_KEYS]).alias("light"),
    )


def q_loose_observations(spark, sf):
    """SRC4/NRM12 over loose objects: in every other response numbers stand unquoted beside texts; ``seq`` is in no schema."""
    numbers = F.regexp_replace("payload", r'"(t|tamax|hr|sol|vis)":"(-?[0-9]+(?:\.[0-9]+)?)"', '"$1":$2')
    mixed = _responses(spark, sf).select("response_id", F.when(F.col("response_id") % 2 == 0, numbers).otherwise(F.col("payload")).alias("payload"))
    loose = mixed.select("response_id", latest_observation(parse_loose_observations("payload")).alias("last"))

    def first(keys):
        return first_number([loose_reading(F.col("last"), k) for k in keys])

    return loose.select("response_id", loose_reading(F.col("last"), "seq", "long").alias("seq"), first(S.WEATHER_TEMPERATURE_KEYS).alias("temperature"),
                        first(S.WEATHER_HUMIDITY_KEYS).alias("humidity"), first(S.WEATHER_LIGHT_KEYS).alias("light"))


def q_obs_defaults(spark, sf):
    """NRM15/NRM16: defaults for missing readings, light x100, rounded."""
    return q_weather_events(spark, sf).select("event_id", "temperature_c", "humidity_pct", "light_lux")


def q_member_fallback(spark, sf):
    """NRM17: configured greenhouse if listed, else the first listed one."""
    return _responses(spark, sf).select(
        "response_id",
        FX.response_greenhouse().alias("configured"),
        member_or_first(FX.response_greenhouse(), S.GREENHOUSES).alias("greenhouse_id"),
    )


LATEST_OBSERVATION_SQL = f"""
SELECT response_id, idema,
       {', '.join(f"TRY_CAST(replace({k}, ',', '.') AS DOUBLE) AS {k}" for k in ("ta", "t", "hr", "hrMedia", "sol", "vis"))}
FROM ({FX.OBSERVATION_LAST_SQL}) o"""

PICK_FIRST_SQL = f"""
SELECT response_id,
       {_first_sql(S.WEATHER_TEMPERATURE_KEYS)} AS temperature,
       {_first_sql(S.WEATHER_HUMIDITY_KEYS)} AS humidity,
       {_first_sql(S.WEATHER_LIGHT_KEYS)} AS light
FROM ({FX.OBSERVATION_LAST_SQL}) o"""

LOOSE_OBSERVATIONS_SQL = f"""
SELECT p.response_id, CASE WHEN p.response_id % 17 <> 0 THEN s.seq END AS seq, temperature, humidity, light
FROM ({PICK_FIRST_SQL}) p JOIN (SELECT event_id // 8 AS response_id, max(event_id) AS seq FROM events GROUP BY 1) s ON s.response_id = p.response_id"""

MEMBER_FALLBACK_SQL = f"""
SELECT DISTINCT event_id // 8 AS response_id,
       CASE WHEN (event_id // 8) % 2 = 0 THEN 'alm-nijar' ELSE 'alm-unknown' END AS configured,
       CASE WHEN (event_id // 8) % 2 = 0 THEN 'alm-nijar' ELSE '{S.GREENHOUSES[0]}' END AS greenhouse_id
FROM events"""


UNION_COLUMNS = ("event_id", "sensor_id", "greenhouse_id", "temperature_c", "data_source", "source_topic")


def q_source_metadata_union(spark, sf):
    """Three sources in one frame: simulated (events), csv (customer), weather (events)."""
    sim = add_source_metadata(sensor_events(spark, sf).drop("data_source", "source_topic"),
                              S.SOURCE_SIMULATED, S.TOPIC_SIMULATED)
    crop = _crop_events(spark, sf).filter(F.col("reject_reason").isNull())
    weather = _weather_events(spark, sf).filter(F.col("reject_reason").isNull())
    return union_sources(*[f.select(*UNION_COLUMNS) for f in (sim, crop, weather)])


UNION_SQL = f"""
SELECT event_id, sensor_id, greenhouse_id, temperature_c,
       '{S.SOURCE_SIMULATED}' AS data_source, '{S.TOPIC_SIMULATED}' AS source_topic
FROM ({SENSOR_VIEW_SQL}) s
UNION ALL
SELECT event_id, sensor_id, greenhouse_id, temperature_c, data_source, source_topic
FROM ({CROP_SQL}) c WHERE reject_reason IS NULL
UNION ALL
SELECT event_id, sensor_id, greenhouse_id, temperature_c, data_source, source_topic
FROM ({WEATHER_SQL}) w WHERE reject_reason IS NULL"""


def q_row_ordinals(spark, sf):
    ev = with_file_ordinals(load_table(spark, sf, "events"), "ordinal")
    return ev.select("event_id", "ordinal")


ROW_ORDINALS_SQL = "SELECT event_id, row_number() OVER (ORDER BY event_id) AS ordinal FROM events"


# ------------------------------------------------------ keyed tables

def _upserted_by_source(spark, sf) -> UpsertTable:
    """Batch 0: a partial aggregate (click events missing); batch 1: the full
    aggregate, written twice (a replay).  The table must end as the full one."""
    def write(path: str) -> None:
        table = UpsertTable(path, S.WINDOW_METRICS_BY_SOURCE, run_id="stream")
        full = window_metrics_by_source(sensor_events(spark, sf)).checkpoint(eager=True)  # aggregated once, written twice
        table.write_batch(full.filter(F.col("data_source") != "click"), 0)
        table.write_batch(full, 1)
        table.write_batch(full, 1)

    return UpsertTable(_once(spark, sf, "tables_by_source", write), S.WINDOW_METRICS_BY_SOURCE, run_id="stream")


def q_compact_by_source(spark, sf):
    """The by-source table after compactions between its batches, and expiry of what they cover."""
    table = UpsertTable(scratch_path(spark, "tables", "compacted"), S.WINDOW_METRICS_BY_SOURCE)
    events = sensor_events(spark, sf)
    table.write_batch(window_metrics_by_source(events.filter("event_id % 2 = 0")), 0)
    table.compact(spark)
    table.write_batch(window_metrics_by_source(events), 1)
    table.compact(spark)
    table.expire(spark, grace_seconds=0)
    return _ntz(_round_doubles(table.latest(spark)))


# What each writer of the mixed table aggregates, in the order of their commits; the backfill yields to all others.
MIXED_WRITES = (("backfill", "event_id IS NOT NULL"), ("stream 0", "data_source = 'click'"), ("job", "data_source <> 'view'"),
                ("stream 1", "event_id % 3 = 0"), ("stream 2", "data_source = 'purchase'"))


def q_upsert_mixed_writers(spark, sf):
    """A stream, a batch job that starts last but writes in between, and a late backfill, with compactions between them."""
    root, events = scratch_path(spark, "tables", "mixed"), sensor_events(spark, sf)
    what = {name: window_metrics(events.filter(rule)) for name, rule in MIXED_WRITES}
    stream = UpsertTable(root, S.WINDOW_METRICS, run_id="a-stream")
    job = UpsertTable(root, S.WINDOW_METRICS, run_id="z-job")
    backfill = UpsertTable(root, S.WINDOW_METRICS, run_id="0-backfill", priority=BACKFILL)
    stream.write_batch(what["stream 0"], 0)
    stream.compact(spark)
    job.write_batch(what["job"], 0)
    stream.write_batch(what["stream 1"], 1)
    job.compact(spark)
    backfill.write_batch(what["backfill"], 0)
    backfill.compact(spark)
    stream.write_batch(what["stream 2"], 2)
    return _ntz(_round_doubles(stream.latest(spark)))


MIXED_SQL = f"""
SELECT greenhouse_id, window_start, window_end, avg_temperature, avg_humidity, avg_co2, event_count
FROM (SELECT *, row_number() OVER (PARTITION BY greenhouse_id, window_start ORDER BY writer DESC) AS rn
      FROM ({" UNION ALL ".join(f"SELECT *, {n} AS writer FROM ({metrics_sql(('greenhouse_id',)).replace('WHERE', f'WHERE ({rule}) AND', 1)}) w{n}"
                                for n, (_, rule) in enumerate(MIXED_WRITES))}) v)
WHERE rn = 1"""


def q_upsert_latest(spark, sf):
    return _ntz(_round_doubles(_upserted_by_source(spark, sf).latest(spark)))


def q_upsert_latest_legacy_key(spark, sf):
    table = _upserted_by_source(spark, sf)
    latest = table.latest(spark, key=S.LEGACY_BY_SOURCE_KEY, tie=("source_topic",))
    return _ntz(_round_doubles(latest))


LEGACY_SQL = f"""
SELECT data_source, source_topic, greenhouse_id, window_start, window_end,
       avg_temperature, avg_humidity, avg_co2, event_count
FROM (SELECT *, row_number() OVER (PARTITION BY data_source, window_start, greenhouse_id
                                   ORDER BY source_topic DESC) AS rn
      FROM ({WMS_SQL}) w) WHERE rn = 1"""


def q_table_count(spark, sf):
    """The health check: rows of the stored table."""
    return table_count(_stored_table(spark, sf, S.WINDOW_METRICS.name))


def q_table_head(spark, sf):
    """The first rows of the stored table in its key order."""
    head = table_head(_stored_table(spark, sf, S.WINDOW_METRICS.name), [F.col("greenhouse_id").asc(), F.col("window_start").desc()], 5)
    return _ntz(_round_doubles(head))


def q_upsert_retention(spark, sf):
    """Ten batch jobs, compactions among them, and expiry: the table's content, and two data folders left."""
    root, events = scratch_path(spark, "tables", "nightly"), sensor_events(spark, sf)
    for night in range(10):  # each night's events so far; the last job has them all
        table = run_batch_job(spark, events.filter(F.col("event_id") % 10 <= night), table_root=root, batch_id=night)
        if night in (4, 9):
            table.compact(spark)
            table.expire(spark, grace_seconds=0)
    folders = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.root}/data")
    kept = len(folders.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folders))
    return _ntz(_round_doubles(table.latest(spark))).withColumn("folders", F.lit(kept))


def q_table_row_order(spark, sf):
    """ORD1, ORD2: where the rows of both stored tables lie, as ranks by place within each partition key.

    Rows of one (window, greenhouse) of a source are in no set order, so each such group has its first place and its size.
    """
    root = _once(spark, sf, "ordered_tables", lambda path: [t.compact(spark) for t in run_batch_tables(spark, sensor_events(spark, sf), table_root=path).values()])
    out = []
    for spec in (S.WINDOW_METRICS, S.WINDOW_METRICS_BY_SOURCE):
        key = spec.partition_column
        places = stored_places(spark, open_table(root, spec.name))
        ranked = places.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("file", "row")))
        out.append(ranked.groupBy(F.lit(spec.name).alias("table_name"), F.col(key).alias("partition_key"), "window_start", "greenhouse_id").agg(
            F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n_rows")))
    return _ntz(union_sources(*out))


def _row_order_sql() -> str:
    parts = []
    for spec, sql in ((S.WINDOW_METRICS, WM_SQL), (S.WINDOW_METRICS_BY_SOURCE, WMS_SQL)):
        key = spec.partition_column
        order = ", ".join(f"{c} {'ASC NULLS FIRST' if asc else 'DESC NULLS LAST'}" for c, asc in spec.sort_order)
        parts.append(f"""
SELECT '{spec.name}' AS table_name, {key} AS partition_key, window_start, greenhouse_id, min(place) AS first_place, count(*) AS n_rows
FROM (SELECT *, CAST(rank() OVER (PARTITION BY {key} ORDER BY {order}) AS INTEGER) AS place FROM ({sql}) w) GROUP BY ALL""")
    return " UNION ALL ".join(parts)


TABLE_COUNT_SQL = f"SELECT count(*) AS row_count FROM ({WM_SQL}) w"
TABLE_HEAD_SQL = (f"SELECT * FROM ({WM_SQL}) w "
                  f"ORDER BY greenhouse_id ASC NULLS FIRST, window_start DESC NULLS LAST LIMIT 5")


# ------------------------------------------------------ streaming job, end to end

def _stream_table(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Records landed as files -> stream decode -> watermark/window -> upsert (availableNow)."""
    base = scratch_path(spark, "stream_run")
    landing = f"{base}/landing"
    events = sensor_events(spark, sf, with_text_time=True)
    to_keyed_records(events).write.parquet(landing)
    raw = read_events_stream(spark, fmt="parquet", path=landing)
    decoded = accepted(decode_events(raw, keep=("topic",)))
    queries = start_table_queries(decoded, f"{base}/tables", f"{base}/checkpoints", trigger="availableNow",
                                  tables=(table,))
    for q in queries.values():
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {table} failed: {q.exception()}")
    return _ntz(_round_doubles(read_table(spark, f"{base}/tables", table)))


def q_stream_window_metrics(spark, sf):
    return _stream_table(spark, sf, S.WINDOW_METRICS.name)


def q_stream_window_metrics_by_source(spark, sf):
    return _stream_table(spark, sf, S.WINDOW_METRICS_BY_SOURCE.name)


# Records land in three slices by event time (the bounds cut through a window); the error events come late, with the
# last slice.  The stream runs until it has drained a slice, stops, and restarts from its checkpoint for the next.
SLICES = (datetime(2024, 1, 11, 0, 2, 30), datetime(2024, 1, 21, 0, 2, 30))


def _sliced_stream(spark: SparkSession, sf: str, tables: tuple[str, ...]) -> str:
    base = scratch_path(spark, "stream_slices")
    events = sensor_events(spark, sf, with_text_time=True)
    first, second = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in SLICES)
    late = F.col("data_source").eqNullSafe("error")
    time = F.col("event_time").cast("timestamp_ntz")
    slices = (~late & (time < first), ~late & (time >= first) & (time < second),
              late | time.isNull() | (time >= second))
    for rows in slices:
        to_keyed_records(events.filter(rows)).write.mode("append").parquet(f"{base}/landing")
        raw = read_events_stream(spark, fmt="parquet", path=f"{base}/landing")
        decoded = accepted(decode_events(raw, keep=("topic",)))
        running = start_table_queries(decoded, f"{base}/tables", f"{base}/checkpoints", trigger="availableNow", tables=tables)
        for q in running.values():
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"stream failed: {q.exception()}")
    return f"{base}/tables"


def q_stream_late_rows(spark, sf):
    """Late drop, repeated updates of one window, eviction and recovery: the table after three runs of one stream."""
    return _ntz(_round_doubles(read_table(spark, _sliced_stream(spark, sf, (S.WINDOW_METRICS.name,)), S.WINDOW_METRICS.name)))


def q_stream_two_tables_restart(spark, sf):
    """Both tables' queries side by side over the same runs."""
    root = _sliced_stream(spark, sf, TABLE_NAMES)
    frames = [read_table(spark, root, n).select(F.lit(n).alias("table_name"), "greenhouse_id", "window_start", "event_count")
              for n in TABLE_NAMES]
    return _ntz(union_sources(*frames))


def _late_sql(keys: tuple[str, ...]) -> str:
    """Rows of a slice count unless their window ended by the watermark that the slices before left (2 minutes, in ms)."""
    a, b = (_ts(t) for t in SLICES)
    mark = "date_trunc('milliseconds', max(event_time)) - INTERVAL 2 MINUTES"
    kept = f"""
SELECT s.* EXCLUDE (slice) FROM (
  SELECT *, CASE WHEN coalesce(data_source = 'error', false) OR event_time >= {b} THEN 3 WHEN event_time >= {a} THEN 2 ELSE 1 END AS slice
  FROM ({SENSOR_VIEW_SQL}) v WHERE event_time IS NOT NULL) s,
 (SELECT greatest(TIMESTAMP '1970-01-01', coalesce({mark}, TIMESTAMP '1970-01-01')) AS one
  FROM ({SENSOR_VIEW_SQL}) v WHERE data_source IS DISTINCT FROM 'error' AND event_time < {a}),
 (SELECT greatest(TIMESTAMP '1970-01-01', coalesce({mark}, TIMESTAMP '1970-01-01')) AS two
  FROM ({SENSOR_VIEW_SQL}) v WHERE data_source IS DISTINCT FROM 'error' AND event_time < {b})
WHERE time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES
      > CASE slice WHEN 1 THEN TIMESTAMP '1970-01-01' WHEN 2 THEN one ELSE two END"""
    return metrics_sql(keys).replace(SENSOR_VIEW_SQL, kept)


TWO_TABLES_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, greenhouse_id, window_start, event_count FROM ({_late_sql(k)}) {n}"
    for n, k in ((S.WINDOW_METRICS.name, ("greenhouse_id",)),
                 (S.WINDOW_METRICS_BY_SOURCE.name, ("data_source", "source_topic", "greenhouse_id"))))


# ------------------------------------------------------ sources, sinks and caps by themselves

def q_capped_events(spark, sf):
    """FLT6: at most 500 events, the first by id; 0 caps nothing."""
    events = load_table(spark, sf, "events").select("event_id")
    capped = cap_rows(events.orderBy("event_id"), 500).withColumn("cap", F.lit(500))
    return capped.unionByName(cap_rows(events, 0).withColumn("cap", F.lit(0)))


def q_batch_millis_rejects(spark, sf):
    """Batch rows without a usable time, by reason: NULL times, and signups that carry seconds far out of range."""
    rows = sensor_events(spark, sf).withColumn("event_ts", F.unix_millis(utc_instant("event_time")))
    broken = rows.withColumn("event_ts", F.when(F.col("data_source") == "signup", F.lit(10**17)).when(F.col("data_source") != "view", F.col("event_ts")))
    return batch_rejects(broken.drop("event_time")).groupBy("data_source", "reject_reason").agg(F.count("*").alias("n_rows"))


BATCH_REJECTS_SQL = f"""
SELECT data_source, CASE WHEN data_source = 'signup' THEN 'bad_event_ts' ELSE 'missing_event_ts' END AS reject_reason, count(*) AS n_rows
FROM ({SENSOR_VIEW_SQL}) s
WHERE data_source = 'signup' OR data_source = 'view' OR data_source IS NULL OR event_time IS NULL
GROUP BY ALL"""


def q_decode_binary(spark, sf):
    """PRJ1: records as the broker delivers them, keys and values as bytes; written with the record writer and read back."""
    def write(path: str) -> None:
        records = _published(spark, sf)
        write_records(records.select(F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"), "topic"), "parquet", path)

    dec = accepted(decode_events(spark.read.parquet(_once(spark, sf, "binary_records", write))))
    return dec.select(*[F.col(c).cast("long") if c == "event_id" else
                        (utc_wall_clock(c).alias(c) if c == "event_time" else F.col(c)) for c in DECODED_COLUMNS])


def q_observation_files(spark, sf):
    """SRC4: response files, each one JSON array (landed here as one text file per stretch of responses)."""
    landed = _once(spark, sf, "response_files", lambda path: _responses(spark, sf).select("payload").write.text(path))
    lines = spark.read.text(landed).select(parse_observation_array("value").alias("o"))
    return lines.select(F.size("o").alias("n_observations"), latest_observation("o")["idema"].alias("idema")).groupBy(
        "n_observations", "idema").agg(F.count("*").alias("n_responses"))


OBSERVATION_FILES_SQL = f"""
SELECT n_observations, idema, count(*) AS n_responses
FROM (SELECT CASE WHEN r.empty THEN 0 ELSE n END::INTEGER AS n_observations, r.idema
      FROM ({FX.OBSERVATION_LAST_SQL}) r JOIN (SELECT event_id // 8 AS response_id, count(*) AS n FROM events GROUP BY 1) c USING (response_id))
GROUP BY ALL"""


def q_stream_crop_csv(spark, sf):
    """SRC5: the crop CSV folder as a stream -> normalised -> published records -> decoded again."""
    base = scratch_path(spark, "crop_stream")
    header = read_crop_header(spark, _crop_csv(spark, sf))
    q = start_crop_ingest(spark, _crop_csv(spark, sf), f"{base}/checkpoint", path=f"{base}/records", header_columns=header,
                          ingest_time=_ingest(), trigger_available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"crop ingest failed: {q.exception()}")
    decoded = decode_events(spark.read.parquet(f"{base}/records"))
    return decoded.groupBy("greenhouse_id", "event_ts", "source_topic").agg(F.count("*").alias("n_events"))


CROP_STREAM_SQL = f"""
SELECT greenhouse_id, event_ts, source_topic, count(*) AS n_events FROM ({CROP_SQL}) c WHERE reject_reason IS NULL GROUP BY ALL"""


def q_batch_schema_rows(spark, sf):
    """SRC2: batch rows read with their declared schema -> the batch job -> its table."""
    def write(path: str) -> None:
        rows = sensor_events(spark, sf).withColumn("event_ts", F.unix_millis(utc_instant("event_time")))
        names = [f.name for f in S.BATCH_EVENT_SCHEMA.fields]
        rows.select(*[F.col(n) for n in names]).write.json(path)

    rows = spark.read.schema(S.BATCH_EVENT_SCHEMA).json(_once(spark, sf, "batch_rows", write))
    table = run_batch_job(spark, rows, table_root=scratch_path(spark, "tables"), millis_col="event_ts")
    return _ntz(_round_doubles(table.latest(spark)))


# ------------------------------------------------------ dashboard panels

def _stored_table(spark, sf, name: str) -> DataFrame:
    """One of the two keyed tables as the backfill of ``events`` leaves it (written once per session)."""
    root = _once(spark, sf, "panel_tables", lambda path: run_batch_tables(spark, sensor_events(spark, sf), table_root=path))
    return read_table(spark, root, name)


def _selected(spec) -> tuple[str, ...]:
    return SELECTED_GREENHOUSES if spec.filter_col == "greenhouse_id" else SELECTED_SOURCES


def _panel_query(pid: int) -> QueryFn:
    spec = PANELS[pid]
    return lambda spark, sf: _round_doubles(panel_at(_stored_table(spark, sf, spec.table), spec, _selected(spec), AS_OF))


def _series_query(pid: int) -> QueryFn:
    """The points that a trend panel plots."""
    spec = PANELS[pid]
    return lambda spark, sf: _ntz(_round_doubles(
        panel_frame(_stored_table(spark, sf, spec.table), spec, _selected(spec), RANGE_LO, AS_OF)), ("time",))


def _series_sql(pid: int) -> str:
    spec = PANELS[pid]
    base = WM_RAW_SQL if spec.table == "window_metrics" else WMS_RAW_SQL
    sel = ", ".join(f"'{x}'" for x in _selected(spec))
    value = spec.value if spec.value == "event_count" else sql_r6(spec.value)
    return f"""
SELECT {spec.series} AS series, {value} AS value, window_start AS time FROM ({base}) w
WHERE {spec.filter_col} IN ({sel}) AND window_start > {_ts(RANGE_LO)} AND window_start < {_ts(AS_OF)}"""


def q_panel_01_raw(spark, sf):
    """Panel 1 over raw events: the time range reaches the scan before the aggregate."""
    events = events_of_range(sensor_events(spark, sf), RANGE_LO, AS_OF)
    return _round_doubles(panel(window_metrics(events), PANELS[1], SELECTED_GREENHOUSES, RANGE_LO, AS_OF))


def _panel_sql(pid: int) -> str:
    spec = PANELS[pid]
    base = WM_RAW_SQL if spec.table == "window_metrics" else WMS_RAW_SQL
    selected = SELECTED_GREENHOUSES if spec.filter_col == "greenhouse_id" else SELECTED_SOURCES
    sel = ", ".join(f"'{s}'" for s in selected)
    v = spec.value
    order = ", ".join(f"{c} DESC" for c in ("window_start", *spec.tie))
    is_double = v != "event_count"
    rnd = sql_r6 if is_double else (lambda e: e)
    aggs = []
    for r in spec.reducers:
        if r == "mean":
            aggs.append((sql_r6(f"avg({v})"), "mean_value"))
        elif r == "max":
            aggs.append((rnd(f"max({v})"), "max_value"))
    agg_cols = "".join(f", {e} AS {n}" for e, n in aggs)
    picked = "".join(f", a.{n}" for _, n in aggs)
    band = f", {sql_band('l.v', spec.bands)} AS band" if spec.bands else ""
    return f"""
WITH f AS (SELECT * FROM ({base}) w
           WHERE {spec.filter_col} IN ({sel})
             AND window_start > {_ts(RANGE_LO)} AND window_start < {_ts(AS_OF)}),
a AS (SELECT {spec.series} AS series{agg_cols} FROM f GROUP BY ALL),
l AS (SELECT series, v FROM (
        SELECT {spec.series} AS series, {v} AS v, row_number() OVER (PARTITION BY {spec.series} ORDER BY {order}) AS rn
        FROM f WHERE {v} IS NOT NULL) WHERE rn = 1)
SELECT a.series, {rnd('l.v')} AS last_value{picked}{band}
FROM a LEFT JOIN l ON a.series = l.series"""


def q_table_panel_01(spark, sf):
    """Panel 1 through the stored table: AGG1 written as a batch, read back via the latest view."""
    root = scratch_path(spark, "tables")
    run_batch_job(spark, sensor_events(spark, sf), table_root=root, batch_id=0)
    table = read_table(spark, root, S.WINDOW_METRICS.name)
    return _round_doubles(panel(table, PANELS[1], SELECTED_GREENHOUSES, RANGE_LO, AS_OF))


def q_panel_12_detail(spark, sf):
    return _ntz(_round_doubles(detail_table(_stored_table(spark, sf, S.WINDOW_METRICS.name), SELECTED_GREENHOUSES, RANGE_LO, AS_OF)))


def _detail_sql() -> str:
    from verdant.plans.panels import DETAIL_BANDS
    sel = ", ".join(f"'{s}'" for s in SELECTED_GREENHOUSES)
    bands = ", ".join(f"{sql_band(c, DETAIL_BANDS)} AS {c}_band"
                      for c in ("avg_temperature", "avg_humidity", "avg_co2", "event_count"))
    return f"""
SELECT greenhouse_id, window_start, {sql_r6('avg_temperature')} AS avg_temperature,
       {sql_r6('avg_humidity')} AS avg_humidity, {sql_r6('avg_co2')} AS avg_co2, event_count, {bands}
FROM ({WM_RAW_SQL}) w
WHERE greenhouse_id IN ({sel}) AND window_start > {_ts(RANGE_LO)} AND window_start < {_ts(AS_OF)}"""


DETAIL_SQL = _detail_sql()


def q_detail_footer(spark, sf):
    detail = detail_table(_stored_table(spark, sf, S.WINDOW_METRICS.name), SELECTED_GREENHOUSES, RANGE_LO, AS_OF)
    return _round_doubles(column_sums(detail, ("avg_temperature", "avg_humidity", "avg_co2", "event_count")))


def _footer_sql() -> str:
    sel = ", ".join(f"'{s}'" for s in SELECTED_GREENHOUSES)
    return f"""
SELECT {sql_r6('sum(avg_temperature)')} AS sum_avg_temperature, {sql_r6('sum(avg_humidity)')} AS sum_avg_humidity,
       {sql_r6('sum(avg_co2)')} AS sum_avg_co2, CAST(sum(event_count) AS BIGINT) AS sum_event_count
FROM ({WM_RAW_SQL}) w
WHERE greenhouse_id IN ({sel}) AND window_start > {_ts(RANGE_LO)} AND window_start < {_ts(AS_OF)}"""


def q_panel_09_rollup(spark, sf):
    rows = panel_rows(_stored_table(spark, sf, S.WINDOW_METRICS_BY_SOURCE.name), PANELS[9], SELECTED_SOURCES, RANGE_LO, AS_OF)
    return _ntz(_round_doubles(weighted_rollup(rows, "data_source")))


def _rollup_sql() -> str:
    sel = ", ".join(f"'{s}'" for s in SELECTED_SOURCES)

    def wavg(c):
        return sql_r6(f"sum({c} * event_count) / sum(CASE WHEN {c} IS NOT NULL THEN event_count END)")

    return f"""
SELECT data_source AS series, window_start, {wavg('avg_temperature')} AS avg_temperature,
       {wavg('avg_humidity')} AS avg_humidity, {wavg('avg_co2')} AS avg_co2,
       CAST(sum(event_count) AS BIGINT) AS event_count
FROM ({WMS_RAW_SQL}) w
WHERE data_source IN ({sel}) AND window_start > {_ts(RANGE_LO)} AND window_start < {_ts(AS_OF)}
GROUP BY ALL"""


# ------------------------------------------------------------ registry

def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {
        "window_metrics": q_window_metrics,
        "window_metrics_by_source": q_window_metrics_by_source,
        "batch_millis_window_metrics": q_batch_millis_window_metrics,
        "window_metrics_rollup": q_window_metrics_rollup,
        "epoch_millis_time": q_epoch_millis_time,
        "decode_events": q_decode_events,
        "decode_rejects": q_decode_rejects,
        "publish_records": q_publish_records,
        "sent_log": q_sent_log,
        "formatted_rows": q_formatted_rows,
        "crop_events": q_crop_events,
        "weather_events": q_weather_events,
        "crop_ids": q_crop_ids,
        "crop_metrics": q_crop_metrics,
        "impute_flags": q_impute_flags,
        "latest_observation": q_latest_observation,
        "pick_first_float": q_pick_first_float,
        "loose_observations": q_loose_observations,
        "obs_defaults": q_obs_defaults,
        "member_fallback": q_member_fallback,
        "source_metadata_union": q_source_metadata_union,
        "row_ordinals": q_row_ordinals,
        "upsert_latest": q_upsert_latest,
        "upsert_latest_legacy_key": q_upsert_latest_legacy_key,
        "table_count": q_table_count,
        "table_head": q_table_head,
        "stream_window_metrics": q_stream_window_metrics,
        "stream_window_metrics_by_source": q_stream_window_metrics_by_source,
        "compact_by_source": q_compact_by_source,
        "upsert_mixed_writers": q_upsert_mixed_writers,
        "upsert_retention": q_upsert_retention,
        "table_row_order": q_table_row_order,
        "stream_late_rows": q_stream_late_rows,
        "stream_two_tables_restart": q_stream_two_tables_restart,
        "capped_events": q_capped_events,
        "batch_millis_rejects": q_batch_millis_rejects,
        "decode_binary": q_decode_binary,
        "observation_files": q_observation_files,
        "stream_crop_csv": q_stream_crop_csv,
        "batch_schema_rows": q_batch_schema_rows,
        "panel_01_raw": q_panel_01_raw,
    }
    for pid in TREND_PANELS:
        out[f"panel_{pid:02d}_series"] = _series_query(pid)
    for pid in sorted(PANELS):
        out[f"panel_{pid:02d}"] = _panel_query(pid)
    out["panel_09_rollup"] = q_panel_09_rollup
    out["panel_12_detail"] = q_panel_12_detail
    out["table_panel_01"] = q_table_panel_01
    out["detail_footer"] = q_detail_footer
    from verdant.plans import live  # needs this module's helpers

    return out | live.queries()


def oracle_sql() -> dict[str, str]:
    out = {
        "window_metrics": WM_SQL,
        "window_metrics_by_source": WMS_SQL,
        "batch_millis_window_metrics": WM_SQL,
        "window_metrics_rollup": WM_SQL,
        "epoch_millis_time": EPOCH_MILLIS_SQL,
        "decode_events": DECODE_EVENTS_SQL,
        "decode_rejects": DECODE_REJECTS_SQL,
        "publish_records": PUBLISH_SQL,
        "sent_log": SENT_SQL,
        "formatted_rows": FORMATTED_SQL,
        "crop_events": CROP_SQL,
        "weather_events": WEATHER_SQL,
        "crop_ids": f"SELECT event_id, sensor_id, greenhouse_id, reject_reason FROM ({CROP_SQL}) c",
        "crop_metrics": (f"SELECT event_id, temperature_c, humidity_pct, co2_ppm, soil_moisture_pct, light_lux "
                         f"FROM ({CROP_SQL}) c"),
        "impute_flags": f"SELECT event_id, zone, imputed FROM ({CROP_SQL}) c",
        "latest_observation": LATEST_OBSERVATION_SQL,
        "pick_first_float": PICK_FIRST_SQL,
        "loose_observations": LOOSE_OBSERVATIONS_SQL,
        "obs_defaults": f"SELECT event_id, temperature_c, humidity_pct, light_lux FROM ({WEATHER_SQL}) w",
        "member_fallback": MEMBER_FALLBACK_SQL,
        "source_metadata_union": UNION_SQL,
        "row_ordinals": ROW_ORDINALS_SQL,
        "upsert_latest": WMS_SQL,
        "upsert_latest_legacy_key": LEGACY_SQL,
        "table_count": TABLE_COUNT_SQL,
        "table_head": TABLE_HEAD_SQL,
        "stream_window_metrics": STREAM_WM_SQL,
        "stream_window_metrics_by_source": STREAM_WMS_SQL,
        "compact_by_source": WMS_SQL,
        "upsert_mixed_writers": MIXED_SQL,
        "upsert_retention": f"SELECT *, 2 AS folders FROM ({WM_SQL}) w",
        "table_row_order": _row_order_sql(),
        "stream_late_rows": _late_sql(("greenhouse_id",)),
        "stream_two_tables_restart": TWO_TABLES_SQL,
        "capped_events": ("SELECT event_id, 500 AS cap FROM (SELECT event_id FROM events ORDER BY event_id LIMIT 500) "
                          "UNION ALL SELECT event_id, 0 AS cap FROM events"),
        "batch_millis_rejects": BATCH_REJECTS_SQL,
        "decode_binary": DECODE_EVENTS_SQL,
        "observation_files": OBSERVATION_FILES_SQL,
        "stream_crop_csv": CROP_STREAM_SQL,
        "batch_schema_rows": WM_SQL,
        "panel_01_raw": _panel_sql(1),
    }
    for pid in TREND_PANELS:
        out[f"panel_{pid:02d}_series"] = _series_sql(pid)
    for pid in sorted(PANELS):
        out[f"panel_{pid:02d}"] = _panel_sql(pid)
    out["panel_09_rollup"] = _rollup_sql()
    out["panel_12_detail"] = DETAIL_SQL
    out["table_panel_01"] = _panel_sql(1)
    out["detail_footer"] = _footer_sql()
    from verdant.plans import live

    return out | live.oracle_sql()


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Events -> keyed JSON records -> decode -> 5-minute window metrics (one lazy plan)."""
    ev = sensor_events(spark, sf, with_text_time=True)
    decoded = accepted(decode_events(to_keyed_records(ev)))
    return _ntz(window_metrics(decoded))


__all__ = ["queries", "oracle_sql", "flagship"]

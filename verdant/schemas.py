"""Schemas, table keys and the fixed domain values of the telemetry pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the upstream producers, jobs and
# dashboard use, so that ids, topics, panels and thresholds line up.
# ---------------------------------------------------------------------------
TOPIC_SIMULATED = "greenhouse.sensors.simulated"
TOPIC_CSV = "greenhouse.sensors.csv"
TOPIC_WEATHER = "greenhouse.sensors.aemet"
TOPIC_LEGACY = "greenhouse.sensors"  # older producer's topic: not subscribed by default

SOURCE_SIMULATED = "simulated"
SOURCE_CSV = "csv"
SOURCE_WEATHER = "aemet"

GREENHOUSES = ("alm-poniente", "alm-nijar", "alm-levante")
ZONES = ("el-ejido", "roquetas", "nijar", "adra")
WEATHER_ZONE = "almeria-outdoor"
WEATHER_SENSOR_PREFIX = "aemet-"
CROP_SENSOR_PREFIX = "crop-"
CROP_TYPE_DEFAULT = "sensor"

# Weather observation candidate keys, in priority order.
WEATHER_TEMPERATURE_KEYS = ("ta", "t", "tamax", "tpr")
WEATHER_HUMIDITY_KEYS = ("hr", "h", "hrMedia")
WEATHER_LIGHT_KEYS = ("sol", "vis")
# Defaults when no candidate key gives a number; light is then scaled x100.
WEATHER_TEMPERATURE_DEFAULT = 22.0
WEATHER_HUMIDITY_DEFAULT = 65.0
WEATHER_LIGHT_DEFAULT = 12000.0
WEATHER_LIGHT_SCALE = 100.0

# Imputation ranges (low, high) for readings missing in a source row.
CROP_IMPUTE = {
    "temperature_c": (17.0, 34.0),
    "humidity_pct": (38.0, 90.0),
    "co2_ppm": (350.0, 1400.0),
    "light_lux": (1000.0, 45000.0),
    "soil_moisture_pct": (15.0, 70.0),
}
WEATHER_IMPUTE = {
    "co2_ppm": (380.0, 520.0),
    "soil_moisture_pct": (20.0, 55.0),
}
# Irrigation (mm) -> soil moisture (%): scale, then clamp.
IRRIGATION_SCALE = 6.0
SOIL_MIN = 5.0
SOIL_MAX = 90.0

# Window and lateness of the aggregation jobs.
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "2 minutes"
# ---------------------------------------------------------------------------

ALL_TOPICS = (TOPIC_SIMULATED, TOPIC_CSV, TOPIC_WEATHER)

# Keyed JSON event as carried on a topic (all fields nullable in practice:
# from_json never enforces nullability).
STREAM_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.IntegerType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("greenhouse_id", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("co2_ppm", T.DoubleType()),
        T.StructField("soil_moisture_pct", T.DoubleType()),
        T.StructField("light_lux", T.DoubleType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("event_ts", T.StringType()),
    ]
)
STREAM_EVENT_FIELDS = tuple(f.name for f in STREAM_EVENT_SCHEMA.fields)

# Batch event: epoch-millisecond time, no id or provenance fields.
BATCH_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("greenhouse_id", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("humidity_pct", T.DoubleType()),
        T.StructField("co2_ppm", T.DoubleType()),
        T.StructField("soil_moisture_pct", T.DoubleType()),
        T.StructField("light_lux", T.DoubleType()),
        T.StructField("event_ts", T.LongType()),
    ]
)

# Crop CSV: header-driven, every column read as text.
CROP_CSV_COLUMNS = (
    "greenhouse_id",
    "crop_type",
    "avg_temperature_C",
    "humidity_percent",
    "co2_ppm",
    "light_intensity_lux",
    "irrigation_mm",
)
CROP_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CROP_CSV_COLUMNS])

# One weather observation: loosely typed values, so each is read as text
# (JSON numbers keep their literal text under a string field).
OBSERVATION_KEYS = ("idema",) + WEATHER_TEMPERATURE_KEYS + WEATHER_HUMIDITY_KEYS + WEATHER_LIGHT_KEYS
OBSERVATION_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in OBSERVATION_KEYS])
OBSERVATION_ARRAY_SCHEMA = T.ArrayType(OBSERVATION_SCHEMA)

_AGG_VALUE_FIELDS = [
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("avg_temperature", T.DoubleType()),
    T.StructField("avg_humidity", T.DoubleType()),
    T.StructField("avg_co2", T.DoubleType()),
    T.StructField("event_count", T.LongType()),
]

WINDOW_METRICS_SCHEMA = T.StructType([T.StructField("greenhouse_id", T.StringType())] + _AGG_VALUE_FIELDS)
WINDOW_METRICS_BY_SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("data_source", T.StringType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("greenhouse_id", T.StringType()),
    ]
    + _AGG_VALUE_FIELDS
)


class TableSpec:
    """Keyed aggregate table: primary key, storage partition column, sort order."""

    def __init__(self, name, schema, primary_key, partition_column, sort_order):
        self.name = name
        self.schema = schema
        self.primary_key = tuple(primary_key)
        self.partition_column = partition_column
        # (column, ascending) pairs inside a partition
        self.sort_order = tuple(sort_order)

    @property
    def columns(self):
        return tuple(f.name for f in self.schema.fields)


WINDOW_METRICS = TableSpec(
    "window_metrics",
    WINDOW_METRICS_SCHEMA,
    primary_key=("greenhouse_id", "window_start"),
    partition_column="greenhouse_id",
    sort_order=(("window_start", False),),
)

# The by-source table keys on source_topic too, so two topics of one source
# never overwrite each other; LEGACY_BY_SOURCE keeps the three-column key.
WINDOW_METRICS_BY_SOURCE = TableSpec(
    "window_metrics_by_source",
    WINDOW_METRICS_BY_SOURCE_SCHEMA,
    primary_key=("data_source", "source_topic", "window_start", "greenhouse_id"),
    partition_column="data_source",
    sort_order=(("window_start", False), ("greenhouse_id", True)),
)
# Both tables in one, for a job that writes them by one commit; columns a table does not have are NULL.
WINDOW_TABLES = TableSpec(
    "window_tables",
    T.StructType([T.StructField("table_name", T.StringType())] + WINDOW_METRICS_BY_SOURCE_SCHEMA.fields),
    primary_key=("table_name", "data_source", "source_topic", "greenhouse_id", "window_start"),
    partition_column="table_name",
    sort_order=(("window_start", False), ("data_source", True), ("greenhouse_id", True)),
)
LEGACY_BY_SOURCE_KEY = ("data_source", "window_start", "greenhouse_id")

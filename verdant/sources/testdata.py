"""The provided test tables and the sensor-event view over ``events``.

``events(event_id, ts, user_id, event_type, value, props)`` is mapped onto
the 12-field sensor event so that every operator runs on the real table:

* greenhouse ``gh-<pmod(user_id, 3)>``, sensor ``sensor-<pmod(user_id, 80) + 1, 3 digits>``,
  zone = zones[pmod(user_id, 4)]
* data_source = event_type; source_topic = ``<event_type>.<event_id mod 2>``
* temperature = value, humidity = props.k, co2 = 350 + 2 * value,
  soil = value / 4, light = value * 100
* event_time = ts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant import schemas as S
from verdant.functions.decode import timestamp_to_iso_text


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_view(events: DataFrame, with_text_time: bool = False) -> DataFrame:
    """Sensor events over the ``events`` table (time keeps the table's type)."""
    zones = F.array(*[F.lit(z) for z in S.ZONES])
    uid = F.col("user_id")
    cols = [
        F.col("event_id"),
        F.when(uid.isNotNull(), F.format_string("sensor-%03d", F.pmod(uid, F.lit(80)) + 1)).alias("sensor_id"),
        F.concat(F.lit("gh-"), F.pmod(uid, F.lit(3)).cast("string")).alias("greenhouse_id"),
        # guarded: element_at on a literal array returns its last element for a
        # NULL computed index (observed on Spark 4.1.2)
        F.when(uid.isNotNull(), F.element_at(zones, (F.pmod(uid, F.lit(4)) + 1).try_cast("int"))).alias("zone"),
        F.col("value").alias("temperature_c"),
        F.get_json_object("props", "$.k").try_cast("double").alias("humidity_pct"),
        (F.lit(350.0) + F.lit(2.0) * F.col("value")).alias("co2_ppm"),
        (F.col("value") / F.lit(4.0)).alias("soil_moisture_pct"),
        (F.col("value") * F.lit(100.0)).alias("light_lux"),
        F.col("event_type").alias("data_source"),
        F.concat(F.col("event_type"), F.lit("."), (F.col("event_id") % 2).cast("string")).alias("source_topic"),
    ]
    if with_text_time:
        naive = not isinstance(events.schema["ts"].dataType, T.TimestampType)
        cols.append(timestamp_to_iso_text(F.col("ts"), is_utc_wall_clock=naive).alias("event_ts"))
    cols.append(F.col("ts").alias("event_time"))
    return events.select(*cols)


def sensor_events(spark: SparkSession, sf_dir: str, with_text_time: bool = False) -> DataFrame:
    return sensor_view(load_table(spark, sf_dir, "events"), with_text_time)


# The same view in DuckDB SQL, for the oracle queries.
SENSOR_VIEW_SQL = """
SELECT event_id,
       printf('sensor-%03d', ((user_id % 80) + 80) % 80 + 1) AS sensor_id,
       'gh-' || CAST(((user_id % 3) + 3) % 3 AS VARCHAR) AS greenhouse_id,
       ['el-ejido', 'roquetas', 'nijar', 'adra'][((user_id % 4) + 4) % 4 + 1] AS zone,
       value AS temperature_c,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity_pct,
       350.0 + 2.0 * value AS co2_ppm,
       value / 4.0 AS soil_moisture_pct,
       value * 100.0 AS light_lux,
       event_type AS data_source,
       event_type || '.' || CAST(event_id % 2 AS VARCHAR) AS source_topic,
       ts AS event_time
FROM events
"""

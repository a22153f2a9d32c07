"""Weather responses: files that each hold one JSON array of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant import schemas as S


def parse_observation_array(text_col) -> "F.Column":
    """JSON array text -> array<struct> of loosely typed (text) readings."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.from_json(c, S.OBSERVATION_ARRAY_SCHEMA)


def parse_loose_observations(text_col) -> "F.Column":
    """JSON array text -> array<variant>: readings of any JSON type, and keys that no schema names.

    Text that is no JSON, or no array, gives NULL; elements that are no objects have no readings.
    """
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")


def loose_reading(observation, key: str, kind: str = "string") -> "F.Column":
    """One reading of a variant observation (by default as text, numbers as they are written); NULL where it does not fit."""
    return F.try_variant_get(observation, f"$.{key}", kind)


def known_readings(observations) -> "F.Column":
    """array<variant> -> array<struct> of the known keys as texts, as :func:`parse_observation_array` gives them."""
    c = F.col(observations) if isinstance(observations, str) else observations
    return F.transform(c, lambda o: F.struct(*[loose_reading(o, k).alias(k) for k in S.OBSERVATION_KEYS]))


def read_observation_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per response file: (file, observations).

    The whole file is one record, so the array keeps its element order
    (a plain JSON read would split a top-level array into rows).
    """
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        parse_observation_array("value").alias("observations"),
    )

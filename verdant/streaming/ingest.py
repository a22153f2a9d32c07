"""Continuous ingest: landed source files -> normalised events -> keyed records.

The upstream producers loop over a CSV file and poll a weather service,
publishing one JSON event per row or response.  Here both are streaming
queries over folders where such files land: each new file is read once,
normalised with the batch operators, and published as (key, value, topic)
records to Kafka or to a record folder the streaming job reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdant import schemas as S
from verdant.operators.normalize import normalize_crop_rows, normalize_observations
from verdant.operators.ordinals import number_rows_in_files
from verdant.sinks.publish import to_keyed_records, write_records
from verdant.sinks.upsert import path_exists
from verdant.sources.csv import stream_crop_csv, stream_growing_csv
from verdant.sources.observations import parse_observation_array

REJECT_COLUMNS = ("event_id", "sensor_id", "reject_reason")


def _write_once(spark: SparkSession, df: DataFrame, fmt: str, out: str, options) -> None:
    """Publish a batch folder exactly once.

    The batch is written to a hidden staging folder and renamed into place
    after Spark committed it, so a reader (e.g. a file stream over the
    parent folder) never sees a partly written batch.  A replayed batch
    whose folder is already in place is skipped: its rows are never offered
    twice under new file names.
    """
    if path_exists(spark, out):
        return
    parent, name = out.rstrip("/").rsplit("/", 1)
    staging = f"{parent}/_staging/{name}-{uuid.uuid4().hex[:8]}"
    write_records(df, fmt, staging, options, mode="overwrite")
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(staging)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(out)) and not path_exists(spark, out):
        raise RuntimeError(f"could not move {staging} to {out}")


def _publish(events: DataFrame, topic: str, batch_id: int, fmt: str, path: str | None,
             options: Mapping[str, str] | None, rejects_path: str | None, cache: bool = True) -> None:
    """Valid events as records (Kafka: at-least-once on replay; files: once per batch), rejects aside.
    The events are cached (unless the caller did) so both writes share one read and one parse."""
    spark = events.sparkSession
    if cache:
        events.persist()
    try:
        valid = events.filter(F.col("reject_reason").isNull()).select(*S.STREAM_EVENT_FIELDS)
        records = to_keyed_records(valid, topic)
        if fmt == "kafka":
            write_records(records, "kafka", options=options)
        else:
            _write_once(spark, records, fmt, f"{path}/batch_id={batch_id}", options)
        if rejects_path:
            rej = events.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)
            _write_once(spark, rej, "parquet", f"{rejects_path}/batch_id={batch_id}", None)
    finally:
        if cache:
            events.unpersist()


def _check_target(fmt: str, path: str | None, options: Mapping[str, str] | None) -> None:
    if fmt == "kafka":
        if not (options or {}).get("kafka.bootstrap.servers"):
            raise ValueError("kafka output needs options['kafka.bootstrap.servers'] (and a topic column)")
    elif not path:
        raise ValueError(f"a path is needed to write {fmt!r} records")


def start_crop_ingest(spark: SparkSession, folder: str, checkpoint: str, fmt: str = "parquet",
                      path: str | None = None, options: Mapping[str, str] | None = None,
                      rejects_path: str | None = None, max_files_per_trigger: int | None = 100,
                      header_columns: Sequence[str] = S.CROP_CSV_COLUMNS,
                      ingest_time: Column | None = None, trigger_available_now: bool = False) -> StreamingQuery:
    """Each new CSV file -> events numbered 1..n within the file -> records on the CSV topic."""
    _check_target(fmt, path, options)
    stream = stream_crop_csv(spark, folder, header_columns, max_files_per_trigger, with_split_columns=True)

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()  # numbering reads the batch twice; both passes must see the same rows
        events = None
        try:
            # the file's name (not its full location) joins the key, so a moved folder keeps its values
            numbered = number_rows_in_files(
                df.withColumn("_file", F.element_at(F.split(F.col("_split_file"), "/"), -1)), "event_id")
            # ordinals restart in every file: the file is part of the imputation key
            events = normalize_crop_rows(numbered, ingest_time=ingest_time,
                                         impute_keys=[F.col("event_id"), F.col("_file")]).persist()
            events.count()  # materialise the events, then the raw rows can go
            df.unpersist()
            _publish(events, S.TOPIC_CSV, batch_id, fmt, path, options, rejects_path, cache=False)
        finally:
            df.unpersist()
            if events is not None:
                events.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _rows_before(spark: SparkSession, totals: str, batch_id: int) -> DataFrame:
    """(_split_file, before): rows of every file in the batches before this one."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(totals)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    earlier = [n for n in (int(x.partition("=")[2]) for x in names if x.startswith("batch_id=")) if n < batch_id]
    for old in sorted(earlier)[:-2]:  # totals are of all batches so far: the last ones are enough
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{totals}/batch_id={old}"), True)
    if not earlier:
        return spark.createDataFrame([], "_split_file string, before long")
    return spark.read.schema("_split_file string, before long").parquet(f"{totals}/batch_id={max(earlier)}")


def start_growing_crop_ingest(spark: SparkSession, folder: str, checkpoint: str, fmt: str = "parquet",
                              path: str | None = None, options: Mapping[str, str] | None = None,
                              rejects_path: str | None = None, max_bytes_per_trigger: int | None = 1 << 30,
                              header_columns: Sequence[str] = S.CROP_CSV_COLUMNS, ingest_time: Column | None = None,
                              trigger_available_now: bool = False) -> StreamingQuery:
    """Rows appended to CSV files -> events numbered 1..n in each file, over all batches -> records on the CSV topic.

    How many rows of each file earlier batches had is kept beside the checkpoint, one row a file, written once a batch.
    """
    _check_target(fmt, path, options)
    stream = stream_growing_csv(spark, folder, f"{checkpoint}/source_progress", header_columns, max_bytes_per_trigger)
    totals = f"{checkpoint.rstrip('/')}_rows"

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()  # numbering reads the batch twice; both passes must see the same rows
        try:
            session = df.sparkSession
            before = _rows_before(session, totals, batch_id)
            rows = df.drop("_position").withColumn("_file", F.col("_split_file"))
            numbered = (number_rows_in_files(rows, "event_id").join(before.withColumnRenamed("_split_file", "_file"), "_file", "left")
                        .withColumn("event_id", F.col("event_id") + F.coalesce("before", F.lit(0))).drop("before"))
            events = normalize_crop_rows(numbered, ingest_time=ingest_time, impute_keys=[F.col("event_id"), F.col("_file")])
            _publish(events, S.TOPIC_CSV, batch_id, fmt, path, options, rejects_path)
            counted = df.groupBy("_split_file").agg(F.count(F.lit(1)).alias("before")).unionByName(before)
            _write_once(session, counted.groupBy("_split_file").agg(F.sum("before").alias("before")), "parquet", f"{totals}/batch_id={batch_id}", None)
        finally:
            df.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def weather_events_stream(spark: SparkSession, folder: str, greenhouse_id: str = S.GREENHOUSES[0],
                          ingest_time: Column | None = None, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Each new response file (one JSON array) -> one weather event.

    The event id is the file's modification time in epoch seconds (the
    upstream producer numbers polls from the clock).
    """
    reader = spark.readStream.option("wholetext", True)
    if max_files_per_trigger:  # a backlog after downtime is taken in bounded batches
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(folder)
    obs = raw.select(
        F.unix_seconds(F.col("_metadata.file_modification_time")).alias("event_id"),
        F.col("_metadata.file_path").alias("file"),
        parse_observation_array("value").alias("observations"),
    )
    # two responses landing in the same second share an id, not their imputed readings
    return normalize_observations(obs, greenhouse_id=greenhouse_id, ingest_time=ingest_time,
                                  impute_keys=[F.col("event_id"), F.col("file")])


def start_weather_ingest(spark: SparkSession, folder: str, checkpoint: str, fmt: str = "parquet",
                         path: str | None = None, options: Mapping[str, str] | None = None,
                         greenhouse_id: str = S.GREENHOUSES[0], rejects_path: str | None = None,
                         ingest_time: Column | None = None, trigger_available_now: bool = False,
                         max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Weather responses -> records on the weather topic (no state, no shuffle)."""
    _check_target(fmt, path, options)
    events = weather_events_stream(spark, folder, greenhouse_id, ingest_time, max_files_per_trigger)

    def batch(df: DataFrame, batch_id: int) -> None:
        _publish(df, S.TOPIC_WEATHER, batch_id, fmt, path, options, rejects_path)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

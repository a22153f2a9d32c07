"""Event record sources: message topics (Kafka) or landed record files, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from verdant.options import JobOptions
from verdant.sources.topic_log import TopicLogSource

# Landed records keep the message shape: key, value (JSON text), topic.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
])


def read_events_stream(spark: SparkSession, opts: JobOptions | None = None, fmt: str = "kafka",
                       path: str | None = None, max_files_per_trigger: int | None = None,
                       path_glob: str | None = None, progress: str | None = None) -> DataFrame:
    """Streaming scan of event records from several topics as one stream.

    ``kafka``: subscribes to ``opts.topics`` (comma list) at
    ``opts.starting_offsets``; the result has Kafka's columns (``value``
    binary).  ``topiclog``: the same topics kept as logs of files under
    ``path``, with the same columns and options; ``progress`` is a folder
    inside the query's checkpoint.  ``parquet``/``json``: a folder of landed
    records with :data:`RECORD_SCHEMA`, read from the start.
    """
    opts = opts or JobOptions()
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", opts.bootstrap_servers)
                  .option("subscribe", ",".join(opts.topics))
                  .option("startingOffsets", opts.starting_offsets))
        if opts.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(opts.max_offsets_per_trigger))
        for k, v in opts.extra_source_options.items():
            reader = reader.option(k, v)
        return reader.load()
    if not path:
        raise ValueError(f"a path is needed to stream {fmt!r} record files")
    if fmt == "topiclog":
        spark.dataSource.register(TopicLogSource)
        reader = (spark.readStream.format("topiclog").option("path", path).option("subscribe", ",".join(opts.topics))
                  .option("startingOffsets", opts.starting_offsets))
        if progress:
            reader = reader.option("progress", progress)
        if opts.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(opts.max_offsets_per_trigger))
        return reader.options(**opts.extra_source_options).load()
    reader = spark.readStream.format(fmt).schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path)


def read_event_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan of landed event records."""
    return spark.read.format(fmt).schema(RECORD_SCHEMA).load(path)


def read_topic_log(spark: SparkSession, path: str, topics: tuple[str, ...] = (), starting_offsets: str = "earliest",
                   ending_offsets: str = "latest") -> DataFrame:
    """Bounded batch scan of topics kept as logs of files: offsets from ``starting_offsets`` up to ``ending_offsets``."""
    spark.dataSource.register(TopicLogSource)
    reader = spark.read.format("topiclog").option("path", path).option("startingOffsets", starting_offsets)
    return reader.option("endingOffsets", ending_offsets).option("subscribe", ",".join(topics)).load()

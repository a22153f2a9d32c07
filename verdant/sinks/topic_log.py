"""Publishing of records to topics kept as logs of files (see ``sources.topic_log``)."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.impute import hash_u32

#: Partitions of a topic, and most rows of a segment.
PARTITIONS, SEGMENT_ROWS = 3, 500_000


def partition_of(partitions: int = PARTITIONS):
    """The partition of a record: by its key, so that a key's records are in one partition."""
    return (hash_u32("topic", "key") % partitions).cast("int")


def append_records(records: DataFrame, path: str, partitions: int = PARTITIONS, segment_rows: int = SEGMENT_ROWS) -> int:
    """Append (key, value, topic) records to their topics' partitions; returns the number of segments.

    Tasks write their rows to a hidden folder, files of one partition each and at most ``segment_rows`` rows; then the files
    get their offsets by renaming, one after the other, so a reader never meets a part of a file or a hole.  One process
    publishes to a topic at a time, as one producer has a topic to itself; a topic is needed, a null key is a key.
    """
    spark = records.sparkSession
    path, staged = path.rstrip("/"), f"{path.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    rows = records.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"),
        F.coalesce(F.col("topic"), F.raise_error("a record without a topic")).alias("topic"), partition_of(partitions).alias("partition"))
    # few large files: small partitions go together, a hot one is split (as Spark measures them)
    rows.hint("rebalance", "topic", "partition").write.partitionBy("topic", "partition").option("maxRecordsPerFile", segment_rows).parquet(staged)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(staged, "_SUCCESS")):
        raise OSError(f"nothing was staged in {staged}")
    # one row a file: its name and how many rows it holds
    files = (spark.read.schema("key binary").option("recursiveFileLookup", True).parquet(staged)
             .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows")).orderBy("file").toArrow().to_pylist())
    ends: dict[str, int] = {}
    for f in files:
        source = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f["file"]))
        place = f"{path}/{source.getParent().getParent().getName()}/{source.getParent().getName()}"
        if place not in ends:
            target = jvm.org.apache.hadoop.fs.Path(place)
            fs.mkdirs(target)
            names = [s.getPath().getName() for s in fs.listStatus(target)]
            ends[place] = max((sum(map(int, unquote(n).removesuffix(".parquet").split("-"))) for n in names if n[0].isdigit()), default=0)
        segment = jvm.org.apache.hadoop.fs.Path(f"{place}/{ends[place]:020d}-{f['rows']}.parquet")
        if fs.exists(segment) or not fs.rename(source, segment):
            raise OSError(f"cannot publish {segment}")
        ends[place] += f["rows"]
    fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return len(files)

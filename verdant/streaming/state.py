"""The windows a streaming query still holds, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """One row for each window and key in the state of a window query: its keys, ``window_start``, ``window_end``,
    ``event_count`` and the state's ``partition_id``, as after the last committed batch (or after ``batch_id``).

    Windows that the watermark has passed are gone: this is what eviction leaves.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    rows = reader.load(checkpoint)
    keys, values = rows.schema["key"].dataType.fieldNames(), rows.schema["value"].dataType.fields
    window = keys[0]  # the aggregate groups by the window first
    # the sums and counts of several averages share their names: renamed by place; the row count is the last
    named = T.StructType([T.StructField(f"v{i}", f.dataType) for i, f in enumerate(values)])
    return rows.select(*[F.col("key")[k].alias(k) for k in keys[1:]], F.col("key")[window]["start"].alias("window_start"),
                       F.col("key")[window]["end"].alias("window_end"), F.col("value").cast(named)[f"v{len(values) - 1}"].alias("event_count"),
                       "partition_id")

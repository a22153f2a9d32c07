"""Row ordinals 1..n in file order, computed in parallel.

File order = files by path, then lines within each file.  Every input split
(file, block start) is read by one task in line order, so a row's position
is (ordinal of its split's first row) + (its offset inside the split).
A count pass gives one row for each split, which the driver, that holds the
listing of the files anyway, sums up in file order; the rows get their
split's offset by a broadcast join as long as there are at most
``BROADCAST_SPLITS`` of them, and by a plain join beyond.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Offsets of so many splits are broadcast: some 100 bytes each.
BROADCAST_SPLITS = 200_000

_SPLIT = ["_split_file", "_split_start"]


def _split_offsets(counts: pa.Table, per_file: bool) -> pa.Table:
    """Splits in file order with ``_split_offset``, the rows before each (in its file, or in all files)."""
    counts = counts.sort_by([(c, "ascending") for c in _SPLIT])
    before = pc.subtract(pc.cumulative_sum(counts["rows"]), counts["rows"])
    if per_file and counts.num_rows:
        files = counts["_split_file"].combine_chunks().dictionary_encode().indices.to_numpy()  # numbered as they come, so in order
        first = before.to_numpy()[[i for i in range(len(files)) if i == 0 or files[i] != files[i - 1]]]
        before = pc.subtract(before, pa.array(first[files]))
    return counts.drop_columns("rows").append_column("_split_offset", before)


def _number_tagged(tagged: DataFrame, name: str, per_file: bool) -> DataFrame:
    """Number rows of a frame carrying its split columns (``_split_file``, ``_split_start``)."""
    spark = tagged.sparkSession
    tagged = tagged.withColumn("_row_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("rows"), F.min("_row_mid").alias("_split_first_mid")).toArrow()
    offsets = spark.createDataFrame(_split_offsets(counts, per_file))
    if counts.num_rows <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    numbered = tagged.join(offsets, _SPLIT)
    ordinal = F.col("_split_offset") + (F.col("_row_mid") - F.col("_split_first_mid")) + F.lit(1)
    return numbered.withColumn(name, ordinal).drop(*_SPLIT, "_row_mid", "_split_first_mid", "_split_offset")


def with_file_ordinals(df: DataFrame, name: str = "event_id", per_file: bool = False) -> DataFrame:
    """Add ``name`` = 1-based row number in file order (or within each file).

    ``df`` must be a file scan (it reads the hidden ``_metadata`` column).
    The scan runs twice (count pass, then numbering pass); both see the
    same files and splits, so the ids agree, also after task retries.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_split_file"),
        F.col("_metadata.file_block_start").alias("_split_start"),
    )
    return _number_tagged(tagged, name, per_file)


def split_columns() -> list:
    """The split columns to select on a (streaming) file scan for :func:`number_rows_in_files`."""
    return [F.col("_metadata.file_path").alias("_split_file"),
            F.col("_metadata.file_block_start").alias("_split_start")]


def number_rows_in_files(batch: DataFrame, name: str = "event_id") -> DataFrame:
    """Per-file 1-based row numbers for a micro-batch that carries :func:`split_columns`.

    Call on a persisted micro-batch: its partitions are fixed, so every
    pass sees the same rows in the same order.
    """
    return _number_tagged(batch, name, per_file=True)

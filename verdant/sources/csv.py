"""Crop CSV source: header row, every column text, batch or growing folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant import schemas as S
from verdant.operators.ordinals import split_columns, with_file_ordinals
from verdant.sources.growing_lines import GrowingLinesSource


def read_crop_csv(spark: SparkSession, path: str, ordinal_col: str | None = "event_id") -> DataFrame:
    """Header-driven, all-text read (no type inference).

    Columns are matched by header *name* (a user schema would be applied by
    position); a column the header lacks is NULL, empty and missing trailing
    fields are NULL, extra fields are dropped.  All files of one call share
    one header layout.  With ``ordinal_col`` each
    row gets its 1-based position in file order (the producer's running id).
    """
    # Column names come from the first file's header; every other file is
    # checked against it (enforceSchema=false), so a file with another
    # column layout fails the read instead of being mapped by position.
    # Folders mixing layouts: call once per layout and union_sources() them.
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("enforceSchema", False).csv(path))
    if ordinal_col:
        raw = with_file_ordinals(raw, ordinal_col)
    present = {c.lower(): c for c in raw.columns}
    cols = [F.col(present[c.lower()]).alias(c) if c.lower() in present else F.lit(None).cast("string").alias(c)
            for c in S.CROP_CSV_COLUMNS]
    return raw.select(*([F.col(ordinal_col)] if ordinal_col else []), *cols)


def read_crop_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a folder's CSV files, in their order (from the first file)."""
    return spark.read.option("header", True).csv(path).columns


def stream_crop_csv(spark: SparkSession, folder: str, header_columns: Sequence[str] = S.CROP_CSV_COLUMNS,
                    max_files_per_trigger: int | None = None, with_split_columns: bool = False) -> DataFrame:
    """New CSV files landing in ``folder`` as a stream (each file read once).

    A stream needs its schema up front, so the files' header layout is given
    as ``header_columns`` (all text; each file's header is checked against
    it).  Columns the crop mapping does not read are dropped, columns it
    reads but the layout lacks are NULL; names match case-insensitively, as
    in :func:`read_crop_csv`.  ``with_split_columns`` adds the file/split
    columns that per-file row numbering needs.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header_columns])
    reader = spark.readStream.option("header", True).option("enforceSchema", False).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(folder)
    present = {c.lower(): c for c in header_columns}
    cols = [F.col(present[c.lower()]).alias(c) if c.lower() in present else F.lit(None).cast("string").alias(c)
            for c in S.CROP_CSV_COLUMNS]
    return raw.select(*(split_columns() if with_split_columns else []), *cols)


def stream_growing_csv(spark: SparkSession, folder: str, progress: str, header_columns: Sequence[str] = S.CROP_CSV_COLUMNS,
                       max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Rows appended to the CSV files of ``folder``, and rows of new files, as a stream: each row once.

    Columns as :func:`stream_crop_csv`, with ``_split_file`` and ``_split_start`` for row numbers and ``_position``,
    the row's first byte.  Every file's first line is its header, which must name ``header_columns``; blank lines are no
    rows.  A row has no line breaks inside quotes.
    """
    spark.dataSource.register(GrowingLinesSource)
    reader = spark.readStream.format("growinglines").option("path", folder).option("progress", progress)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header_columns])
    text = F.col("line").cast("string")
    parsed = F.from_csv(text, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    names = F.array(*[F.lower(F.col("row")[c]) for c in header_columns])
    expected = F.array(*[F.lit(c.lower()) for c in header_columns])
    is_header = F.col("position") == 0
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), F.col("file"))).cast("boolean")
    rows = (reader.load().where(F.length(F.trim(text)) > 0).select("file", "split", "position", parsed.alias("row"))
            .where(F.when(is_header, F.when(names == expected, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True))))
    present = {c.lower(): c for c in header_columns}
    cols = [F.col("row")[present[c.lower()]].alias(c) if c.lower() in present else F.lit(None).cast("string").alias(c)
            for c in S.CROP_CSV_COLUMNS]
    return rows.select(F.col("file").alias("_split_file"), F.col("split").alias("_split_start"), F.col("position").alias("_position"), *cols)

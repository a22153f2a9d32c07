"""Scans of the keyed aggregate tables (current content through the latest view)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.schemas import WINDOW_METRICS, WINDOW_METRICS_BY_SOURCE, WINDOW_TABLES, TableSpec
from verdant.sinks.upsert import UpsertTable

TABLES = {t.name: t for t in (WINDOW_METRICS, WINDOW_METRICS_BY_SOURCE)}


def open_table(root: str, name: str) -> UpsertTable:
    spec: TableSpec = TABLES[name]
    return UpsertTable(f"{root.rstrip('/')}/{name}", spec)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return open_table(root, name).latest(spark)


def read_shared_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the two tables as a job that writes both by one commit left it (the filter reaches the scan)."""
    both = UpsertTable(f"{root.rstrip('/')}/{WINDOW_TABLES.name}", WINDOW_TABLES).latest(spark)
    return both.where(F.col("table_name") == name).select(*TABLES[name].columns)


def stored_places(spark: SparkSession, table: UpsertTable) -> DataFrame:
    """Rows of the table's base as they lie in its files: with ``file`` (files in the order they were written, which is that
    of their ranges) and ``row`` (place in the file)."""
    base = table.current_base(spark)
    if base is None:
        raise ValueError(f"{table.root} has no base: compact it first")
    rows = spark.read.schema(table.spec.schema).parquet(table.data_path(base.commit))
    return rows.select(*table.spec.columns, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))


def in_table_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the table's key order: partition column, then its clustering order
    (window_metrics: newest window first; by-source: newest first, then greenhouse)."""
    order = [F.col(spec.partition_column).asc()] + [
        F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec.sort_order]
    used = {spec.partition_column, *(c for c, _ in spec.sort_order)}
    # the rest of the primary key makes the order total
    order += [F.col(c).asc() for c in spec.primary_key if c not in used]
    return df.orderBy(*order)

"""The batch job: event rows -> 5-minute window metrics -> keyed table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.decode import batch_events_with_time
from verdant.operators.windows import (
    GREENHOUSE_KEYS,
    SOURCE_KEYS,
    finish_window_sums,
    rollup_window_sums,
    window_metrics,
    window_sums,
)
from verdant.schemas import BATCH_EVENT_SCHEMA, WINDOW_METRICS, WINDOW_METRICS_BY_SOURCE
from verdant.session import default_table_root, new_run_id
from verdant.sinks.publish import formatted_rows
from verdant.sinks.upsert import BACKFILL, UpsertTable

log = logging.getLogger(__name__)


def batch_window_metrics(events: DataFrame, millis_col: str | None = None) -> DataFrame:
    """Window metrics of batch rows; rows with epoch-millisecond time get ``event_time`` first."""
    if millis_col:
        events = batch_events_with_time(events, millis_col)
    return window_metrics(events)


def run_batch_tables(spark: SparkSession, events: DataFrame, table_root: str | None = None, batch_id: int = 0,
                     run_id: str | None = None, millis_col: str | None = None) -> dict[str, UpsertTable]:
    """Backfill both aggregate tables from ONE scan of the events.

    The backfill's rows have the lower priority, so where any other writer has
    written the same keys, before or after, that writer's rows stay current.

    The finest aggregate (window x source x topic x greenhouse, with sums and
    non-NULL counts) is computed once and cut from its lineage with a
    reliable ``checkpoint()`` in the shared checkpoint folder, so a lost
    executor never re-reads the input; both tables are derived from it.
    """
    table_root = table_root or default_table_root(spark)  # also makes sure a checkpoint folder is set
    run_id = run_id or new_run_id()
    if millis_col:
        events = batch_events_with_time(events, millis_col)
    # rows without source fields (the batch schema) form the NULL source group
    events = events.withColumns({k: F.lit(None).cast("string") for k in SOURCE_KEYS if k not in events.columns})
    fine = window_sums(events, SOURCE_KEYS).checkpoint(eager=True)
    tables = {}
    for spec, keys, sums in ((WINDOW_METRICS_BY_SOURCE, SOURCE_KEYS, fine),
                             (WINDOW_METRICS, GREENHOUSE_KEYS, rollup_window_sums(fine, GREENHOUSE_KEYS))):
        table = UpsertTable(f"{table_root}/{spec.name}", spec, run_id=run_id, priority=BACKFILL)
        table.write_batch(finish_window_sums(sums, keys), batch_id)
        tables[spec.name] = table
    return tables


def run_batch_job(spark: SparkSession, events: DataFrame, table_root: str | None = None, batch_id: int = 0,
                  run_id: str | None = None, millis_col: str | None = None) -> UpsertTable:
    """Aggregate once and upsert the result as one batch of ``window_metrics``
    (computed once, written once; nothing is collected to the driver)."""
    table_root = table_root or default_table_root(spark)
    table = UpsertTable(f"{table_root}/{WINDOW_METRICS.name}", WINDOW_METRICS, run_id=run_id)
    rows = table.write_batch(batch_window_metrics(events, millis_col), batch_id)
    log.info("wrote %s window aggregates to %s (batch %s)", rows, table.root, batch_id)
    return table


if __name__ == "__main__":
    import sys

    from verdant.session import build_session

    # usage: python -m verdant.plans.batch_job <parquet or json path of batch events> [batch_id]
    spark = build_session(app_name="verdant-batch")
    path = sys.argv[1]
    fmt = "json" if path.endswith(".json") else "parquet"
    rows = spark.read.format(fmt).schema(BATCH_EVENT_SCHEMA).load(path)
    from verdant.options import JobOptions

    root = JobOptions.from_env().table_root
    if not root:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            sys.exit("no table root: set TABLE_ROOT or spark.checkpoint.dir")
        root = f"{configured.rstrip('/')}/verdant/tables"
    table = run_batch_job(spark, rows, table_root=root,
                          batch_id=int(sys.argv[2]) if len(sys.argv) > 2 else 0, millis_col="event_ts")
    formatted_rows(table.latest(spark)).show(truncate=False)

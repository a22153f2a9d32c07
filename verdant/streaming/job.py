"""The streaming job: records -> decode -> watermark + 5-minute windows -> keyed tables.

Two queries share the decode plan (one per table, each with its own
checkpoint), both in update mode: each micro-batch upserts only the
windows it changed.  Late rows (window end at or before the watermark)
are dropped by Spark's stateful aggregation; state older than the
watermark is evicted, so state stays bounded by the watermark horizon.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdant.operators.decode import accepted, decode_events, rejects
from verdant.operators.windows import GREENHOUSE_KEYS, SOURCE_KEYS, window_metrics, window_tables
from verdant.options import JobOptions
from verdant.schemas import WINDOW_METRICS, WINDOW_METRICS_BY_SOURCE, WINDOW_TABLES
from verdant.session import default_table_root, shared_root
from verdant.sinks.upsert import UpsertTable
from verdant.sources.events import read_events_stream
from verdant.streaming.progress import WRITTEN

TABLE_KEYS = {
    WINDOW_METRICS.name: (WINDOW_METRICS, GREENHOUSE_KEYS),
    WINDOW_METRICS_BY_SOURCE.name: (WINDOW_METRICS_BY_SOURCE, SOURCE_KEYS),
}


def stream_aggregates(events: DataFrame, opts: JobOptions | None = None,
                      time_col: str = "event_time") -> dict[str, DataFrame]:
    """Watermarked window aggregates per table (same code as the batch job)."""
    opts = opts or JobOptions()
    return {
        name: window_metrics(events, keys, time_col, opts.window, opts.watermark)
        for name, (_, keys) in TABLE_KEYS.items()
    }


def _apply_trigger(writer, trigger: str | None, opts: JobOptions):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    interval = trigger or opts.processing_time
    return writer.trigger(processingTime=interval) if interval else writer


def start_table_queries(events: DataFrame, table_root: str, checkpoint_root: str, opts: JobOptions | None = None,
                        trigger: str | None = None, run_id: str | None = None,
                        report: Callable[[str, int, int], None] | None = None,
                        tables: tuple[str, ...] = tuple(TABLE_KEYS),
                        compact_every: int | None = None) -> dict[str, StreamingQuery]:
    """Start one update-mode query per table; each upserts through ``foreachBatch``.

    A table's commits are numbered when they are made; a batch that a restarted
    query replays keeps its first number (the query's id and batch id tell).
    """
    opts = opts or JobOptions()
    compact_every = compact_every if compact_every is not None else opts.compact_every
    aggs = stream_aggregates(events, opts)
    suffix = uuid.uuid4().hex[:6]
    started = {}
    for name in tables:
        spec, _ = TABLE_KEYS[name]
        table = UpsertTable(f"{table_root}/{name}", spec, run_id=run_id, report=report,
                            compact_every=compact_every)
        observed = aggs[name].observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
        writer = (observed.writeStream.outputMode("update").queryName(f"{name}-{suffix}")
                  .option("checkpointLocation", f"{checkpoint_root}/{name}")
                  .foreachBatch(table.foreach_batch()))
        started[name] = _apply_trigger(writer, trigger, opts).start()
    return started


def start_shared_query(events: DataFrame, table_root: str, checkpoint_root: str, opts: JobOptions | None = None,
                       trigger: str | None = None, report: Callable[[str, int, int], None] | None = None,
                       compact_every: int | None = None) -> StreamingQuery:
    """Both tables by one query: the source is read and parsed once, one state holds the windows of both, and a
    micro-batch's rows of both are published by one commit, so readers never see one table ahead of the other.

    Read with ``sources.tables.read_shared_table``.
    """
    opts = opts or JobOptions()
    keys = {name: ks for name, (_, ks) in TABLE_KEYS.items()}
    rows = window_tables(events, keys, window=opts.window, watermark=opts.watermark)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("table_name") == n).alias(f"rows_{n}") for n in keys]]
    table = UpsertTable(f"{table_root}/{WINDOW_TABLES.name}", WINDOW_TABLES, report=report,
                        compact_every=compact_every if compact_every is not None else opts.compact_every)
    writer = (rows.observe(WRITTEN, *counts).writeStream.outputMode("update").queryName(f"{WINDOW_TABLES.name}-{uuid.uuid4().hex[:6]}")
              .option("checkpointLocation", f"{checkpoint_root}/{WINDOW_TABLES.name}").foreachBatch(table.foreach_batch()))
    return _apply_trigger(writer, trigger, opts).start()


def start_rejects_query(decoded: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                        opts: JobOptions | None = None) -> StreamingQuery:
    """Append rows that failed decoding (with their reason) to a parquet folder."""
    writer = (rejects(decoded).writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _apply_trigger(writer, trigger, opts or JobOptions()).start()


def run_streaming_job(spark: SparkSession, opts: JobOptions | None = None, fmt: str = "kafka",
                      path: str | None = None, trigger: str | None = None, wait: bool = True,
                      wait_timeout: float | None = None) -> dict:
    """Entry point: topics (or landed record files) -> both aggregate tables.

    Each query reads the source itself (Spark does not share a source
    between queries): two reads, three with ``opts.write_rejects``.  With
    ``opts.shared_tables`` one query reads it for both tables.
    """
    opts = opts or JobOptions.from_env()
    # forget queries that ended earlier in this session, before starting ours,
    # so a failure of one of ours is never cleared
    spark.streams.resetTerminated()
    root = shared_root(spark)
    table_root = opts.table_root or default_table_root(spark)
    checkpoint_root = opts.checkpoint_root or f"{root}/verdant/streams"

    def decoded(name: str) -> DataFrame:
        # a topic log's positions are remembered for each query, inside its checkpoint
        raw = read_events_stream(spark, opts, fmt=fmt, path=path, progress=f"{checkpoint_root}/{name}/source_progress")
        return decode_events(raw, keep=("topic",))

    if opts.shared_tables:
        queries = {WINDOW_TABLES.name: start_shared_query(accepted(decoded(WINDOW_TABLES.name)), table_root, checkpoint_root, opts, trigger)}
    else:
        queries = {}
        for name in TABLE_KEYS:
            queries |= start_table_queries(accepted(decoded(name)), table_root, checkpoint_root, opts, trigger, tables=(name,))
    if opts.write_rejects:
        queries["rejects"] = start_rejects_query(decoded("rejects"), f"{table_root}/rejects", f"{checkpoint_root}/rejects",
                                                 trigger, opts)
    if wait:
        try:
            if trigger in ("availableNow", "once"):
                # each query drains what is there and stops: wait for all of them
                for q in queries.values():
                    q.awaitTermination()
            elif wait_timeout is None:
                # block until any query ends; a failed query raises here
                spark.streams.awaitAnyTermination()
            else:
                spark.streams.awaitAnyTermination(wait_timeout)
        except Exception:
            for q in queries.values():  # do not leave the sibling queries running unattended
                if q.isActive:
                    q.stop()
            raise
    return queries


if __name__ == "__main__":
    from verdant.session import build_session

    run_streaming_job(build_session(app_name="verdant-streaming"), JobOptions.from_env())

"""Registered queries of the live paths: topics kept as logs, growing files, one query for two tables, state, reports.

Events are cut into three slices by time (``catalog.SLICES``; the error events come late, with the last).  A slice is
landed, the stream drains it and stops, and restarts from its checkpoint for the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdant import schemas as S
from verdant.operators.decode import accepted, decode_events
from verdant.operators.union import union_sources
from verdant.options import JobOptions
from verdant.plans import catalog as C
from verdant.plans import fixtures as FX
from verdant.session import scratch_path
from verdant.sinks.publish import to_keyed_records
from verdant.sinks.topic_log import PARTITIONS, append_records
from verdant.sources.csv import read_crop_header
from verdant.sources.events import read_events_stream, read_topic_log
from verdant.sources.tables import read_shared_table
from verdant.sources.testdata import SENSOR_VIEW_SQL, load_table, sensor_events
from verdant.streaming.ingest import start_growing_crop_ingest
from verdant.streaming.job import start_shared_query, start_table_queries
from verdant.streaming.progress import batch_summary
from verdant.streaming.state import open_windows

TOPICS = S.ALL_TOPICS
TABLE_KEYS = {S.WINDOW_METRICS.name: ("greenhouse_id",), S.WINDOW_METRICS_BY_SOURCE.name: ("data_source", "source_topic", "greenhouse_id")}


def _slices(events: DataFrame) -> list[Column]:
    first, second = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in C.SLICES)
    late = F.col("data_source").eqNullSafe("error")
    time = F.col("event_time").cast("timestamp_ntz")
    return [~late & (time < first), ~late & (time >= first) & (time < second), late | time.isNull() | (time >= second)]


def _drained(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return query


# ------------------------------------------------------------- topics as logs

def _to_topics(events: DataFrame) -> DataFrame:
    """Records of the events, dealt to the three topics by event id."""
    topic = F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(len(TOPICS))) + 1).cast("int"))
    return to_keyed_records(events, topic)


def q_stream_topic_log(spark: SparkSession, sf: str) -> DataFrame:
    """Three topics, read from ``latest``: what was published before the first start is not read; two restarts follow."""
    base, events = scratch_path(spark, "topic_log"), sensor_events(spark, sf, with_text_time=True)
    opts = JobOptions(topics=TOPICS, starting_offsets="latest")
    for rows in _slices(events):
        append_records(_to_topics(events.filter(rows)), f"{base}/log")
        raw = read_events_stream(spark, opts, fmt="topiclog", path=f"{base}/log", progress=f"{base}/checkpoints/progress")
        decoded = accepted(decode_events(raw, keep=("topic",)))
        # the default trigger: a batch without rows follows and moves the watermark, as in a stream that goes on
        query = start_shared_query(decoded, f"{base}/tables", f"{base}/checkpoints", opts)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    frames = [read_shared_table(spark, f"{base}/tables", n).select(F.lit(n).alias("table_name"), "greenhouse_id", "window_start", "event_count")
              for n in TABLE_KEYS]
    return C._ntz(union_sources(*frames))


def q_topic_log_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets of every topic partition after three publishes, read as a bounded batch: 0 to n - 1, each once, and a
    second read of the last half of each partition."""
    base, events = scratch_path(spark, "topic_log_batch"), sensor_events(spark, sf, with_text_time=True)
    for rows in _slices(events):
        append_records(_to_topics(events.filter(rows)), base)
    every = read_topic_log(spark, base, TOPICS)
    found = every.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"), F.count_distinct("offset").alias("n_offsets"))
    ends = found.select("topic", F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), F.expr("n div 2"))).over(
        _by_topic())).alias("halves")).dropDuplicates(["topic"])
    middle = ends.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "halves"))))).first()[0]  # a number for each partition
    half = read_topic_log(spark, base, TOPICS, starting_offsets=middle).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n_second_half"))
    return found.join(half, ["topic", "partition"], "left").select("topic", "partition", "n", "low", "high", "n_offsets", F.coalesce("n_second_half", F.lit(0)).alias("n_second_half"))


def _by_topic():
    from pyspark.sql import Window

    return Window.partitionBy("topic")


TOPIC_LOG_OFFSETS_SQL = f"""
SELECT ['{"', '".join(TOPICS)}'][event_id % {len(TOPICS)} + 1] AS topic,
       CAST({C.sql_hash_u32('topic', 'greenhouse_id')} % {PARTITIONS} AS INTEGER) AS partition,
       count(*) AS n, CAST(0 AS BIGINT) AS low, count(*) - 1 AS high, count(*) AS n_offsets, CAST(count(*) - count(*) // 2 AS BIGINT) AS n_second_half
FROM ({SENSOR_VIEW_SQL}) s GROUP BY ALL"""


def sliced_sql(first_slice: int = 1, at_end_of: int = 3) -> str:
    """Rows that a stream counts which reads the slices from ``first_slice`` to ``at_end_of``: columns of the sensor view,
    ``slice``, and ``mark``, the watermark when the last of them has been read."""
    a, b = (C._ts(t) for t in C.SLICES)
    epoch = "TIMESTAMP '1970-01-01'"

    def mark(last: int) -> str:
        return (f"(SELECT greatest({epoch}, coalesce(date_trunc('milliseconds', max(event_time)) - INTERVAL 2 MINUTES, {epoch})) "
                f"FROM sliced WHERE slice BETWEEN {first_slice} AND {last})")

    late = " ".join(f"WHEN {k} THEN {mark(k - 1) if k > first_slice else epoch}" for k in range(first_slice, at_end_of + 1))
    return f"""
SELECT * EXCLUDE (late_mark) FROM (
  SELECT s.*, CASE slice {late} END AS late_mark, {mark(at_end_of)} AS mark
  FROM sliced s WHERE slice BETWEEN {first_slice} AND {at_end_of})
WHERE time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES > late_mark""", f"""
sliced AS (
  SELECT *, CASE WHEN coalesce(data_source = 'error', false) OR event_time >= {b} THEN 3 WHEN event_time >= {a} THEN 2 ELSE 1 END AS slice
  FROM ({SENSOR_VIEW_SQL}) v WHERE event_time IS NOT NULL)"""


def _topic_log_sql() -> str:
    rows, sliced = sliced_sql(first_slice=2)
    parts = [f"SELECT '{n}' AS table_name, greenhouse_id, time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start, count(*) AS event_count "
             f"FROM kept GROUP BY {', '.join((*k, 'window_start'))}" for n, k in TABLE_KEYS.items()]
    return f"WITH {sliced}, kept AS ({rows}) {' UNION ALL '.join(parts)}"


# ------------------------------------------------------------- growing files

GROWING_FILES = 4


def _land_growing(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    """The rows as ``crops-<k>.csv`` files in key order; a file of that name is replaced by one that begins with it."""
    staged = scratch_path(spark, "growing_staged")
    (rows.withColumn("file", F.pmod("c_custkey", F.lit(GROWING_FILES))).repartition(GROWING_FILES, "file").sortWithinPartitions("file", "c_custkey")
     .drop("c_custkey").write.partitionBy("file").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(staged))
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(folder))
    for k in range(GROWING_FILES):
        written = fs.globStatus(Path(f"{staged}/file={k}/part-*.csv"))
        for status in written or []:
            target = Path(f"{folder}/crops-{k}.csv")
            fs.delete(target, False)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"cannot move {status.getPath()} to {target}")


def q_stream_growing_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are appended to twice, read by one stream with two restarts: every row once, numbered on in its file."""
    base, customer = scratch_path(spark, "growing_csv"), load_table(spark, sf, "customer")
    rows = FX.crop_csv_rows(customer)
    most = customer.agg(F.max("c_custkey")).first()[0] or 0
    for upto in (most // 3, 2 * most // 3, most):
        _land_growing(spark, rows.filter(F.col("c_custkey") <= upto), f"{base}/csv")
        header = read_crop_header(spark, f"{base}/csv") if upto else S.CROP_CSV_COLUMNS
        _drained(start_growing_crop_ingest(spark, f"{base}/csv", f"{base}/checkpoint", path=f"{base}/records", header_columns=header,
                                           ingest_time=C._ingest(), trigger_available_now=True))
    decoded = decode_events(spark.read.parquet(f"{base}/records"))
    return decoded.select(*[F.col(c).cast("long") if c == "event_id" else F.col(c) for c in C.CROP_COLUMNS])


GROWING_RAW_SQL = FX.CROP_CSV_SQL.replace(
    "row_number() OVER (ORDER BY c_custkey) AS event_id",
    f"row_number() OVER (PARTITION BY c_custkey % {GROWING_FILES} ORDER BY c_custkey) AS event_id, "
    f"'crops-' || CAST(c_custkey % {GROWING_FILES} AS VARCHAR) || '.csv' AS file")
STREAM_GROWING_CSV_SQL = f"""
SELECT {', '.join(C.CROP_COLUMNS)} FROM ({C.crop_sql(GROWING_RAW_SQL, "event_id || ':' || file")}) c WHERE reject_reason IS NULL"""


# ------------------------------------------------------------- one query for two tables

def _shared_runs(spark: SparkSession, sf: str) -> Iterator[tuple[int, str, StreamingQuery]]:
    """(run, folder, its finished query) of the shared query over the three slices."""
    base, events = scratch_path(spark, "shared_stream"), sensor_events(spark, sf, with_text_time=True)
    for run, rows in enumerate(_slices(events), 1):
        to_keyed_records(events.filter(rows)).write.mode("append").parquet(f"{base}/landing")
        raw = read_events_stream(spark, fmt="parquet", path=f"{base}/landing")
        decoded = accepted(decode_events(raw, keep=("topic",)))
        yield run, base, _drained(start_shared_query(decoded, f"{base}/tables", f"{base}/checkpoints", trigger="availableNow"))


def q_stream_shared_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables, all their columns, as one query that reads the source once leaves them after two restarts."""
    for _, base, query in _shared_runs(spark, sf):
        if any(b["sources"] != 1 for b in batch_summary(query)):
            raise RuntimeError("the source was read more than once")
    frames = [read_shared_table(spark, f"{base}/tables", n).select(
        F.lit(n).alias("table_name"), *[F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in TABLE_KEYS[S.WINDOW_METRICS_BY_SOURCE.name]],
        "window_start", "window_end", "avg_temperature", "avg_humidity", "avg_co2", "event_count") for n, keys in TABLE_KEYS.items()]
    return C._ntz(C._round_doubles(union_sources(*frames)))


def _shared_sql() -> str:
    every = TABLE_KEYS[S.WINDOW_METRICS_BY_SOURCE.name]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {', '.join(c if c in keys else f'CAST(NULL AS VARCHAR) AS {c}' for c in every)}, window_start, window_end, "
        f"avg_temperature, avg_humidity, avg_co2, event_count FROM ({C._late_sql(keys)}) w" for n, keys in TABLE_KEYS.items())


def q_stream_batch_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both tables that every run wrote, as the progress reports tell them (observed while writing: no job counts)."""
    reports = []
    for run, _, query in _shared_runs(spark, sf):
        for name in TABLE_KEYS:
            written = [b["rows_written"] for b in batch_summary(query) if b["rows_written"]]
            reports.append((run, name, sum(w[f"rows_{name}"] for w in written)))
    return spark.createDataFrame(reports, "run int, table_name string, rows long")


def _batch_report_sql() -> str:
    parts = []
    for run in (1, 2, 3):
        rows, sliced = sliced_sql(at_end_of=run)
        for name, keys in TABLE_KEYS.items():
            parts.append(f"SELECT {run} AS run, '{name}' AS table_name, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)}, "
                         f"time_bucket(INTERVAL 5 MINUTES, event_time) FROM ({rows}) k WHERE slice = {run})) AS rows")
    return f"WITH {sliced} {' UNION ALL '.join(parts)}"


# ------------------------------------------------------------- what the state holds

def q_stream_state_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The windows still in the state after each run: those the watermark has not passed, with their counts so far."""
    base, events = scratch_path(spark, "state_runs"), sensor_events(spark, sf, with_text_time=True)
    name, held = S.WINDOW_METRICS.name, []
    for run, rows in enumerate(_slices(events), 1):
        to_keyed_records(events.filter(rows)).write.mode("append").parquet(f"{base}/landing")
        decoded = accepted(decode_events(read_events_stream(spark, fmt="parquet", path=f"{base}/landing"), keep=("topic",)))
        query = _drained(start_table_queries(decoded, f"{base}/tables", f"{base}/checkpoints", trigger="availableNow", tables=(name,))[name])
        after = open_windows(spark, f"{base}/checkpoints/{name}", query.lastProgress["batchId"])
        held.append(after.select(F.lit(run).alias("run"), "greenhouse_id", "window_start", "window_end", "event_count"))
    return C._ntz(union_sources(*held))


def _state_sql() -> str:
    parts = []
    for run in (1, 2, 3):
        rows, sliced = sliced_sql(at_end_of=run)
        parts.append(f"""
SELECT {run} AS run, greenhouse_id, time_bucket(INTERVAL 5 MINUTES, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES AS window_end, count(*) AS event_count
FROM ({rows}) k WHERE time_bucket(INTERVAL 5 MINUTES, event_time) + INTERVAL 5 MINUTES > mark GROUP BY ALL""")
    return f"WITH {sliced} {' UNION ALL '.join(parts)}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stream_topic_log": q_stream_topic_log,
        "topic_log_offsets": q_topic_log_offsets,
        "stream_growing_csv": q_stream_growing_csv,
        "stream_shared_tables": q_stream_shared_tables,
        "stream_batch_report": q_stream_batch_report,
        "stream_state_rows": q_stream_state_rows,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "stream_topic_log": _topic_log_sql(),
        "topic_log_offsets": TOPIC_LOG_OFFSETS_SQL,
        "stream_growing_csv": STREAM_GROWING_CSV_SQL,
        "stream_shared_tables": _shared_sql(),
        "stream_batch_report": _batch_report_sql(),
        "stream_state_rows": _state_sql(),
    }

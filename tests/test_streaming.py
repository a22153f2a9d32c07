"""Structured Streaming: golden trace (F8), restart from checkpoint, stream == batch."""

import json
import os
import time

from pyspark.sql import functions as F

from verdant.operators.decode import accepted, decode_events
from verdant.operators.windows import window_metrics
from verdant.schemas import WINDOW_METRICS
from verdant.sinks.upsert import UpsertTable
from verdant.streaming.job import start_table_queries
from verdant.streaming.progress import batch_summary

BATCHES = [
    [("12:00:00", 1), ("12:08:00", 2)],
    [("12:04:59", 100), ("12:05:30", 4)],
    [("12:04:58", 200), ("12:05:31", 6), ("12:20:00", 9)],
    [("12:05:32", 8), "bad", (None, 7)],
    [("12:05:33", 8), ("12:16:00", 3)],
]


def _line(item):
    if item == "bad":
        return "bad"
    t, v = item
    ev = {"greenhouse_id": "gh", "temperature_c": float(v)}
    if t is not None:
        ev["event_ts"] = f"2026-01-01T{t}+00:00"
    return json.dumps(ev)


def _land(folder, batches, start=0):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, items in enumerate(batches, start):
        path = os.path.join(folder, f"b{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(_line(x) for x in items) + "\n")
        os.utime(path, (base + i, base + i))


def _stream(spark, folder):
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return accepted(decode_events(raw))


def _hm(ts):
    return ts.strftime("%H:%M")


def test_f8_golden_trace(spark, workdir):
    _land(workdir + "/in", BATCHES)
    out = {}

    def collect(df, batch_id):
        out[batch_id] = sorted((_hm(r["window_start"]), r["avg_temperature"], r["event_count"])
                               for r in df.collect())

    agg = window_metrics(_stream(spark, workdir + "/in"), watermark="2 minutes")
    q = (agg.writeStream.outputMode("update").option("checkpointLocation", workdir + "/ck")
         .foreachBatch(collect).trigger(availableNow=True).start())
    q.awaitTermination()
    assert out[0] == [("12:00", 1.0, 1), ("12:05", 2.0, 1)]
    assert out[1] == [("12:00", 50.5, 2), ("12:05", 3.0, 2)]
    assert out[2] == [("12:05", 4.0, 3), ("12:20", 9.0, 1)]
    assert out[3] == [("12:05", 5.0, 4)]
    assert out[4] == [("12:15", 3.0, 1)]
    summary = batch_summary(q)[:5]
    assert [b["late_rows_dropped"] for b in summary] == [0, 0, 1, 0, 1]
    marks = [b["watermark"][11:16] for b in summary]
    assert summary[0]["watermark"].startswith("1970-01-01")
    assert marks[1:] == ["12:06", "12:06", "12:18", "12:18"]


def test_upsert_tables_after_restart(spark, workdir):
    _land(workdir + "/in", BATCHES[:2])
    tables, ck = workdir + "/tables", workdir + "/ck"
    qs = start_table_queries(_stream(spark, workdir + "/in"), tables, ck, trigger="availableNow",
                             tables=("window_metrics",))
    qs["window_metrics"].awaitTermination()
    _land(workdir + "/in", BATCHES[2:], start=2)
    qs = start_table_queries(_stream(spark, workdir + "/in"), tables, ck, trigger="availableNow",
                             tables=("window_metrics",))
    qs["window_metrics"].awaitTermination()
    latest = UpsertTable(tables + "/window_metrics", WINDOW_METRICS).latest(spark)
    got = sorted((_hm(r["window_start"]), r["avg_temperature"], r["event_count"]) for r in latest.collect())
    assert got == [("12:00", 50.5, 2), ("12:05", 5.0, 4), ("12:15", 3.0, 1), ("12:20", 9.0, 1)]


def test_stream_in_one_batch_equals_batch(spark, workdir):
    from tests.conftest import SF001
    from verdant.plans import catalog
    a = catalog.q_stream_window_metrics(spark, SF001)
    b = catalog.q_window_metrics(spark, SF001)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_streaming_job_on_landed_records(spark, workdir):
    from verdant.options import JobOptions
    from verdant.sinks.publish import to_keyed_records, write_records
    from verdant.sources.testdata import sensor_events
    from verdant.streaming.job import run_streaming_job
    from tests.conftest import SF001
    ev = sensor_events(spark, SF001, with_text_time=True).withColumn("event_id", F.col("event_id").try_cast("int"))
    rec = to_keyed_records(ev)
    bad = spark.createDataFrame([("gh-0", "not json", "x")], "key string, value string, topic string")
    write_records(rec.unionByName(bad), fmt="parquet", path=workdir + "/landing")
    opts = JobOptions(table_root=workdir + "/tables", checkpoint_root=workdir + "/ck", write_rejects=True)
    qs = run_streaming_job(spark, opts, fmt="parquet", path=workdir + "/landing", trigger="availableNow", wait=False)
    for q in qs.values():
        q.awaitTermination()
    from verdant.sources.tables import read_table
    wm = read_table(spark, workdir + "/tables", "window_metrics")
    wms = read_table(spark, workdir + "/tables", "window_metrics_by_source")
    total = ev.count()
    assert wm.groupBy().sum("event_count").first()[0] == total
    assert wms.groupBy().sum("event_count").first()[0] == total
    rej = spark.read.parquet(workdir + "/tables/rejects")
    assert [r["reject_reason"] for r in rej.collect()] == ["unparseable_payload"]


def test_crop_csv_stream(spark, workdir):
    from verdant.operators.normalize import normalize_crop_rows
    from verdant.sources.csv import stream_crop_csv
    os.makedirs(workdir + "/csv")
    with open(workdir + "/csv/a.csv", "w") as f:
        f.write("greenhouse_id,crop_type,avg_temperature_C,humidity_percent,co2_ppm,light_intensity_lux,"
                "irrigation_mm\n2,Tomato,21.5,60,800,9000,5\n")
    rows = stream_crop_csv(spark, workdir + "/csv").withColumn("event_id", F.lit(1))
    out = []
    q = (normalize_crop_rows(rows).writeStream.foreachBatch(lambda df, i: out.extend(df.collect()))
         .option("checkpointLocation", workdir + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(out) == 1 and out[0]["greenhouse_id"] == "alm-nijar" and out[0]["soil_moisture_pct"] == 30.0


def test_stream_compaction_every_batch(spark, workdir):
    _land(workdir + "/in", BATCHES)
    tables = workdir + "/tables"
    qs = start_table_queries(_stream(spark, workdir + "/in"), tables, workdir + "/ck", trigger="availableNow",
                             tables=("window_metrics",), compact_every=2)
    qs["window_metrics"].awaitTermination()
    t = UpsertTable(tables + "/window_metrics", WINDOW_METRICS)
    assert t.current_base(spark) is not None
    got = sorted((_hm(r["window_start"]), r["avg_temperature"], r["event_count"]) for r in t.latest(spark).collect())
    assert got == [("12:00", 50.5, 2), ("12:05", 5.0, 4), ("12:15", 3.0, 1), ("12:20", 9.0, 1)]


def test_listener_reports_batches(spark, workdir):
    from verdant.streaming.progress import BatchReportListener
    _land(workdir + "/in", BATCHES[:2])
    reports = []
    listener = BatchReportListener(reports.append)
    spark.streams.addListener(listener)
    try:
        agg = window_metrics(_stream(spark, workdir + "/in"), watermark="2 minutes")
        q = (agg.writeStream.outputMode("update").format("noop").queryName("listened")
             .option("checkpointLocation", workdir + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        deadline = time.time() + 10
        while time.time() < deadline and len([r for r in reports if r["name"] == "listened"]) < 2:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = [r["input_rows"] for r in reports if r["name"] == "listened"]
    assert rows[:2] == [2, 2]


def test_time_ordered_files_one_batch_each_equal_batch_result(spark, workdir):
    from tests.conftest import SF001
    from verdant.plans.catalog import _round_doubles
    from verdant.sinks.publish import to_keyed_records
    from verdant.sources.events import read_events_stream
    from verdant.sources.testdata import sensor_events
    ev = sensor_events(spark, SF001, with_text_time=True).withColumn("event_id", F.col("event_id").try_cast("int"))
    bounds = ["2024-01-01", "2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25", "2024-02-01"]
    base = time.time() - 1000
    for k in range(len(bounds) - 1):
        part = ev.filter((F.col("event_time") >= F.lit(bounds[k]).cast("timestamp_ntz"))
                         & (F.col("event_time") < F.lit(bounds[k + 1]).cast("timestamp_ntz")))
        folder = f"{workdir}/in/chunk{k}"
        to_keyed_records(part).coalesce(1).write.parquet(folder)
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                os.utime(os.path.join(folder, name), (base + k, base + k))  # files arrive in time order
    raw = read_events_stream(spark, fmt="parquet", path=workdir + "/in/*/*.parquet", max_files_per_trigger=1)
    qs = start_table_queries(accepted(decode_events(raw, keep=("topic",))), workdir + "/tables", workdir + "/ck",
                             trigger="availableNow")
    for q in qs.values():
        q.awaitTermination()
        assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 5
    for name, direct in (("window_metrics", window_metrics(sensor_events(spark, SF001))),):
        got = _round_doubles(UpsertTable(f"{workdir}/tables/{name}", WINDOW_METRICS).latest(spark))
        exp = _round_doubles(direct).select(*got.columns)
        got = got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
            "window_end", F.col("window_end").cast("timestamp_ntz"))
        assert got.count() == exp.count()
        assert got.exceptAll(exp).count() == 0


def test_default_trigger_job_runs_until_stopped(spark, workdir):
    from verdant.options import JobOptions
    from verdant.sinks.publish import to_keyed_records, write_records
    from verdant.sources.tables import read_table
    from verdant.sources.testdata import sensor_events
    from verdant.streaming.job import run_streaming_job
    from tests.conftest import SF001
    ev = sensor_events(spark, SF001, with_text_time=True).withColumn("event_id", F.col("event_id").try_cast("int"))
    write_records(to_keyed_records(ev), fmt="parquet", path=workdir + "/landing")
    opts = JobOptions(table_root=workdir + "/tables", checkpoint_root=workdir + "/ck")
    qs = run_streaming_job(spark, opts, fmt="parquet", path=workdir + "/landing", wait=True, wait_timeout=1)
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not all(
                any(p.numInputRows > 0 for p in q.recentProgress) for q in qs.values()):
            time.sleep(0.5)
        for q in qs.values():
            q.processAllAvailable()
    finally:
        for q in qs.values():
            q.stop()
    total = ev.count()
    for name in ("window_metrics", "window_metrics_by_source"):
        assert read_table(spark, workdir + "/tables", name).groupBy().sum("event_count").first()[0] == total


def test_crash_after_write_then_replay_is_idempotent(spark, workdir):
    _land(workdir + "/in", BATCHES)
    tables, ck = workdir + "/tables", workdir + "/ck"
    crashed = []

    def crash_once(name, batch_id, rows):
        if batch_id == 2 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("driver lost after writing batch 2")

    qs = start_table_queries(_stream(spark, workdir + "/in"), tables, ck, trigger="availableNow",
                             tables=("window_metrics",), report=crash_once)
    try:
        qs["window_metrics"].awaitTermination()
    except Exception:  # noqa: BLE001 - the injected failure
        pass
    assert crashed == [2]
    qs = start_table_queries(_stream(spark, workdir + "/in"), tables, ck, trigger="availableNow",
                             tables=("window_metrics",))
    qs["window_metrics"].awaitTermination()
    latest = UpsertTable(tables + "/window_metrics", WINDOW_METRICS).latest(spark)
    got = sorted((_hm(r["window_start"]), r["avg_temperature"], r["event_count"]) for r in latest.collect())
    assert got == [("12:00", 50.5, 2), ("12:05", 5.0, 4), ("12:15", 3.0, 1), ("12:20", 9.0, 1)]

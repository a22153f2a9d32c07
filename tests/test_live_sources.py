"""Topics kept as logs and files that grow: positions, restarts, bounds, splits, and what goes wrong."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from verdant import schemas as S
from verdant.operators.decode import accepted, decode_events
from verdant.options import JobOptions
from verdant.sinks.topic_log import append_records
from verdant.sources import growing_lines as G
from verdant.sources import topic_log as L
from verdant.sources.csv import stream_growing_csv
from verdant.sources.events import read_events_stream, read_topic_log
from verdant.sources.offsets import Progress, bounded
from verdant.sources.tables import read_shared_table
from verdant.streaming.ingest import start_growing_crop_ingest
from verdant.streaming.job import run_streaming_job, start_shared_query
from verdant.streaming.progress import batch_summary

HEADER = "greenhouse_id,crop_type,avg_temperature_C,humidity_percent,co2_ppm,light_intensity_lux,irrigation_mm\n"


def records(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, topic string")


def drained(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def stream_values(spark, root, checkpoint, out, **options):
    """Values read in one run of a stream over the log, in a folder per run."""
    opts = JobOptions(topics=("a", "b"), starting_offsets=options.pop("start", "earliest"), **options)
    raw = read_events_stream(spark, opts, fmt="topiclog", path=root, progress=f"{checkpoint}/progress")
    q = (raw.selectExpr("topic", "partition", "offset", "cast(value as string) value").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    return sorted((r.topic, r.partition, r.offset, r.value) for r in spark.read.parquet(out).collect()) if os.path.exists(out) else []


def test_offsets_go_on_over_publishes(spark, workdir):
    for k in range(3):
        append_records(records(spark, [(f"k{i % 5}", f"{k}.{i}", "a" if i % 2 else "b") for i in range(40)]), workdir, partitions=2, segment_rows=7)
    rows = read_topic_log(spark, workdir, ("a", "b")).collect()
    assert sorted(bytes(r.value).decode() for r in rows) == sorted(f"{k}.{i}" for k in range(3) for i in range(40))
    places = {}
    for r in rows:
        places.setdefault((r.topic, r.partition), []).append(r.offset)
    assert len(places) > 2 and all(sorted(o) == list(range(len(o))) for o in places.values())
    by_key = {}
    for r in rows:
        by_key.setdefault((r.topic, bytes(r.key)), set()).add(r.partition)
    assert all(len(p) == 1 for p in by_key.values())  # a key's records stay in one partition
    assert {r.topic for r in read_topic_log(spark, workdir, ("a",)).collect()} == {"a"}
    part = read_topic_log(spark, workdir, ("a",), starting_offsets='{"a": {"0": 3, "1": 2}}', ending_offsets='{"a": {"0": 9, "1": 2}}').collect()
    assert sorted((r.partition, r.offset) for r in part) == [(0, o) for o in range(3, 9)]
    assert read_topic_log(spark, workdir, ("none",)).count() == 0


def test_a_stream_starts_at_the_end_and_goes_on(spark, workdir):
    log, ck, out = workdir + "/log", workdir + "/ck", workdir + "/out"
    append_records(records(spark, [("k", "old", "a")]), log)
    assert stream_values(spark, log, ck, out, start="latest") == []
    append_records(records(spark, [("k", "one", "a"), ("k", "two", "b")]), log)  # topic b appears later: from its first record
    assert [v[3] for v in stream_values(spark, log, ck, out, start="latest")] == ["one", "two"]
    append_records(records(spark, [("k", "three", "a"), (None, "nil", "b")]), log)
    assert sorted(v[3] for v in stream_values(spark, log, ck, out, start="latest")) == ["nil", "one", "three", "two"]


def test_latest_needs_a_place_to_remember(spark):
    with pytest.raises(ValueError, match="progress"):
        L.TopicLogStreamReader({"path": "/nowhere"})


def test_bounded_batches_also_after_a_restart(spark, workdir):
    log = workdir + "/log"
    append_records(records(spark, [(f"k{i}", str(i), "a") for i in range(100)]), log)
    reader = L.TopicLogStreamReader({"path": log, "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10", "progress": workdir + "/p"})
    at, sizes = reader.initialOffset(), []
    while (to := reader.latestOffset()) != at:
        spans = reader.partitions(at, to)
        sizes.append(sum(s.high - s.low for s in spans))
        reader.commit(to)
        at = to
        reader = L.TopicLogStreamReader({"path": log, "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10", "progress": workdir + "/p"})
    assert sum(sizes) == 100 and max(sizes) <= 12
    assert bounded({"x": 5}, {"x": 5, "y": 9}, 3) == {"x": 5, "y": 3}


def test_a_hot_partition_is_read_by_many_tasks(spark, workdir):
    append_records(records(spark, [("hot", str(i), "a") for i in range(100)]), workdir)
    reader = L.TopicLogStreamReader({"path": workdir, "startingOffsets": "earliest", "rowsPerPartition": "9"})
    spans = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(spans) >= 12 and max(s.high - s.low for s in spans) <= 9
    got = [(o, v) for s in spans for b in reader.read(s) for o, v in zip(b.column("offset").to_pylist(), b.column("value").to_pylist())]
    assert [o for o, _ in got] == list(range(100)) and sorted(int(v) for _, v in got) == list(range(100))


def test_removed_offsets_are_an_error_and_holes_wait(spark, workdir):
    for k in range(3):
        append_records(records(spark, [("k", str(k), "a")] * 4), workdir)
    (first, second, third) = sorted(os.path.join(d, f) for d, _, fs in os.walk(workdir) for f in fs if f.endswith(".parquet") and "topic=" in d)
    reader = L.TopicLogStreamReader({"path": workdir, "startingOffsets": "earliest"})
    start, end = reader.initialOffset(), reader.latestOffset()
    os.rename(second, second + ".gone")
    assert list(reader.log.ends().values()) == [4]
    os.rename(second + ".gone", second)
    os.rename(first, first + ".gone")
    with pytest.raises(ValueError, match="no longer all there"):
        reader.partitions(start, end)


def test_records_need_a_topic(spark, workdir):
    with pytest.raises(PySparkException):
        append_records(records(spark, [("k", "v", None)]), workdir)
    assert append_records(records(spark, []), workdir) == 0


def test_progress(workdir):
    kept = Progress(workdir + "/p")
    assert kept.load("initial") is None
    kept.save("initial", {"a": {"0": 1}})
    kept.save("initial", {"a": {"0": 2}})
    assert kept.load("initial") == {"a": {"0": 2}} and Progress(None).load("initial") is None


# ------------------------------------------------------------- growing files

def read_lines(path, low, high, size, whole=True):
    parts = [G.ByteRange("f", a, min(high, a + size), whole and a == low) for a in range(low, high, size)]
    out = []
    for p in parts:
        with pa.OSFile(path) as stream:
            out.append([(pos, line) for b in G.lines_of(stream, p) for pos, line in zip(b.column("position").to_pylist(), b.column("line").to_pylist())])
    return out


@pytest.mark.parametrize("block", [1, 3, 64])
def test_every_line_belongs_to_one_range(workdir, monkeypatch, block):
    monkeypatch.setattr(G, "BLOCK", block)
    rng = random.Random(block)
    lines = [("x" * rng.choice([0, 1, 2, 5, 40]) + str(i)).encode() + rng.choice([b"\n", b"\r\n"]) for i in range(60)]
    data = b"".join(lines) + b"not yet"
    path = workdir + "/f"
    open(path, "wb").write(data)
    with pa.OSFile(path) as stream:
        end = G.last_line_end(stream, 0, len(data))
        assert end == len(data) - 7 and G.last_line_end(stream, end, len(data)) == end
    want, at = [], 0
    for line in lines:
        want.append((at, line.rstrip(b"\r\n")))
        at += len(line)
    for size in (1, 2, 7, 50, 10_000):
        got = read_lines(path, 0, end, size)
        assert [x for part in got for x in part] == want
    middle = want[20][0]
    assert [x for part in read_lines(path, middle, end, 30) for x in part] == want[20:]


def crop_rows(spark, folder, checkpoint, out):
    rows = stream_growing_csv(spark, folder, checkpoint + "/progress")
    q = drained(rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    assert q is not None
    return sorted((r._split_file, r.greenhouse_id, r.crop_type, r.irrigation_mm) for r in spark.read.parquet(out).collect())


def test_appended_rows_and_unfinished_lines(spark, workdir):
    folder, ck, out = workdir + "/csv", workdir + "/ck", workdir + "/out"
    os.makedirs(folder)
    with open(folder + "/a.csv", "w") as f:
        f.write(HEADER + '1,"Tom,ato",20,50,400,1000,1\n2,Pep')
    assert crop_rows(spark, folder, ck, out) == [("a.csv", "1", "Tom,ato", "1")]
    with open(folder + "/a.csv", "a") as f:
        f.write("per,21\n\n3,,,,,,3,extra\r\n")
    with open(folder + "/b.csv", "w") as f:
        f.write(HEADER.upper() + "4,Bean,1,1,1,1,9\n")
    assert crop_rows(spark, folder, ck, out) == [("a.csv", "1", "Tom,ato", "1"), ("a.csv", "2", "Pepper", None), ("a.csv", "3", None, "3"), ("b.csv", "4", "Bean", "9")]


def test_replaced_files_and_other_headers_are_errors(spark, workdir):
    folder = workdir + "/csv"
    os.makedirs(folder)
    open(folder + "/a.csv", "w").write(HEADER + "1,T,1,1,1,1,1\n")
    reader = G.GrowingLinesReader({"path": folder})
    reader.partitions(reader.initialOffset(), reader.latestOffset())
    open(folder + "/a.csv", "w").write(HEADER)
    with pytest.raises(ValueError, match="replaced"):
        reader.latestOffset()
    open(folder + "/a.csv", "w").write("other,header\n1,2\n")
    rows = stream_growing_csv(spark, folder, workdir + "/ck2/progress")
    q = rows.writeStream.format("parquet").option("path", workdir + "/o").option("checkpointLocation", workdir + "/ck2").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="unexpected header in a.csv"):
        q.awaitTermination()


def test_bounded_bytes_still_take_whole_lines(workdir):
    open(workdir + "/a.csv", "w").write("h\n" + "".join(f"{'y' * (i % 40)}\n" for i in range(200)))
    reader = G.GrowingLinesReader({"path": workdir, "maxBytesPerTrigger": "100", "bytesPerPartition": "30"})
    at, got, batches = reader.initialOffset(), [], 0
    while (to := reader.latestOffset()) != at:
        for p in reader.partitions(at, to):
            got += [line for b in reader.read(p) for line in b.column("line").to_pylist()]
        at, batches = to, batches + 1
    assert got == [b"h", *(b"y" * (i % 40) for i in range(200))] and batches > 20


def test_growing_ingest_numbers_on(spark, workdir):
    folder = workdir + "/csv"
    os.makedirs(folder)
    for text in (HEADER + "1,Tomato,20,50,400,1000,1\n", "2,Pepper,21,51,401,1001,2\nx,Bean,1,1,1,1,1\n", "", "3,Bean,22,52,402,1002,3\n"):
        with open(folder + "/a.csv", "a") as f:
            f.write(text)
        drained(start_growing_crop_ingest(spark, folder, workdir + "/ck", path=workdir + "/records", rejects_path=workdir + "/rejects", trigger_available_now=True))
    events = accepted(decode_events(spark.read.parquet(workdir + "/records"))).collect()
    assert sorted((r.event_id, r.sensor_id) for r in events) == [(1, "crop-tomato-0001"), (2, "crop-pepper-0002"), (4, "crop-bean-0004")]
    assert [r.event_id for r in spark.read.parquet(workdir + "/rejects").collect()] == [3]


# ------------------------------------------------------------- one query for both tables

EVENT = '{{"greenhouse_id":"g","data_source":"{}","source_topic":"t","temperature_c":{},"event_ts":"2026-01-01T12:{:02d}:00+00:00"}}'


def test_one_commit_for_both_tables(spark, workdir):
    log = workdir + "/log"
    opts = JobOptions(topics=("t",), starting_offsets="earliest", table_root=workdir + "/tables", checkpoint_root=workdir + "/ck", shared_tables=True)
    reports = []
    for k, rows in enumerate(([("a", 1, 0), ("b", 3, 1)], [("a", 5, 2), ("b", 7, 7)], [])):
        append_records(records(spark, [("g", EVENT.format(*r), "t") for r in rows]), log)
        if k < 2:
            run_streaming_job(spark, opts, fmt="topiclog", path=log, trigger="availableNow")
        else:
            raw = read_events_stream(spark, opts, fmt="topiclog", path=log, progress=f"{workdir}/ck/window_tables/source_progress")
            q = drained(start_shared_query(accepted(decode_events(raw, keep=("topic",))), opts.table_root, opts.checkpoint_root, opts, "availableNow",
                                           report=lambda *r: reports.append(r)))
            assert all(b["sources"] == 1 for b in batch_summary(q))
    entries = [e for e in os.listdir(workdir + "/tables/window_tables/_log") if ".commit." in e and not e.startswith(".")]
    assert len(entries) == 2 and reports == []  # a run without new rows leaves nothing
    assert len(os.listdir(workdir + "/tables/window_tables/data")) == 2
    one = sorted((r.window_start.minute, r.avg_temperature, r.event_count) for r in read_shared_table(spark, opts.table_root, S.WINDOW_METRICS.name).collect())
    assert one == [(0, 3.0, 3), (5, 7.0, 1)]
    two = sorted((r.data_source, r.window_start.minute, r.avg_temperature, r.event_count)
                 for r in read_shared_table(spark, opts.table_root, S.WINDOW_METRICS_BY_SOURCE.name).collect())
    assert two == [("a", 0, 3.0, 2), ("b", 0, 3.0, 1), ("b", 5, 7.0, 1)]


def test_options_of_one_query():
    assert JobOptions.from_env({"SHARED_TABLES": "true"}).shared_tables and not JobOptions.from_env({}).shared_tables

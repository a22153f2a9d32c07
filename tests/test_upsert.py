"""Keyed tables: upsert by key, replay, legacy key, empty batches (F5, SNK3-SNK6, AGG11)."""

import datetime as dt

from verdant import schemas as S
from verdant.sinks.upsert import BACKFILL, VERSION, UpsertTable

T0 = dt.datetime(2026, 1, 1, 12, 0)
T1 = dt.datetime(2026, 1, 1, 12, 5)


def _wm(spark, rows):
    return spark.createDataFrame(rows, S.WINDOW_METRICS_SCHEMA)


def test_f5_upsert_and_replay(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 2.0, 2.0, 2.0, 2)]), 1)
    rows = t.latest(spark).collect()
    assert len(rows) == 1 and rows[0]["event_count"] == 2
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 2.0, 2.0, 2.0, 2)]), 1)  # replay
    rows = t.latest(spark).collect()
    assert len(rows) == 1 and rows[0]["event_count"] == 2
    assert t.versions(spark).count() == 2
    # a replay keeps its place: it does not outrank what another writer wrote since
    UpsertTable(workdir + "/wm", S.WINDOW_METRICS).write_batch(_wm(spark, [("gh-0", T0, T1, 3.0, 3.0, 3.0, 3)]), 0)
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 2.0, 2.0, 2.0, 2)]), 1)
    assert t.latest(spark).first()["event_count"] == 3


def test_new_run_wins_over_old_run(spark, workdir):
    old = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    old.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 9)]), 5)
    new = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r2")
    new.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 3)]), 0)
    assert new.latest(spark).first()["event_count"] == 3


def test_missing_table_reads_empty(spark, workdir):
    t = UpsertTable(workdir + "/nothing", S.WINDOW_METRICS)
    assert t.latest(spark).count() == 0


def test_legacy_key_collapses_topics(spark, workdir):
    t = UpsertTable(workdir + "/wms", S.WINDOW_METRICS_BY_SOURCE)
    rows = [("csv", "topic.a", "gh-0", T0, T1, 1.0, 1.0, 1.0, 1),
            ("csv", "topic.b", "gh-0", T0, T1, 2.0, 2.0, 2.0, 2)]
    t.write_batch(spark.createDataFrame(rows, S.WINDOW_METRICS_BY_SOURCE_SCHEMA), 0)
    assert t.latest(spark).count() == 2
    legacy = t.latest(spark, key=S.LEGACY_BY_SOURCE_KEY, tie=("source_topic",)).collect()
    assert len(legacy) == 1 and legacy[0]["source_topic"] == "topic.b"


def test_foreach_batch_skips_empty_and_reports(spark, workdir):
    seen = []
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, report=lambda n, b, r: seen.append((n, b, r)))
    fn = t.foreach_batch()
    fn(_wm(spark, []), 0)
    fn(_wm(spark, [("gh-1", T0, T1, 1.0, 1.0, 1.0, 1)]), 1)
    assert seen == [("window_metrics", 1, 1)]
    assert t.latest(spark).count() == 1


def test_key_and_time_filters_reach_the_scan(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1), ("gh-1", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    df = t.latest(spark).filter("greenhouse_id = 'gh-1' AND window_start > TIMESTAMP '2026-01-01 11:00:00'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(greenhouse_id), IsNotNull(window_start), EqualTo(greenhouse_id,gh-1), GreaterThan(" in plan
    assert df.count() == 1


def test_compaction_keeps_content_and_later_writes_win(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1), ("gh-1", T0, T1, 1.0, 1.0, 1.0, 5)]), 0)
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 2.0, 2.0, 2.0, 2)]), 1)
    before = sorted(tuple(r) for r in t.latest(spark).collect())
    base = t.compact(spark)
    assert base.kind == "base"
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before
    assert t.versions(spark).count() == 2  # only the base rows remain live
    # replaying an old batch after compaction changes nothing; a newer batch wins
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 3.0, 3.0, 3.0, 3)]), 2)
    got = {r["greenhouse_id"]: r["event_count"] for r in t.latest(spark).collect()}
    assert got == {"gh-0": 3, "gh-1": 5}
    # a second compaction supersedes the first
    assert t.compact(spark) > base
    assert {r["greenhouse_id"]: r["event_count"] for r in t.latest(spark).collect()} == got


def test_compaction_keeps_versions_for_legacy_view(spark, workdir):
    t = UpsertTable(workdir + "/wms", S.WINDOW_METRICS_BY_SOURCE, run_id="r1")
    row = ("csv", "topic.b", "gh-0", T0, T1, 2.0, 2.0, 2.0, 2)
    t.write_batch(spark.createDataFrame([row], S.WINDOW_METRICS_BY_SOURCE_SCHEMA), 0)
    t.write_batch(spark.createDataFrame([("csv", "topic.a", "gh-0", T0, T1, 1.0, 1.0, 1.0, 1)],
                                        S.WINDOW_METRICS_BY_SOURCE_SCHEMA), 1)
    legacy = t.latest(spark, key=S.LEGACY_BY_SOURCE_KEY, tie=("source_topic",)).first()
    assert legacy["source_topic"] == "topic.a"  # the later batch wins over the greater topic
    t.compact(spark)
    after = t.latest(spark, key=S.LEGACY_BY_SOURCE_KEY, tie=("source_topic",)).first()
    assert after["source_topic"] == "topic.a"


def test_files_sorted_in_table_order(spark, workdir):
    import glob
    import pyarrow.parquet as pq
    from verdant.sources.tables import in_table_order
    t = UpsertTable(workdir + "/wms", S.WINDOW_METRICS_BY_SOURCE)
    rows = [("csv", "t", gh, T0 + dt.timedelta(minutes=5 * i), T1, 1.0, 1.0, 1.0, i)
            for i in range(20) for gh in ("gh-1", "gh-0")]
    t.write_batch(spark.createDataFrame(rows, S.WINDOW_METRICS_BY_SOURCE_SCHEMA).repartition(1), 0)
    for f in glob.glob(workdir + "/wms/**/*.parquet", recursive=True):
        tab = pq.read_table(f).to_pylist()
        keys = [(-r["window_start"].timestamp(), r["greenhouse_id"]) for r in tab]
        assert keys == sorted(keys)
    first = in_table_order(t.latest(spark), S.WINDOW_METRICS_BY_SOURCE).first()
    assert first["window_start"] == T0 + dt.timedelta(minutes=95) and first["greenhouse_id"] == "gh-0"


def test_commit_order_counts_not_start_order(spark, workdir):
    """A batch job that started later but wrote earlier loses to the running stream's later batch."""
    stream = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    job = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r9999")
    job.write_batch(_wm(spark, [("gh-0", T0, T1, 20.0, 1.0, 1.0, 1)]), 7)
    stream.write_batch(_wm(spark, [("gh-0", T0, T1, 30.0, 1.0, 1.0, 2)]), 0)
    assert job.latest(spark).first()["avg_temperature"] == 30.0
    job.compact(spark)
    stream.write_batch(_wm(spark, [("gh-2", T0, T1, 1.0, 1.0, 1.0, 4)]), 1)  # after a compaction of the other's
    got = {r["greenhouse_id"]: r["event_count"] for r in job.latest(spark).collect()}
    assert got == {"gh-0": 2, "gh-2": 4}


def test_backfill_after_compaction_fills_gaps_only(spark, workdir):
    live = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    live.write_batch(_wm(spark, [("gh-1", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    live.compact(spark)
    back = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, priority=BACKFILL)
    back.write_batch(_wm(spark, [("gh-1", T0, T1, 9.0, 9.0, 9.0, 9), ("gh-9", T0, T1, 9.0, 9.0, 9.0, 9)]), 0)
    for _ in range(2):
        got = {r["greenhouse_id"]: r["event_count"] for r in live.latest(spark).collect()}
        assert got == {"gh-1": 1, "gh-9": 9}
        live.compact(spark)


def test_empty_and_null_keys_stay_apart(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    t.write_batch(_wm(spark, [("", T0, T1, 1.0, 1.0, 1.0, 1), (None, T0, T1, 2.0, 2.0, 2.0, 2)]), 0)
    for _ in range(2):
        assert {r["greenhouse_id"]: r["event_count"] for r in t.latest(spark).collect()} == {"": 1, None: 2}
        t.compact(spark)


def test_expire_removes_what_the_base_covers(spark, workdir):
    import os
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    for i in range(4):
        t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, i), (f"gh-{i + 1}", T0, T1, 1.0, 1.0, 1.0, i)]), i)
        if i == 1:
            t.compact(spark)
    t.compact(spark)
    before = sorted(tuple(r) for r in t.latest(spark).collect())
    assert t.expire(spark) == 0  # readers of the older folders may still run
    assert t.expire(spark, grace_seconds=0) == 4  # an older base and three commits; the writer's last stays known
    assert len(os.listdir(workdir + "/wm/data")) == 2
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 3), ("gh-4", T0, T1, 1.0, 1.0, 1.0, 3)]), 3)  # replay
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before
    t.compact(spark)
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before


def test_compaction_splits_a_hot_key(spark, workdir):
    import glob
    t = UpsertTable(workdir + "/wms", S.WINDOW_METRICS_BY_SOURCE)
    rows = spark.range(4000).selectExpr(
        "'hot' AS data_source", "'t' AS source_topic", "'gh-0' AS greenhouse_id",
        "timestamp_seconds(id * 300) AS window_start", "timestamp_seconds(id * 300 + 300) AS window_end",
        "1D AS avg_temperature", "1D AS avg_humidity", "1D AS avg_co2", "1L AS event_count")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.write_batch(rows, 0)
        base = t.compact(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(t.data_path(base.commit) + "/*.parquet")) > 1
    assert t.latest(spark).count() == 4000


def test_latest_after_compaction_skips_base_shuffle_and_matches_full_rank(spark, workdir):
    from verdant.operators.latest import latest_by_key
    t = UpsertTable(workdir + "/wms", S.WINDOW_METRICS_BY_SOURCE, run_id="r1")
    rows0 = [("s", "a", "gh-0", T0, T1, 1.0, 1.0, 1.0, 1), ("s", "a", None, T0, T1, 1.0, 1.0, 1.0, 1),
             (None, "b", "gh-1", T0, T1, 1.0, 1.0, 1.0, 1), ("s", "a", "gh-2", T0, T1, 1.0, 1.0, 1.0, 1)]
    t.write_batch(spark.createDataFrame(rows0, S.WINDOW_METRICS_BY_SOURCE_SCHEMA), 0)
    t.compact(spark)
    assert "Window" not in t.latest(spark)._jdf.queryExecution().executedPlan().toString()
    rows1 = [("s", "a", None, T0, T1, 2.0, 2.0, 2.0, 2), (None, "b", "gh-1", T0, T1, 3.0, 3.0, 3.0, 3),
             ("s", "a", "gh-9", T0, T1, 4.0, 4.0, 4.0, 4)]
    t.write_batch(spark.createDataFrame(rows1, S.WINDOW_METRICS_BY_SOURCE_SCHEMA), 1)
    fast = t.latest(spark)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    full = latest_by_key(t.versions(spark), S.WINDOW_METRICS_BY_SOURCE.primary_key, VERSION).select(*fast.columns)
    assert fast.count() == 5 == full.count()
    assert fast.exceptAll(full).count() == 0
    got = {(r["data_source"], r["greenhouse_id"]): r["event_count"] for r in fast.collect()}
    assert got == {("s", "gh-0"): 1, ("s", None): 2, (None, "gh-1"): 3, ("s", "gh-2"): 1, ("s", "gh-9"): 4}


def test_in_table_order_is_total(spark, workdir):
    from verdant.sources.tables import in_table_order
    rows = [("csv", "topic.b", "gh-0", T0, T1, 1.0, 1.0, 1.0, 1), ("csv", "topic.a", "gh-0", T0, T1, 1.0, 1.0, 1.0, 2)]
    df = spark.createDataFrame(rows, S.WINDOW_METRICS_BY_SOURCE_SCHEMA)
    assert [r["source_topic"] for r in in_table_order(df, S.WINDOW_METRICS_BY_SOURCE).collect()] == ["topic.a", "topic.b"]


def test_compaction_is_a_noop_without_newer_batches(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    assert t.compact(spark) is None
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    base = t.compact(spark)
    assert t.compact(spark) == base  # nothing newer: the base being read is left alone
    assert t.latest(spark).first()["event_count"] == 1


def test_uncommitted_data_is_ignored(spark, workdir):
    """Rows count once their log entry exists, for batches and bases alike."""
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    orphan = _wm(spark, [("gh-7", T0, T1, 1.0, 1.0, 1.0, 1)])
    orphan.write.parquet(t.data_path("0" * 32))  # a writer that died before its commit
    assert t._claim(spark, 2) and not t._claim(spark, 2)  # or after taking a number
    assert [r["greenhouse_id"] for r in t.latest(spark).collect()] == ["gh-0"]
    t.write_batch(_wm(spark, [("gh-1", T0, T1, 1.0, 1.0, 1.0, 1)]), 1)
    assert [e.number for e in t.entries(spark)] == [1, 3]
    t.compact(spark)
    assert sorted(r["greenhouse_id"] for r in t.latest(spark).collect()) == ["gh-0", "gh-1"]


def test_concurrent_writers_get_numbers_of_their_own(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor
    tables = [UpsertTable(workdir + "/wm", S.WINDOW_METRICS) for _ in range(4)]
    rows = [_wm(spark, [(f"gh-{i}", T0, T1, 1.0, 1.0, 1.0, i)]) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: tables[i].write_batch(rows[i], 0), range(4)))
    assert len({e.number for e in tables[0].entries(spark)}) == 4
    assert tables[0].latest(spark).count() == 4


def test_micro_batch_written_without_a_partition_folder_per_key(spark, workdir):
    import glob
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    df = _wm(spark, [(f"gh-{i}", T0 + dt.timedelta(minutes=5 * i), T1, 1.0, 1.0, 1.0, i) for i in range(50)]).repartition(8)
    t.foreach_batch()(df, 0)
    files = glob.glob(workdir + "/wm/data/*/*.parquet")
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and t.latest(spark).count() == 50


def test_write_batch_reports_rows(spark, workdir):
    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    assert t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1), ("gh-1", T0, T1, 1.0, 1.0, 1.0, 1)]), 0) == 2


def test_compact_tables_job(spark, workdir):
    from verdant.plans.maintenance import compact_tables
    t = UpsertTable(workdir + "/window_metrics", S.WINDOW_METRICS, run_id="r1")
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 3)
    bases = compact_tables(spark, workdir)
    assert bases["window_metrics"] == t.current_base(spark) and bases["window_metrics_by_source"] is None


def test_two_compactions_at_once_do_not_clash(spark, workdir):
    a = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    a.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    b = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r2")
    state = a._live(spark)
    b._live = lambda spark: state  # decided what to compact before the other published
    first, second = a.compact(spark), b.compact(spark)
    assert first < second
    c = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    assert c.current_base(spark) == second and c.latest(spark).count() == 1


def test_nightly_jobs_leave_two_folders(spark, workdir):
    """Every batch job is a writer of its own: after compaction and expiry its rows are in the base alone."""
    import os

    for night in range(10):
        t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
        t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, night), (f"gh-{night}", T0, T1, 1.0, 1.0, 1.0, night)]), night)
    t.compact(spark)
    before = sorted(tuple(r) for r in t.latest(spark).collect())
    assert t.expire(spark, grace_seconds=0) == 9
    assert len(os.listdir(workdir + "/wm/data")) == 2  # the base and the last commit
    assert len([n for n in os.listdir(workdir + "/wm/_log") if not n.startswith(".")]) == 4  # their entries and claims
    assert sorted(tuple(r) for r in t.latest(spark).collect()) == before and len(before) == 10


def test_streams_stay_known_while_they_live(spark, workdir):
    import os

    def stream(k):
        t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id=f"stream-{k}")
        t._is_stream = True
        return t

    for k in range(3):
        for batch in range(3):
            stream(k).write_batch(_wm(spark, [(f"gh-{k}", T0, T1, 1.0, 1.0, 1.0, batch)]), batch)
    job = UpsertTable(workdir + "/wm", S.WINDOW_METRICS)
    job.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 99)]), 0)
    job.compact(spark)
    job.expire(spark, grace_seconds=0)
    assert len(os.listdir(workdir + "/wm/data")) == 5  # base, the job's commit, each stream's last
    stream(0).write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 2)]), 2)  # replayed: the job's later row stays current
    assert {r.greenhouse_id: r.event_count for r in job.latest(spark).collect()} == {"gh-0": 99, "gh-1": 2, "gh-2": 2}
    job.compact(spark)
    job.expire(spark, grace_seconds=0, live_seconds=0)
    assert len(os.listdir(workdir + "/wm/data")) == 2
    assert {r.greenhouse_id: r.event_count for r in job.latest(spark).collect()} == {"gh-0": 99, "gh-1": 2, "gh-2": 2}


def test_what_crashed_writes_left_is_swept(spark, workdir):
    import os

    t = UpsertTable(workdir + "/wm", S.WINDOW_METRICS, run_id="r1")
    t.write_batch(_wm(spark, [("gh-0", T0, T1, 1.0, 1.0, 1.0, 1)]), 0)
    _wm(spark, [("gh-7", T0, T1, 1.0, 1.0, 1.0, 1)]).write.parquet(t.data_path("0" * 32))  # died before its commit
    t._claim(spark, 2)  # or with a number
    open(workdir + "/wm/_log/_part", "w").close()  # or with an entry that was not renamed
    t.expire(spark)
    assert len(os.listdir(workdir + "/wm/data")) == 2  # a write may still be under way
    t.expire(spark, grace_seconds=0)
    assert len(os.listdir(workdir + "/wm/data")) == 1
    assert sorted(n.split(".")[-1] for n in os.listdir(workdir + "/wm/_log") if not n.startswith("."))[0:1] != ["_part"]
    assert not os.path.exists(workdir + "/wm/_log/_part") and not os.path.exists(workdir + f"/wm/_log/{2:020d}.claim")
    assert [r.greenhouse_id for r in t.latest(spark).collect()] == ["gh-0"]

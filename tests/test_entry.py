"""Driver contract: entry() runs, every query has a matching oracle key."""

import __spark_entry__ as E
from verdant.plans import catalog


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["greenhouse_id", "window_start", "window_end", "avg_temperature", "avg_humidity",
                          "avg_co2", "event_count"]
    assert df.count() > 0


def test_every_query_has_oracle():
    q, o = catalog.queries(), catalog.oracle_sql()
    assert set(o) <= set(q)
    missing = set(q) - set(o)
    assert not missing, missing


def test_options_from_env():
    from verdant.options import JobOptions
    o = JobOptions.from_env({"KAFKA_TOPICS": "a, b", "KAFKA_BOOTSTRAP": "k:1", "CHECKPOINT_DIR": "/c"})
    assert o.topics == ("a", "b") and o.bootstrap_servers == "k:1" and o.checkpoint_root == "/c"
    assert JobOptions.from_env({}).watermark == "2 minutes"


def test_empty_env_values_fall_back_and_kafka_limits():
    from verdant.options import JobOptions
    o = JobOptions.from_env({"WINDOW_DURATION": "", "KAFKA_TOPICS": " , ", "MAX_OFFSETS_PER_TRIGGER": "5000",
                             "KAFKA_MIN_PARTITIONS": "64"})
    assert o.window == "5 minutes" and len(o.topics) == 3
    assert o.max_offsets_per_trigger == 5000 and o.extra_source_options == {"minPartitions": "64"}
    hash(o)


def test_listener_hands_reports_on():
    from types import SimpleNamespace
    from verdant.streaming.progress import BatchReportListener
    seen = []
    listener = BatchReportListener(seen.append)
    progress = SimpleNamespace(name="q", batchId=0, numInputRows=1, eventTime={}, stateOperators=[])
    listener.onQueryProgress(SimpleNamespace(progress=progress))
    assert [r["batch_id"] for r in seen] == [0]
    BatchReportListener().onQueryProgress(SimpleNamespace(progress=progress))

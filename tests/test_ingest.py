"""Continuous ingest of landed CSV files and weather responses into records."""

import os


from verdant import schemas as S
from verdant.operators.decode import accepted, decode_events
from verdant.sources.events import read_event_records
from verdant.streaming.ingest import start_crop_ingest, start_weather_ingest

HEADER = "greenhouse_id,crop_type,avg_temperature_C,humidity_percent,co2_ppm,light_intensity_lux,irrigation_mm\n"


def test_crop_ingest_numbers_rows_per_file(spark, workdir):
    os.makedirs(workdir + "/csv")
    with open(workdir + "/csv/a.csv", "w") as f:
        f.write(HEADER + "1,Tomato,20,50,400,1000,1\n2,Pepper,21,51,401,1001,2\n")
    with open(workdir + "/csv/b.csv", "w") as f:
        f.write(HEADER + "3,Bean,22,52,402,1002,3\nx,Bean,1,1,1,1,1\n")
    q = start_crop_ingest(spark, workdir + "/csv", workdir + "/ck", path=workdir + "/records",
                          rejects_path=workdir + "/rejects", trigger_available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    recs = read_event_records(spark, workdir + "/records")
    assert {r["topic"] for r in recs.collect()} == {S.TOPIC_CSV}
    ev = accepted(decode_events(recs)).collect()
    ids = sorted((r["sensor_id"], r["greenhouse_id"]) for r in ev)
    assert ids == [("crop-bean-0001", "alm-levante"), ("crop-pepper-0002", "alm-nijar"),
                   ("crop-tomato-0001", "alm-poniente")]
    rej = spark.read.parquet(workdir + "/rejects").collect()
    assert [(r["sensor_id"], r["reject_reason"]) for r in rej] == [("crop-bean-0002", "bad_greenhouse_id")]


def test_weather_ingest(spark, workdir):
    os.makedirs(workdir + "/resp")
    with open(workdir + "/resp/r1.json", "w") as f:
        f.write('[{"idema":"6325O","ta":10},{"idema":"6325O","ta":"21,5","hr":55,"sol":1.5}]')
    with open(workdir + "/resp/r2.json", "w") as f:
        f.write("[]")
    os.utime(workdir + "/resp/r1.json", (1767225600, 1767225600))
    q = start_weather_ingest(spark, workdir + "/resp", workdir + "/ck", path=workdir + "/records",
                             greenhouse_id="alm-nijar", rejects_path=workdir + "/rejects", trigger_available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    ev = accepted(decode_events(read_event_records(spark, workdir + "/records"))).collect()
    assert len(ev) == 1
    r = ev[0]
    assert (r["event_id"], r["sensor_id"], r["greenhouse_id"]) == (1767225600, "aemet-6325O", "alm-nijar")
    assert (r["temperature_c"], r["humidity_pct"], r["light_lux"]) == (21.5, 55.0, 150.0)
    assert r["data_source"] == "aemet" and r["source_topic"] == S.TOPIC_WEATHER
    assert [x["reject_reason"] for x in spark.read.parquet(workdir + "/rejects").collect()] == ["empty_observations"]


def test_per_file_ordinals_batch(spark, workdir):
    from verdant.operators.ordinals import with_file_ordinals
    for name, n in (("a.csv", 3), ("b.csv", 2)):
        with open(os.path.join(workdir, name), "w") as f:
            f.write("x\n" + "".join(f"{name}{i}\n" for i in range(n)))
    df = with_file_ordinals(spark.read.option("header", True).csv(workdir), "n", per_file=True)
    got = sorted((r["x"], r["n"]) for r in df.collect())
    assert got == [("a.csv0", 1), ("a.csv1", 2), ("a.csv2", 3), ("b.csv0", 1), ("b.csv1", 2)]


def test_replayed_ingest_batch_is_not_written_twice(spark, workdir):
    from verdant.streaming.ingest import _publish
    from verdant.operators.normalize import normalize_observations
    from verdant.sources.observations import parse_observation_array
    df = spark.createDataFrame([(1, '[{"idema":"S1","ta":"20"}]'), (2, '[{"ta":"21"}]')], "event_id int, payload string")
    events = normalize_observations(df.select("event_id", parse_observation_array("payload").alias("observations")))
    _publish(events, S.TOPIC_WEATHER, 0, "parquet", workdir + "/rec", None, workdir + "/rej")
    first = sorted(os.listdir(workdir + "/rec/batch_id=0"))
    _publish(events, S.TOPIC_WEATHER, 0, "parquet", workdir + "/rec", None, workdir + "/rej")  # replay
    assert sorted(os.listdir(workdir + "/rec/batch_id=0")) == first
    assert [r["reject_reason"] for r in spark.read.parquet(workdir + "/rej").collect()] == ["missing_station"]


def test_ingest_needs_a_target(spark, workdir):
    import pytest
    from verdant.streaming.ingest import start_weather_ingest
    with pytest.raises(ValueError):
        start_weather_ingest(spark, workdir, workdir + "/ck")  # parquet records but no path

"""Crop CSV rows (F3), weather arrays (F4), ordinals, imputation."""

import os

from pyspark.sql import functions as F

from verdant import schemas as S
from verdant.operators.normalize import (
    add_source_metadata,
    member_or_first,
    normalize_crop_rows,
    normalize_observations,
    valid_events,
)
from verdant.sources.csv import read_crop_csv
from verdant.sources.observations import parse_observation_array, read_observation_files


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_f3_crop_rows(spark, workdir):
    _write(os.path.join(workdir, "a.csv"),
           "greenhouse_id,crop_type,avg_temperature_C,humidity_percent,co2_ppm,light_intensity_lux,irrigation_mm\n"
           "2.0,Tomato,21.5,60,800,9000,5\n"
           ",Pepper,,60,800,9000,0.1\n"
           "-4,,0,60,800,9000,20\n"
           "x1,Bean,18,60,800,9000,1\n")
    rows = {r["event_id"]: r for r in normalize_crop_rows(read_crop_csv(spark, workdir)).collect()}
    r1 = rows[1]
    assert r1["greenhouse_id"] == "alm-nijar" and r1["sensor_id"] == "crop-tomato-0001"
    assert r1["soil_moisture_pct"] == 30.0 and r1["temperature_c"] == 21.5 and r1["imputed"] == []
    r2 = rows[2]
    assert r2["greenhouse_id"] == "alm-poniente" and 17.0 <= r2["temperature_c"] <= 34.0
    assert r2["soil_moisture_pct"] == 5.0 and r2["imputed"] == ["temperature_c"]
    r3 = rows[3]
    assert r3["greenhouse_id"] == "alm-poniente" and r3["sensor_id"] == "crop-sensor-0003"
    assert r3["temperature_c"] == 0.0 and r3["soil_moisture_pct"] == 90.0
    assert rows[4]["reject_reason"] == "bad_greenhouse_id"
    assert r1["zone"] in S.ZONES and r1["data_source"] == "csv" and r1["source_topic"] == S.TOPIC_CSV
    assert r1["event_ts"].endswith("+00:00")
    assert valid_events(normalize_crop_rows(read_crop_csv(spark, workdir))).count() == 3


def test_f3_missing_columns_and_modulo(spark, workdir):
    _write(os.path.join(workdir, "a.csv"), "greenhouse_id,avg_temperature_C\n7,18\n")
    r = normalize_crop_rows(read_crop_csv(spark, workdir)).first()
    assert r["greenhouse_id"] == "alm-poniente"  # (7 - 1) mod 3 = 0
    assert r["sensor_id"] == "crop-sensor-0001"
    assert 15.0 <= r["soil_moisture_pct"] <= 70.0 and "soil_moisture_pct" in r["imputed"]


def test_imputation_is_deterministic(spark, workdir):
    _write(os.path.join(workdir, "a.csv"), "greenhouse_id\n" + "1\n" * 50)
    a = normalize_crop_rows(read_crop_csv(spark, workdir)).orderBy("event_id").collect()
    b = normalize_crop_rows(read_crop_csv(spark, workdir)).orderBy("event_id").collect()
    assert [r["humidity_pct"] for r in a] == [r["humidity_pct"] for r in b]
    for r in a:
        assert 38.0 <= r["humidity_pct"] <= 90.0 and 350.0 <= r["co2_ppm"] <= 1400.0
        assert round(r["light_lux"], 2) == r["light_lux"]
    assert len({r["humidity_pct"] for r in a}) > 40


def test_ordinals_follow_file_order_across_files(spark, workdir):
    header = "greenhouse_id,crop_type\n"
    _write(os.path.join(workdir, "part-0.csv"), header + "".join(f"1,a{i}\n" for i in range(300)))
    _write(os.path.join(workdir, "part-1.csv"), header + "".join(f"1,b{i}\n" for i in range(5)))
    _write(os.path.join(workdir, "part-2.csv"), header + "".join(f"1,c{i}\n" for i in range(700)))
    df = read_crop_csv(spark, workdir).select("event_id", "crop_type").orderBy("event_id").collect()
    assert [r["event_id"] for r in df] == list(range(1, 1006))
    expected = [f"a{i}" for i in range(300)] + [f"b{i}" for i in range(5)] + [f"c{i}" for i in range(700)]
    assert [r["crop_type"] for r in df] == expected


def test_ordinals_with_split_files(spark, workdir):
    _write(os.path.join(workdir, "big.csv"),
           "greenhouse_id,crop_type\n" + "".join(f"1,row{i:06d}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        df = read_crop_csv(spark, workdir)
        rows = df.select("event_id", "crop_type").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = sorted((r["event_id"], r["crop_type"]) for r in rows)
    assert got == [(i + 1, f"row{i:06d}") for i in range(20000)]


def _obs(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "event_id int, payload string")
    df = df.select("event_id", parse_observation_array("payload").alias("observations"))
    return {r["event_id"]: r for r in normalize_observations(df, station=F.lit("6325O")).collect()}


def test_f4_weather_arrays(spark):
    rows = _obs(spark, [
        '[{"ta":10},{"ta":"21,5","hr":55,"sol":1.5}]',
        '[{"ta":"n/a","t":19}]',
        '[{"ta":"1.234,5"}]',
        '[]',
        None,
    ])
    assert (rows[0]["temperature_c"], rows[0]["humidity_pct"], rows[0]["light_lux"]) == (21.5, 55.0, 150.0)
    assert (rows[1]["temperature_c"], rows[1]["humidity_pct"], rows[1]["light_lux"]) == (19.0, 65.0, 1200000.0)
    assert rows[2]["temperature_c"] == 22.0
    assert rows[3]["reject_reason"] == "empty_observations"
    assert rows[4]["reject_reason"] == "empty_observations"
    r = rows[0]
    assert r["sensor_id"] == "aemet-6325O" and r["zone"] == "almeria-outdoor"
    assert r["greenhouse_id"] == "alm-poniente" and r["data_source"] == "aemet"
    assert 380.0 <= r["co2_ppm"] <= 520.0 and 20.0 <= r["soil_moisture_pct"] <= 55.0


def test_member_fallback(spark):
    df = spark.createDataFrame([("alm-nijar",), ("alm-aemet",), (None,)], "g string")
    got = [r[0] for r in df.select(member_or_first(F.col("g"), S.GREENHOUSES)).collect()]
    assert got == ["alm-nijar", "alm-poniente", "alm-poniente"]


def test_observation_files_keep_array_order(spark, workdir):
    _write(os.path.join(workdir, "resp.json"), '[{"idema":"A","ta":"1"},\n {"idema":"B","ta":"2,5"}]')
    obs = read_observation_files(spark, workdir).withColumn("event_id", F.lit(1))
    r = normalize_observations(obs).first()
    assert r["sensor_id"] == "aemet-B" and r["temperature_c"] == 2.5


def test_source_metadata(spark):
    df = add_source_metadata(spark.range(2), "csv", S.TOPIC_CSV)
    assert {tuple(r) for r in df.select("data_source", "source_topic").collect()} == {("csv", S.TOPIC_CSV)}


def test_ordinals_survive_task_retries():
    import subprocess
    import sys
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_ordinals_job.py")], capture_output=True,
                         text=True, timeout=600)
    assert out.stdout.strip().splitlines()[-1] == "OK", out.stdout[-2000:] + out.stderr[-2000:]


def test_mixed_header_layouts_fail_instead_of_misassigning(spark, workdir):
    import pytest
    _write(os.path.join(workdir, "a.csv"), "greenhouse_id,crop_type\n1,Tomato\n")
    _write(os.path.join(workdir, "b.csv"), "crop_type,greenhouse_id\nPepper,2\n")
    with pytest.raises(Exception):
        read_crop_csv(spark, workdir).collect()


def test_java_only_number_spellings_are_not_numbers(spark):
    from verdant.functions.numeric import first_number, text_to_double
    df = spark.createDataFrame([("1d",), ("0x1p3",), ("1e5",), (" .5 ",), ("nan",)], "s string")
    got = [r[0] for r in df.select(text_to_double("s")).collect()]
    assert got[:4] == [None, None, 100000.0, 0.5] and got[4] != got[4]
    assert df.select(first_number(["s"])).first()[0] is None


def test_blank_station_is_rejected(spark):
    df = spark.createDataFrame([(1, '[{"idema":"  ","ta":"20"}]')], "event_id int, payload string")
    obs = df.select("event_id", parse_observation_array("payload").alias("observations"))
    assert normalize_observations(obs).first()["reject_reason"] == "missing_station"


def test_whitespace_like_python_strip(spark):
    from verdant.functions.numeric import int_prefix, text_to_double
    df = spark.createDataFrame([("20\t",), ("\t2.0\n",), ("-nan",), ("\t",)], "s string")
    got = df.select(text_to_double("s").alias("d"), int_prefix("s").alias("n")).collect()
    assert got[0]["d"] == 20.0 and got[1]["d"] == 2.0 and got[2]["d"] != got[2]["d"] and got[3]["d"] is None
    assert [r["n"] for r in got] == [20, 2, None, None]


def test_loose_observations(spark):
    """Numbers, texts and other types under the same keys; unknown keys; elements and payloads that are no objects or no JSON."""
    from pyspark.sql import functions as F

    from verdant.operators.normalize import latest_observation, normalize_observations
    from verdant.sources.observations import known_readings, loose_reading, parse_loose_observations

    payloads = ['[{"ta":1},{"idema":"A","ta":21.50,"hr":"55,5","sol":true,"vis":3,"other":{"x":[7]}}]', '[{"idema":"B","ta":{"v":1},"t":"19"}]',
                '[1,"x",{"idema":5,"ta":null,"t":1e1}]', "[]", "{}", "not json", None, "[3]"]
    rows = spark.createDataFrame(list(enumerate(payloads)), "event_id long, payload string").withColumn("loose", parse_loose_observations("payload"))
    events = normalize_observations(rows.withColumn("observations", known_readings("loose")))
    got = {r.event_id: (r.sensor_id, r.temperature_c, r.humidity_pct, r.light_lux, r.reject_reason) for r in events.collect()}
    assert got[0] == ("aemet-A", 21.5, 55.5, 300.0, None)
    assert got[1][:2] == ("aemet-B", 19.0) and got[2][:2] == ("aemet-5", 10.0)
    assert [got[k][4] for k in (3, 4, 5, 6, 7)] == ["empty_observations"] * 4 + ["missing_station"]
    other = rows.select(loose_reading(latest_observation("loose"), "other.x[0]", "int").alias("x")).where(F.col("x").isNotNull()).collect()
    assert [r.x for r in other] == [7]

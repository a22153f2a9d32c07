"""The command-line entry points run end to end in their own processes."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROWS = [
    {"sensor_id": "s1", "greenhouse_id": "gh-a", "zone": "north", "temperature_c": 20.0, "humidity_pct": 50.0,
     "co2_ppm": 400.0, "soil_moisture_pct": 30.0, "light_lux": 1000.0, "event_ts": 1767225599999},
    {"sensor_id": "s2", "greenhouse_id": "gh-a", "zone": "south", "temperature_c": 22.0, "humidity_pct": 52.0,
     "co2_ppm": 420.0, "soil_moisture_pct": 30.0, "light_lux": 1000.0, "event_ts": 1767225600000},
]


def _run(args, env=None):
    return subprocess.run([sys.executable, "-m", *args], cwd=REPO, capture_output=True, text=True, timeout=600,
                          env={**os.environ, **(env or {})})


def test_batch_job_then_compaction(workdir):
    path = os.path.join(workdir, "rows.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in ROWS))
    tables = os.path.join(workdir, "tables")
    out = _run(["verdant.plans.batch_job", path, "0"], {"TABLE_ROOT": tables})
    assert out.returncode == 0, out.stderr[-2000:]
    assert "gh-a: 2025-12-31 23:55:00 - avg_temp=20.00°C, events=1" in out.stdout
    assert "gh-a: 2026-01-01 00:00:00 - avg_temp=22.00°C, events=1" in out.stdout
    out = _run(["verdant.plans.maintenance", tables])
    assert out.returncode == 0, out.stderr[-2000:]
    assert "'window_metrics': Entry(" in out.stdout and "'window_metrics_by_source': None" in out.stdout


def test_scratch_folders_go_when_the_process_ends(workdir):
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from verdant.session import build_session, scratch_path
spark = build_session("local[2]", conf={{"spark.checkpoint.dir": {workdir!r}}})
path = scratch_path(spark, "some")
spark.range(5).write.parquet(path)
assert spark.read.parquet(path).count() == 5
if {{stop}}: spark.stop()
"""
    for stop in (True, False):
        done = subprocess.run([sys.executable, "-c", code.replace("{stop}", str(stop))], capture_output=True, text=True, timeout=180)
        assert done.returncode == 0, done.stderr
        assert os.listdir(os.path.join(workdir, "verdant", "some")) == []

"""Stage timings of registered queries from Spark's event log (written to a fresh scratch folder).

Usage: python tools/stage_times.py <sf_dir> <query> [<query> ...]
Prints the slowest stages: duration, task count, stage name.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from verdant.plans import catalog  # noqa: E402
from verdant.session import build_session  # noqa: E402


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="verdant-eventlog-")
    spark = build_session("local[8]", app_name="verdant-stage-times", shuffle_partitions=8,
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    qs = catalog.queries()
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f} s")
    spark.stop()
    stages = []
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        name = Path(path).name
        if Path(path).is_dir() or name.startswith(".") or name.startswith("appstatus"):
            continue
        raw = Path(path).read_bytes()
        if name.endswith(".zstd"):  # event logs are zstd-compressed by default
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        elif name.endswith((".lz4", ".lzf", ".snappy")):
            print(f"skipped {path}: set spark.eventLog.compression.codec=zstd or disable compression")
            continue
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    ms = info.get("Completion Time", 0) - info.get("Submission Time", 0)
                    stages.append((ms, info.get("Number of Tasks"), info.get("Stage Name", "")[:90]))
    for ms, tasks, stage in sorted(stages, reverse=True)[:15]:
        print(f"{ms:7d} ms  {tasks:5d} tasks  {stage}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()

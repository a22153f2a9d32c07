"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect); the best of $BENCH_REPEAT runs is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verdant.plans import catalog  # noqa: E402
from verdant.session import build_session  # noqa: E402

HEADLINE = (
    "window_metrics",
    "window_metrics_by_source",
    "batch_millis_window_metrics",
    "decode_events",
    "crop_events",
    "weather_events",
    "source_metadata_union",
    "upsert_latest",
    "stream_window_metrics",
    "stream_window_metrics_by_source",
    "panel_01",
    "panel_11",
    "panel_12_detail",
)


def run(spark, fn, sf):
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(f"local[{cpus}]", app_name="verdant-bench", shuffle_partitions=int(cpus),
                          conf={"spark.driver.memory": "8g"})
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    run(spark, qs["window_metrics"], sf_dir)  # warm-up: JIT, file listing caches
    times = {}
    for name in names:
        times[name] = round(min(run(spark, qs[name], sf_dir) for _ in range(repeat)), 3)
    times["flagship"] = round(min(run(spark, catalog.flagship, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

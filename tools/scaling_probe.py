"""Throughput when the input has many splits: the sf0.1 events scan unioned N times
(N parallel scan tasks), timed into the noop sink.  Nothing is written."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import time
from functools import reduce
from pyspark.sql import functions as F
from verdant.session import build_session
from verdant.sources.testdata import load_table, sensor_view
from verdant.operators.windows import window_metrics
from verdant.operators.decode import accepted, decode_events
from verdant.sinks.publish import to_keyed_records
spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"})
base = load_table(spark, "/root/testdata/sf0.1", "events")
for n in (1, 8, 32):
    ev = reduce(lambda a, b: a.unionByName(b), [base] * n)
    view = sensor_view(ev, with_text_time=True)
    for name, df in (("window_metrics", window_metrics(sensor_view(ev))),
                     ("records+decode+agg", window_metrics(accepted(decode_events(to_keyed_records(view.withColumn("event_id", F.col("event_id").try_cast("int")))))))):
        best = 1e9
        for _ in range(2):
            t = time.time(); df.write.format("noop").mode("overwrite").save(); best = min(best, time.time() - t)
        print(f"{name:20s} events={n*100000:>9,d} sec={best:6.2f} events/s={n*100000/best:>12,.0f}")

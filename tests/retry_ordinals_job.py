"""Run in a separate process: ordinals under task retries (first attempts fail)."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from verdant.session import build_session  # noqa: E402
from verdant.sources.csv import read_crop_csv  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected task failure")
    return True


def main():
    folder = tempfile.mkdtemp(prefix="verdant-retry-")
    for k in range(4):
        with open(os.path.join(folder, f"part-{k}.csv"), "w") as f:
            f.write("greenhouse_id,crop_type\n" + "".join(f"1,f{k}r{i:05d}\n" for i in range(3000)))
    spark = build_session("local[2,4]", shuffle_partitions=4, conf={"spark.sql.files.maxPartitionBytes": "20000"})
    df = read_crop_csv(spark, folder)
    rows = df.filter(fail_first_attempt("crop_type")).select("event_id", "crop_type").collect()
    got = sorted((r["event_id"], r["crop_type"]) for r in rows)
    expected = [(k * 3000 + i + 1, f"f{k}r{i:05d}") for k in range(4) for i in range(3000)]
    print("OK" if got == expected else f"BAD {got[:3]} {len(got)}")
    spark.stop()


if __name__ == "__main__":
    main()

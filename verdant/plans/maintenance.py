"""Table maintenance, run as its own scheduled job: compact the keyed tables, remove what the bases cover."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from verdant.sinks.upsert import GRACE_SECONDS
from verdant.sources.tables import TABLES, open_table

log = logging.getLogger(__name__)


def compact_tables(spark: SparkSession, table_root: str, names=tuple(TABLES), grace_seconds: float = GRACE_SECONDS) -> dict:
    """Compact each table under ``table_root`` and expire what its base covers; returns each base's entry (None: empty table)."""
    out = {}
    for name in names:
        table = open_table(table_root, name)
        out[name] = table.compact(spark)
        log.info("table=%s base=%s expired=%s", name, out[name], table.expire(spark, grace_seconds))
    return out


if __name__ == "__main__":
    import sys

    from verdant.options import JobOptions
    from verdant.session import build_session

    # usage: python -m verdant.plans.maintenance [table_root]
    spark = build_session(app_name="verdant-compaction")
    root = sys.argv[1] if len(sys.argv) > 1 else JobOptions.from_env().table_root
    if not root:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            sys.exit("no table root: pass it, set TABLE_ROOT, or set spark.checkpoint.dir")
        root = f"{configured.rstrip('/')}/verdant/tables"
    print(compact_tables(spark, root))

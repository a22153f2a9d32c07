"""Keep the newest row per primary key (the store's overwrite-by-key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], version: Sequence[str],
                  tie: Sequence[str] = (), keep_version: bool = False) -> DataFrame:
    """One row per ``key``: the row with the greatest (version..., tie...).

    A ranking window partitioned by the key: one shuffle on the key and one
    sort.  (A map-side combine would not pay off: each batch writes its own
    files, so the versions of a key never meet inside one scan task.)
    Filters on key columns pass through the window and reach the scan.
    """
    order = [F.col(c).desc() for c in list(version) + list(tie)]
    w = Window.partitionBy(*key).orderBy(*order)
    ranked = df.withColumn("_version_rank", F.row_number().over(w)).filter(F.col("_version_rank") == 1)
    drop = ["_version_rank"] + ([] if keep_version else [c for c in version if c not in key])
    return ranked.drop(*drop)

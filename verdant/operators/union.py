"""Several event sources as one stream of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from one source is NULL there.

    A plain union: no shuffle, the result keeps every input partition.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

"""Threshold banding: a band starts at its value (``>=``); the base band is below."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.functions.colref import col_of


def band(c, steps: Sequence[tuple[float | None, str]]) -> Column:
    """``steps`` = [(None, base), (t1, label1), (t2, label2), ...], ascending.

    NULL and NaN get no band.
    """
    x = col_of(c)
    base = steps[0][1]
    expr = None
    for threshold, label in reversed(steps[1:]):
        cond = x >= F.lit(float(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    valid = x.isNotNull() & ~F.isnan(x)
    body = F.lit(base) if expr is None else expr.otherwise(F.lit(base))
    return F.when(valid, body)

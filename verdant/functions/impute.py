"""Deterministic stand-ins for random draws.

A missing reading is filled from an md5 of the row key and the column name,
scaled into the configured range: the same row always gets the same value,
on any executor, after any retry, and any SQL engine with ``md5`` can
reproduce it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.functions.colref import col_of as _c
from verdant.functions.numeric import cycle_pick, round_half_away

_TWO_32 = 4294967296.0
NULL_KEY = "\\N"


def hash_u32(salt: str, *keys) -> Column:
    """First 32 bits of md5("salt:key1:key2...") as a non-negative long."""
    # a NULL key part is written \N (the usual NULL text): (NULL, "a"), ("a", NULL) and
    # ("", "a") differ, while a key whose text is \N hashes like NULL
    text = F.concat_ws(":", F.lit(salt), *[F.coalesce(_c(k).cast("string"), F.lit(NULL_KEY)) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_hash(salt: str, *keys) -> Column:
    """Uniform-looking number in [0, 1) from the key."""
    return hash_u32(salt, *keys) / F.lit(_TWO_32)


def impute_between(salt: str, lo: float, hi: float, *keys) -> Column:
    """lo + u * (hi - lo), rounded to 2 decimals."""
    return round_half_away(F.lit(lo) + unit_hash(salt, *keys) * F.lit(hi - lo), 2)


def hash_pick(values: Sequence[str], salt: str, *keys) -> Column:
    """One of ``values`` chosen by the key's hash."""
    return cycle_pick(values, hash_u32(salt, *keys) + 1)

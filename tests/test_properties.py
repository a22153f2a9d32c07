"""Column expressions vs plain-Python models of the row logic, on generated inputs."""

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from verdant.functions.bands import band
from verdant.functions.numeric import first_number, int_prefix, round_half_away
from verdant.plans.panels import TEMPERATURE_BANDS

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_int_prefix(text):
    head = (text or "").split(".")[0]
    if head == "":
        return 1
    try:
        return max(1, int(head))  # int() strips blanks itself and raises on blank-only text
    except ValueError:
        return None  # the upstream producer raises: a reject here


def model_first_number(values):
    for v in values:
        if v is None:
            continue
        try:
            return float(v.replace(",", "."))
        except ValueError:
            continue
    return None


def model_band(v):
    if v is None or math.isnan(v):
        return None
    return "red" if v >= 32 else "yellow" if v >= 28 else "green"


number_text = st.one_of(
    st.integers(-10**6, 10**6).map(str),
    st.decimals(-10**4, 10**4, places=2, allow_nan=False, allow_infinity=False).map(str),
    st.decimals(-10**4, 10**4, places=2, allow_nan=False, allow_infinity=False).map(lambda d: str(d).replace(".", ",")),
)
junk = st.sampled_from(["", "n/a", "x1", "1.234,5", " ", "--", "1e"])
cell = st.one_of(st.none(), number_text, junk)


@SETTINGS
@given(st.lists(cell, min_size=1, max_size=40))
def test_int_prefix_matches_model(spark, texts):
    texts = [t.replace(",", ".") if t else t for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", int_prefix("t").alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == [model_int_prefix(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=40))
def test_first_number_matches_model(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = {r["i"]: r["v"] for r in df.select("i", first_number(["a", "b", "c"]).alias("v")).collect()}
    assert [got[i] for i in range(len(rows))] == [model_first_number(r) for r in rows]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False), st.sampled_from([28.0, 32.0, 27.99])),
                min_size=1, max_size=40))
def test_band_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["b"] for r in df.select("i", band("v", TEMPERATURE_BANDS).alias("b")).collect()}
    assert [got[i] for i in range(len(values))] == [model_band(v) for v in values]


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_round_half_away_is_integer_rounding_of_scaled_value(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())]))
    got = {r["i"]: r["r"] for r in df.select("i", round_half_away("v", 2).alias("r")).collect()}
    for i, v in enumerate(values):
        scaled = Decimal(repr(v * 100.0)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
        assert got[i] == float(scaled) / 100.0

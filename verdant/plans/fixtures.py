"""Source-shaped inputs derived from the provided tables (Spark and SQL twins).

The upstream pipeline reads crop CSV files and weather API responses; the
test tables hold neither, so both are derived here from ``customer`` and
``events`` with fixed rules, once as Spark columns and once as DuckDB SQL,
so every registered query runs on (and grows with) the real tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- crop CSV rows from `customer` (all text, some empty or malformed) ----


def crop_csv_rows(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    nation = F.col("c_nationkey").cast("string")
    bal = F.col("c_acctbal")

    def text(x):
        return x.cast("string")

    return customer.select(
        k,
        F.when(k % 5 == 0, F.concat(nation, F.lit(".0")))
         .when(k % 97 == 0, F.concat(F.lit("x"), nation))
         .otherwise(nation).alias("greenhouse_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
         .when(k % 79 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\t")))
         .otherwise(F.col("c_mktsegment")).alias("crop_type"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(text(bal / 400)).alias("avg_temperature_C"),
        F.when(F.col("c_nationkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(text(F.col("c_nationkey") * 3 + 20)).alias("humidity_percent"),
        F.when(k % 89 == 0, F.lit("n/a")).when(k % 83 == 0, F.lit("  ")).otherwise(text(k % 1000 + 350)).alias("co2_ppm"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(text(bal * 4)).alias("light_intensity_lux"),
        F.when(bal < 0, F.lit(None).cast("string")).otherwise(text(bal / 1000)).alias("irrigation_mm"),
    )


CROP_CSV_SQL = """
SELECT row_number() OVER (ORDER BY c_custkey) AS event_id,
       CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) || '.0'
            WHEN c_custkey % 97 = 0 THEN 'x' || CAST(c_nationkey AS VARCHAR)
            ELSE CAST(c_nationkey AS VARCHAR) END AS greenhouse_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_custkey % 79 = 0 THEN ' ' || c_mktsegment || chr(9)
            ELSE c_mktsegment END AS crop_type,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_acctbal / 400 AS VARCHAR) END AS avg_temperature_C,
       CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey * 3 + 20 AS VARCHAR) END AS humidity_percent,
       CASE WHEN c_custkey % 89 = 0 THEN 'n/a' WHEN c_custkey % 83 = 0 THEN '  ' ELSE CAST(c_custkey % 1000 + 350 AS VARCHAR) END AS co2_ppm,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_acctbal * 4 AS VARCHAR) END AS light_intensity_lux,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal / 1000 AS VARCHAR) END AS irrigation_mm
FROM customer
"""

# ---- weather responses from `events`: 8 consecutive event ids per response ----

RESPONSE_SIZE = 8


def observation_rows(events: DataFrame) -> DataFrame:
    """One loosely typed observation per event (text values, decimal commas, gaps)."""
    et = F.col("event_type")
    v = F.col("value")
    none = F.lit(None).cast("string")
    return events.select(
        F.expr(f"event_id div {RESPONSE_SIZE}").alias("response_id"),
        F.col("event_id").alias("seq"),
        F.format_string("ST%04d", F.col("user_id")).alias("idema"),
        F.when(et == "error", F.lit("n/a")).when(et == "view", none)
         .otherwise(F.replace(v.cast("string"), F.lit("."), F.lit(","))).alias("ta"),
        F.when(et == "view", none).otherwise((v + 1).cast("string")).alias("t"),
        F.when(et == "view", (v * 2).cast("string")).alias("tamax"),
        F.when((et == "error") & (F.col("user_id") % 3 == 0), F.lit("7,25")).alias("tpr"),
        F.when(et == "signup", none).otherwise(F.get_json_object("props", "$.k")).alias("hr"),
        F.when((et == "signup") & (F.col("user_id") % 3 == 0), F.lit("61")).alias("h"),
        F.when((et == "signup") & (F.col("user_id") % 2 == 0), F.lit("50,5")).alias("hrMedia"),
        F.when(et == "purchase", none).otherwise((v / 10).cast("string")).alias("sol"),
        F.when(et == "purchase", F.col("user_id").cast("string")).alias("vis"),
    )


def observation_responses(events: DataFrame) -> DataFrame:
    """(response_id, JSON array text) - the shape of a weather API response.

    Each response gathers at most ``RESPONSE_SIZE`` observations (event ids
    are unique), sorted by sequence number, NULL readings left out.
    """
    obs = observation_rows(events)
    fields = [c for c in obs.columns if c != "response_id"]
    grouped = obs.groupBy("response_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("arr"))
    # every 17th response is an empty list
    return grouped.select("response_id", F.when(F.col("response_id") % 17 == 0, F.lit("[]")).otherwise(F.to_json("arr")).alias("payload"))


OBSERVATION_LAST_SQL = """
SELECT response_id, CASE WHEN response_id % 17 <> 0 THEN struct_pack(idema, ta, t, tamax, tpr, hr, h, hrMedia, sol, vis) END AS o FROM (
  SELECT event_id // 8 AS response_id,
         row_number() OVER (PARTITION BY event_id // 8 ORDER BY event_id DESC) AS rn,
         printf('ST%04d', user_id) AS idema,
         CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN NULL
              ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS ta,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(value + 1 AS VARCHAR) END AS t,
         CASE WHEN event_type = 'view' THEN CAST(value * 2 AS VARCHAR) END AS tamax,
         CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN '7,25' END AS tpr,
         CASE WHEN event_type = 'signup' THEN NULL ELSE json_extract_string(props, '$.k') END AS hr,
         CASE WHEN event_type = 'signup' AND user_id % 3 = 0 THEN '61' END AS h,
         CASE WHEN event_type = 'signup' AND user_id % 2 = 0 THEN '50,5' END AS hrMedia,
         CASE WHEN event_type = 'purchase' THEN NULL ELSE CAST(value / 10 AS VARCHAR) END AS sol,
         CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) END AS vis
  FROM events) WHERE rn = 1
"""
OBSERVATION_LAST_SQL = f"""
SELECT response_id, o IS NULL AS empty, o.idema AS idema, o.ta AS ta, o.t AS t, o.tamax AS tamax, o.tpr AS tpr, o.hr AS hr, o.h AS h,
       o.hrMedia AS hrMedia, o.sol AS sol, o.vis AS vis
FROM ({OBSERVATION_LAST_SQL}) r
"""


def response_greenhouse(response_id_col: str = "response_id"):
    """Configured greenhouse per response: a listed id for even responses, an unknown one otherwise."""
    return F.when(F.col(response_id_col) % 2 == 0, F.lit("alm-nijar")).otherwise(F.lit("alm-unknown"))

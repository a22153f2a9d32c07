"""Every registered query vs its DuckDB twin on a small fixture of edge rows."""

import datetime as dt
import math
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E

T0 = dt.datetime(2024, 1, 29, 10, 0, 0)


def _events():
    rows = []
    types = ["click", "view", "error", "signup", "purchase", None]
    for i in range(240):
        ts = T0 + dt.timedelta(seconds=37 * i, microseconds=(i * 7919) % 1_000_000)
        rows.append(dict(event_id=i, ts=ts, user_id=(i * 13) % 40, event_type=types[i % 6],
                         value=round(0.01 + (i * 3.7) % 900, 2), props=f'{{"k": {i % 97}}}'))
    rows += [
        dict(event_id=1000, ts=None, user_id=1, event_type="click", value=1.0, props='{"k": 1}'),
        dict(event_id=1001, ts=dt.datetime(1969, 12, 31, 23, 59, 59, 999500), user_id=2, event_type="view",
             value=2.0, props='{"k": 2}'),
        dict(event_id=1002, ts=T0, user_id=None, event_type="click", value=None, props='{"k": "x"}'),
        dict(event_id=1003, ts=T0, user_id=3, event_type=None, value=3.0, props=None),
        dict(event_id=1004, ts=T0 + dt.timedelta(hours=3), user_id=4, event_type="purchase", value=None,
             props='{"k": null}'),
        dict(event_id=1005, ts=T0 + dt.timedelta(hours=1), user_id=-5, event_type="view", value=5.5,
             props='{"k": 5}'),
    ]
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
                        ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])
    return pa.Table.from_pylist(rows, schema=schema)


def _customer():
    segs = ["HOUSEHOLD", "BUILDING", None, "MACHINERY"]
    rows = [dict(c_custkey=k, c_name=f"C{k}", c_nationkey=(k * 7) % 25,
                 c_acctbal=round(-999.99 + (k * 37.77) % 11000, 2), c_mktsegment=segs[k % 4]) for k in range(300)]
    rows += [dict(c_custkey=300, c_name="C300", c_nationkey=None, c_acctbal=12.5, c_mktsegment="HOUSEHOLD"),
             dict(c_custkey=301, c_name="C301", c_nationkey=3, c_acctbal=None, c_mktsegment="MACHINERY"),
             dict(c_custkey=302, c_name="C302", c_nationkey=None, c_acctbal=None, c_mktsegment=None)]
    schema = pa.schema([("c_custkey", pa.int64()), ("c_name", pa.string()), ("c_nationkey", pa.int32()),
                        ("c_acctbal", pa.float64()), ("c_mktsegment", pa.string())])
    return pa.Table.from_pylist(rows, schema=schema)


@pytest.fixture(scope="module")
def edge_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    pq.write_table(_events(), os.path.join(d, "events.parquet"))
    pq.write_table(_customer(), os.path.join(d, "customer.parquet"))
    return str(d)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    if isinstance(v, bool):
        return (5, int(v))
    if isinstance(v, int):
        return (2, float(v))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (6, str(v))


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(E.catalog.oracle_sql()))  # the fixture has the telemetry tables
def test_query_matches_sql_twin_on_edge_rows(spark, edge_dir, name):
    df = E.catalog.queries()[name](spark, edge_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_dir}/{t}.parquet')")
    res = con.execute(E.catalog.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())


TIME_SENSITIVE = ["epoch_millis_time", "decode_events", "publish_records", "window_metrics",
                  "stream_window_metrics", "panel_01", "formatted_rows", "batch_millis_window_metrics"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_time_sensitive_queries_on_edge_rows_in_new_york(spark, edge_dir, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query_matches_sql_twin_on_edge_rows(spark, edge_dir, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

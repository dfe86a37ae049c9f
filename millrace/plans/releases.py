"""Queries of snapshots, exports and streams: data is written to the shared folder and read back. Every query reads its tables whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch, to_utc
from millrace.operators import merge
from millrace.plans.market import OHLC_SQL, _t
from millrace.sources import snapshots
from millrace.streaming import bars as streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


LAST_SQL = "SELECT user_id, ts, value, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1"


def _ticks(spark, d):
    return _t(spark, d, "events").select("user_id", "ts", "value", "event_type", "event_id")


@query(LAST_SQL)
def snapshot_scan(spark, d):
    """A snapshot of all ticks, written, checked, published and scanned."""
    root = snapshots.shared_root(spark, "snapshot")
    snapshots.publish_snapshot(spark, root, snapshots.write_snapshot(_ticks(spark, d), root, "user_id", "ts", ["event_id"]), "user_id")
    return snapshots.scan_snapshot(spark, root).select("user_id", "ts", "value", "event_type")


@query(f"WITH l AS ({LAST_SQL}) SELECT * FROM l")
def snapshot_update(spark, d):
    """A snapshot of half the span, brought up to date with the users who have later ticks; equals a snapshot of everything."""
    root, ticks = snapshots.shared_root(spark, "snapshot"), _ticks(spark, d)
    cut = F.lit(dt.datetime(2024, 1, 25)).cast("timestamp_ntz")
    base = snapshots.write_snapshot(ticks.where(F.col("ts") < cut), root, "user_id", "ts", ["event_id"])
    changed = ticks.join(ticks.where(F.col("ts") >= cut).select("user_id").distinct(), "user_id", "left_semi")
    version = snapshots.update_snapshot(spark, root, base, changed, "user_id", "ts", ["event_id"])
    snapshots.publish_snapshot(spark, root, version, "user_id")
    return snapshots.scan_snapshot(spark, root).select("user_id", "ts", "value", "event_type")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def ordered_release(spark, d):
    root = f"{snapshots.shared_root(spark, 'release')}/orders"
    snapshots.write_release(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), root, ["o_orderdate", "o_orderkey"])
    return spark.read.parquet(root)


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def csv_release(spark, d):
    root = snapshots.shared_root(spark, "csv")
    snapshots.release_csv(_t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), root, F.when(F.col("c_name").rlike("^[=+@-]"), "formula"))
    return snapshots.load_seed(spark, root, {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"})


@query("SELECT event_id, user_id, event_type FROM events")
def ndjson_rows(spark, d):
    root = snapshots.shared_root(spark, "ndjson")
    snapshots.write_ndjson(_t(spark, d, "events").select("event_id", "user_id", "event_type"), root)
    return spark.read.schema("event_id BIGINT, user_id BIGINT, event_type STRING").json(root)


@query("SELECT 'customer' AS mart, count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def mart_exports(spark, d):
    counts = snapshots.export_marts({n: _t(spark, d, n) for n in ("customer", "orders")}, snapshots.shared_root(spark, "marts"))
    return spark.createDataFrame(list(counts.items()), "mart string, rows bigint")


@query("""WITH k AS (SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
 SELECT * FROM k WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 900 DAY""")
def candle_copy(spark, d):
    """Candles known by 1999, refreshed from the source since a year before, then kept for 900 days."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    at = lambda year: F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")
    order = [F.desc("o_orderkey")]
    target = merge.merge_replace(o.limit(0), o.where(F.col("o_orderdate") < at(1999)), ["o_custkey", "o_orderdate"], order)
    fresh = merge.merge_replace(target, o.where(F.col("o_orderdate") >= at(1998)), ["o_custkey", "o_orderdate"], order)
    end = _t(spark, d, "orders").agg((F.max("o_orderdate") - F.make_dt_interval(days=F.lit(900))).alias("_end"))
    return fresh.crossJoin(F.broadcast(end)).where(F.col("o_orderdate") >= F.col("_end")).drop("_end")


@query("SELECT event_id, (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc FROM events")
def utc_times(spark, d):
    return _t(spark, d, "events").select("event_id", to_utc(F.col("ts"), "America/New_York").alias("utc"))


def _utc(c):
    """A zone-less time as a timestamp of UTC, whatever the session's zone."""
    micros = F.date_part(F.lit("SECONDS"), c).cast("decimal(8,6)") * 1_000_000 % 1_000_000
    return F.timestamp_micros(floor_epoch(F.col(c), 1) * 1_000_000 + micros.cast("long"))


@query(f"WITH b AS ({OHLC_SQL.format(key='user_id', ts='ts', p='value', t='events', s=3600)}) SELECT user_id, bucket, open_price, high_price, low_price, close_price, observed_points FROM b")
def streamed_bars(spark, d):
    """The ticks written as files and read as a stream; equal to bars of the whole table."""
    root = snapshots.shared_root(spark, "stream")
    ticks = _t(spark, d, "events").select("user_id", _utc("ts").alias("ts"), "value")
    ticks.write.parquet(f"{root}/ticks")
    stream = spark.readStream.schema(ticks.schema).parquet(f"{root}/ticks")
    streams.write_bars(streams.stream_ohlc(stream, ["user_id"], "ts", "value"), f"{root}/bars", f"{root}/progress", ["user_id"]).awaitTermination()
    return streams.read_bars(spark.read.parquet(f"{root}/bars"), ["user_id"])

"""OHLC bars and their roll-ups: one shuffle each, ties broken within the aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators.scans import SEGMENT_ROWS, next_seen, scan


def ohlc(df: DataFrame, key: list[str], ts: str, price: str, seconds: int, *extra: Column) -> DataFrame:
    """Bars of `seconds` by key: open is the first by (time, price), close the last; ticks without time or price are dropped. extra: more aggregates."""
    ticks = df.where(F.col(ts).isNotNull() & F.col(price).isNotNull()).withColumn("bucket", floor_epoch(F.col(ts), seconds))
    order = F.struct(ts, price)
    return ticks.groupBy(*key, "bucket").agg(
        F.min_by(price, order).alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"), F.max_by(price, order).alias("close_price"),
        F.round(F.avg(price), 8).alias("avg_price"), F.count("*").alias("observed_points"), F.min(ts).alias("first_observed_at"), F.max(ts).alias("last_observed_at"), *extra,
    )


def fill_bars(df: DataFrame, key: list[str], order: list[str], price: str, shares: str, collateral: str) -> DataFrame:
    """Bars of fills in chain order, with exact decimal volumes."""
    at = F.struct(*order)
    return df.groupBy(*key).agg(
        F.min_by(price, at).alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"), F.max_by(price, at).alias("close_price"),
        F.sum(F.col(shares).cast("decimal(18,6)")).alias("share_volume"), F.sum(F.col(collateral).cast("decimal(18,6)")).alias("collateral_volume"), F.count("*").alias("fills"),
    )


def latest_value(df: DataFrame, key: list[str], value: str, ts: str) -> DataFrame:
    """The last value that is not null of each key, ties to the larger value."""
    return df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.max_by(value, F.struct(ts, value)).alias("latest_value"), F.max(ts).alias("latest_at"))


def rollup(bars: DataFrame, key: list[str], seconds: int) -> DataFrame:
    """Coarser bars from finer ones, without the ticks."""
    up = bars.withColumn("_coarse", F.floor(F.col("bucket") / seconds).cast("long") * seconds)
    return up.groupBy(*key, F.col("_coarse").alias("coarse_bucket")).agg(
        F.min_by("open_price", "bucket").alias("open_price"), F.max("high_price").alias("high_price"), F.min("low_price").alias("low_price"),
        F.max_by("close_price", "bucket").alias("close_price"), F.sum("observed_points").alias("observed_points"),
    )


def dense(bars: DataFrame, key: list[str], seconds: int, rows: int = SEGMENT_ROWS) -> DataFrame:
    """A bar for each bucket from a key's first to its last; empty ones carry the last close (is_observed false).

    A scan over the observed bars gives each its successor, and only the gap is exploded: no join with a spine.
    """
    ahead = scan(bars, key, ["bucket"], {"_next": next_seen(F.col("bucket"), own=False)}, rows)
    spread = ahead.withColumn("_next", F.coalesce("_next", F.col("bucket") + seconds)).withColumn("_at", F.explode(F.sequence(F.col("bucket"), F.col("_next") - seconds, F.lit(seconds).cast("long"))))
    seen = F.col("_at") == F.col("bucket")
    price = lambda c: F.when(seen, F.col(c)).otherwise(F.col("close_price")).alias(c)
    return spread.select(*key, F.col("_at").alias("bucket"), price("open_price"), price("high_price"), price("low_price"), "close_price", seen.alias("is_observed"), F.when(seen, F.col("observed_points")).otherwise(0).cast("long").alias("observed_points"))


def dirty_rebuild(target: DataFrame, ticks: DataFrame, dirty: DataFrame, key: list[str], ts: str, price: str, seconds: int) -> DataFrame:
    """target with the bars of dirty (key, bucket) pairs rebuilt whole from ticks; equals a full rebuild if dirty covers all changes."""
    on = [*key, "bucket"]
    touched = ticks.withColumn("bucket", floor_epoch(F.col(ts), seconds)).join(dirty.select(*on).distinct(), on, "left_semi").drop("bucket")
    fresh = ohlc(touched, key, ts, price, seconds)
    return target.join(dirty.select(*on).distinct(), on, "left_anti").unionByName(fresh)


def incremental_ohlc(target: DataFrame, ticks: DataFrame, key: list[str], ts: str, price: str, ingested: str, seconds: int, lag_s: int) -> DataFrame:
    """target with the bars rebuilt whole that hold a tick without ingestion time, or one ingested since the target's latest less lag_s.

    target holds latest_ingested_at; the one row of its maximum is broadcast.
    """
    known = target.agg(F.coalesce(floor_epoch(F.max("latest_ingested_at"), 1), F.lit(0)).alias("_since"))
    late = ticks.where(F.col(ts).isNotNull() & F.col(price).isNotNull()).crossJoin(F.broadcast(known)).where(F.col(ingested).isNull() | (floor_epoch(F.col(ingested), 1) >= F.col("_since") - lag_s))
    dirty = late.select(*key, floor_epoch(F.col(ts), seconds).alias("bucket")).distinct()
    touched = ticks.withColumn("bucket", floor_epoch(F.col(ts), seconds)).join(dirty, [*key, "bucket"], "left_semi").drop("bucket")
    fresh = ohlc(touched, key, ts, price, seconds, F.max(ingested).alias("latest_ingested_at"))
    return target.join(dirty, [*key, "bucket"], "left_anti").unionByName(fresh)


def ohlc_release(df: DataFrame, key: list[str], ts: str, price: str, seconds: int) -> DataFrame:
    """Bars with close_age_seconds: how old the close is when its bucket ends."""
    out = ohlc(df, key, ts, price, seconds)
    return out.withColumn("close_age_seconds", F.col("bucket") + seconds - floor_epoch(F.col("last_observed_at"), 1))


def progression_side(df: DataFrame, inverted: Column) -> DataFrame:
    """Bars of the side that goes on: where inverted holds, p becomes 1 - p and high and low change places."""
    turn = lambda c, other: F.when(inverted, 1 - F.col(other)).otherwise(F.col(c)).alias(c)
    sides = {"open_price": "open_price", "high_price": "low_price", "low_price": "high_price", "close_price": "close_price", "avg_price": "avg_price"}
    return df.select(*(turn(c, sides[c]) if c in sides else F.col(c) for c in df.columns))


def minute_spine(df: DataFrame, lo: str, hi: str, seconds: int = 60) -> DataFrame:
    """df with a row for each bucket from that of lo to that of hi, both included."""
    step = F.lit(seconds).cast("long")
    return df.withColumn("bucket", F.explode(F.sequence(floor_epoch(F.col(lo), seconds), floor_epoch(F.col(hi), seconds), step)))


def minute_status(complete: Column, bucket: Column, lo: Column, hi: Column, seconds: int = 60) -> Column:
    """complete, or at which end of [lo, hi] an incomplete bucket lies."""
    first, last = bucket == floor_epoch(lo, seconds), bucket == floor_epoch(hi, seconds)
    return F.when(complete, "complete").when(first & last, "start_and_finish_boundary_incomplete").when(first, "start_boundary_incomplete").when(last, "finish_boundary_incomplete").otherwise("interior_incomplete")


def pair_deviation(yes: Column, no: Column) -> Column:
    return F.abs(yes + no - 1)


def filtered(agg: str, cond: Column, c: str) -> Column:
    """A filtered aggregate: sum, max, avg or count of c where cond holds."""
    return getattr(F, agg)(F.when(cond, F.col(c)))

"""Joins and distinct rows of streams. State is bounded by watermarks: a row waits for its partners no longer than they may come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_interval_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, before_s: int, after_s: int = 0, late: str = "1 hour", how: str = "inner") -> DataFrame:
    """Rows of both streams with equal keys, the right one at most before_s before the left one and at most after_s after it, both ends included.

    The columns of left, then those of right but its keys; other columns of both must have different names. Rows later than the watermark are
    dropped. how: inner, or left_outer: a left row without a partner comes out once none can come any more. Null keys match nothing.
    """
    l, r = left.withWatermark(left_ts, late), right.withWatermark(right_ts, late).withColumnsRenamed({k: f"_r_{k}" for k in by})
    span = lambda s: F.expr(f"INTERVAL {s} SECONDS")
    on = (F.col(right_ts) >= F.col(left_ts) - span(before_s)) & (F.col(right_ts) <= F.col(left_ts) + span(after_s))
    for k in by:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return l.join(r, on, how).drop(*(f"_r_{k}" for k in by))


def stream_distinct(df: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """The first row to arrive of each key; copies are known for as long as the watermark lets them come, then forgotten."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)

"""Streams of ticks as bars. State is one bar for each (key, bucket) that the watermark has not passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.merge import merge_replace


def stream_ohlc(ticks: DataFrame, key: list[str], ts: str, price: str, bucket: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Bars of a stream as in bars.ohlc; ticks later than the watermark are dropped. ts is a timestamp with a zone, as watermarks need."""
    order = F.struct(ts, price)
    timely = ticks.where(F.col(ts).isNotNull() & F.col(price).isNotNull()).withWatermark(ts, late)
    return timely.groupBy(*key, F.window(ts, bucket).alias("_w")).agg(
        F.min_by(price, order).alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"), F.max_by(price, order).alias("close_price"), F.count("*").alias("observed_points")
    ).select(*key, F.unix_seconds("_w.start").alias("bucket"), "open_price", "high_price", "low_price", "close_price", "observed_points")


def write_bars(bars: DataFrame, root: str, checkpoint: str, key: list[str], available_now: bool = True) -> StreamingQuery:
    """Writes each batch's changed bars as root/batch=N, so a batch that is run again replaces its own folder only. read_bars merges them."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={n}")

    writer = bars.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_bars(df: DataFrame, key: list[str]) -> DataFrame:
    """The last state of each bar among the batches: df as read from root, with batch."""
    return merge_replace(df.limit(0), df, [*key, "bucket"], [F.desc("batch")]).drop("batch")

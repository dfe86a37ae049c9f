"""Window operators: latest rows, carry-forward, gaps, ranks and intervals. None uses a window without partition keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds
from millrace.operators.scans import SEGMENT_ROWS, Scan, large_keys, last_seen, next_seen, scan


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def locf(df: DataFrame, key: list[str], order: list[str], cols: list[str], rows: int = SEGMENT_ROWS) -> DataFrame:
    return scan(df, key, order, {c: last_seen(F.col(c)) for c in cols}, rows)


def max_gap(df: DataFrame, key: list[str], order: list[str], flag: Column, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Longest run of rows after an observed one that are not observed."""
    runs = scan(df.withColumn("_seen", flag), key, order, {"_run": Scan("sum", F.col("_seen").cast("int"))}, rows)
    return runs.where("NOT _seen").groupBy(*key, "_run").count().groupBy(*key).agg(F.max("count").alias("longest_gap"))


def with_gap(df: DataFrame, key: list[str], ts: str, ties: list[str], rows: int = SEGMENT_ROWS) -> DataFrame:
    """df with gap_seconds, the whole seconds since a key's row before; null at the first and beside a null time."""
    before = scan(df, key, [ts, *ties], {"_before": last_seen(F.struct(F.col(ts).alias("at")), own=False)}, rows)
    return before.withColumn("gap_seconds", epoch_seconds(F.col(ts)) - epoch_seconds(F.col("_before.at"))).drop("_before")


def sequence_by(df: DataFrame, key: list[str], order: list[str], rows: int = SEGMENT_ROWS) -> DataFrame:
    counted = scan(df, key, order, {"event_sequence": Scan("sum", F.lit(1))}, rows)
    return counted.withColumn("event_sequence", (F.col("event_sequence") - 1).cast("long"))


def rank_levels(df: DataFrame, book: list[str], side: str, price: str, ordinal: list[str]) -> DataFrame:
    """Level ranks: bids by falling price, asks by rising price, null prices last, then the source order."""
    by = F.when(F.col(side) == "bid", -F.col(price)).otherwise(F.col(price)).asc_nulls_last()
    return df.withColumn("level_rank", F.row_number().over(Window.partitionBy(*book, side).orderBy(by, *ordinal)).cast("long"))


def best_quotes(df: DataFrame, book: list[str], side: str, price: str) -> DataFrame:
    w = Window.partitionBy(*book)
    out = df.withColumn("best_bid", F.max(F.when(F.col(side) == "bid", F.col(price))).over(w)).withColumn("best_ask", F.min(F.when(F.col(side) == "ask", F.col(price))).over(w))
    return out.withColumn("spread", F.col("best_ask") - F.col("best_bid")).withColumn("midpoint", (F.col("best_bid") + F.col("best_ask")) / 2)


def cumulative_depth(df: DataFrame, book: list[str], side: str, rank: str, size: str) -> DataFrame:
    w = Window.partitionBy(*book, side).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative_size", F.sum(size).over(w))


def cumulative_notional(df: DataFrame, book: list[str], side: str, rank: str, price: str, size: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """df with notional (price times size, exact to 18 digits), cumulative_size and cumulative_notional by rank; large books are scanned in segments."""
    exact = F.col(price).cast("decimal(20,18)") * F.col(size).cast("decimal(17,6)")
    priced = df.withColumn("notional", exact.cast("decimal(28,18)"))
    sizes = F.col(size).cast("decimal(18,6)")
    return scan(priced, [*book, side], [rank], {"cumulative_size": Scan("sum", sizes), "cumulative_notional": Scan("sum", F.col("notional"))}, rows)


def merge_intervals(df: DataFrame, key: list[str], lo: str, hi: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Overlapping or touching [lo, hi] intervals of a key as one, with how many each holds."""
    each, large = df.withColumn("_members", F.lit(1)), large_keys(df, key, rows)
    if large is not None:
        # equal intervals join each other: one row of each is ordered. Those that don't, with a null or hi before lo, stay apart
        apart = F.when(F.col(lo) <= F.col(hi), F.lit(None)).otherwise(F.monotonically_increasing_id())
        each = df.withColumn("_apart", apart).groupBy(*key, lo, hi, "_apart").agg(F.count("*").alias("_members")).drop("_apart")
        large = large_keys(each, key, rows)
    reach = scan(each, key, [lo, hi], {"_before": Scan("max", F.col(hi), own=False)}, rows, large)
    # of equal intervals the one that begins a group comes first in the second scan too
    joins = reach.withColumn("_joins", F.when(F.col(lo) <= F.col("_before"), 1).otherwise(0))
    marked = scan(joins, key, [lo, hi, "_joins"], {"_group": Scan("sum", 1 - F.col("_joins"))}, rows, large)
    return marked.groupBy(*key, "_group").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.sum("_members").alias("members")).drop("_group")


def interval_gaps(merged: DataFrame, key: list[str], rows: int = SEGMENT_ROWS) -> DataFrame:
    """What lies between consecutive merged intervals of a key."""
    ahead = scan(merged, key, ["lo"], {"gap_hi": next_seen(F.col("lo"), own=False)}, rows)
    return ahead.select(*key, F.col("hi").alias("gap_lo"), "gap_hi").where("gap_hi IS NOT NULL AND gap_hi > gap_lo")


def zscore(df: DataFrame, c: str) -> DataFrame:
    """(x - mean) / population deviation over the table; null where the deviation is zero. One row is broadcast."""
    one = df.agg(F.avg(c).alias("_mean"), F.stddev_pop(c).alias("_sd"))
    return df.crossJoin(F.broadcast(one)).withColumn("zscore", (F.col(c) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))).drop("_mean", "_sd")


def rolling_sum(df: DataFrame, key: list[str], ts: str, value: str, seconds: int) -> DataFrame:
    """Sum over (t - seconds, t], by whole seconds."""
    w = Window.partitionBy(*key).orderBy(epoch_seconds(F.col(ts))).rangeBetween(-(seconds - 1), 0)
    return df.withColumn("rolling_sum", F.sum(value).over(w))

"""Joins that Spark has no word for: as-of, tolerance, priority and window joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds, floor_epoch, name_key
from millrace.operators.scans import SEGMENT_ROWS, last_seen, next_seen, scan


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, value: str, strict: bool = False, forward: bool = False, rows: int = SEGMENT_ROWS) -> DataFrame:
    """left with the value of the last right row at (strict: before) its time, as asof_value and asof_at; forward: of the first right row at
    (strict: after) its time. A left row without a time has no match going back; right rows without a time match nothing.

    Both sides are stacked and one ordered scan carries the nearest right row: no range join, no row is multiplied, and a key of
    more than rows rows is spread over segments. Among right rows of one time the largest value counts.
    """
    right_side = int(strict != forward)
    r = right.where(F.col(right_ts).isNotNull()).groupBy(*by, F.col(right_ts).alias("_ts")).agg(F.max(value).alias("_v")).withColumn("_side", F.lit(right_side)).withColumn("_row", F.lit(None).cast(left.withColumn("_s", F.struct("*")).schema["_s"].dataType))
    l = left.select(*by, F.col(left_ts).alias("_ts"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1 - right_side).alias("_side"), F.struct("*").alias("_row"))
    seen = F.when(F.col("_row").isNull(), F.struct("_v", "_ts"))
    stacked = scan(l.unionByName(r), by, ["_ts", "_side"], {"_near": next_seen(seen) if forward else last_seen(seen)}, rows)
    return stacked.where("_row IS NOT NULL").select("_row.*", F.col("_near._v").alias("asof_value"), F.col("_near._ts").alias("asof_at"))


def checkpoint_prices(points: DataFrame, series: DataFrame, by: list[str], sequence: str, ts: str, value: str) -> DataFrame:
    """The price of each checkpoint: the last one at or before the first checkpoint (sequence 0), the first one after each other."""
    before = asof_join(points.where(F.col(sequence) == 0), series, by, ts, ts, value)
    return before.unionByName(asof_join(points.where(F.col(sequence) > 0), series, by, ts, ts, value, strict=True, forward=True))


def reactions(events: DataFrame, series: DataFrame, by: list[str], ts: str, value: str, spans: dict[str, int]) -> DataFrame:
    """events with before_<name> and after_<name> for each span of seconds: the last price before and the first one at or after an event,
    null where it lies further away than the span."""
    out = asof_join(events, series, by, ts, ts, value, strict=True).withColumnsRenamed({"asof_value": "_before", "asof_at": "_before_at"})
    out = asof_join(out, series, by, ts, ts, value, forward=True).withColumnsRenamed({"asof_value": "_after", "asof_at": "_after_at"})
    at = lambda c: floor_epoch(F.col(c), 1)
    cols = {}
    for name, seconds in spans.items():
        cols[f"before_{name}"] = F.when(at(ts) - at("_before_at") <= seconds, F.col("_before"))
        cols[f"after_{name}"] = F.when(at("_after_at") - at(ts) <= seconds, F.col("_after"))
    return out.withColumns(cols).drop("_before", "_before_at", "_after", "_after_at")


def join_priority(left: DataFrame, right: DataFrame, left_keys: list[str], right_key: str) -> DataFrame:
    """left join on the first key of left_keys that is not null."""
    return left.withColumn(right_key, F.coalesce(*left_keys)).join(right, right_key, "left")


def oriented_match(a: DataFrame, b: DataFrame, a_pair: tuple[str, str], b_pair: tuple[str, str], b_scores: tuple[str, str]) -> DataFrame:
    """a with home_score and away_score of the b row of the same two sides, swapped where b names them the other way round. b holds a row at
    most for each ordered pair; where both orders are there, each gives a row."""
    unordered = lambda df, pair: df.withColumns({"_p": F.least(*pair), "_q": F.greatest(*pair)})
    rows = unordered(a, a_pair).join(unordered(b, b_pair).select("_p", "_q", F.col(b_pair[0]).alias("_home"), *(F.col(c).alias(f"_s{i}") for i, c in enumerate(b_scores))), ["_p", "_q"])
    swapped = F.col("_home") != F.col(a_pair[0])
    return rows.withColumns({"swapped": swapped, "home_score": F.when(swapped, F.col("_s1")).otherwise(F.col("_s0")), "away_score": F.when(swapped, F.col("_s0")).otherwise(F.col("_s1"))}).drop("_p", "_q", "_home", "_s0", "_s1")


def prefer(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """primary, and fallback rows of keys that it lacks."""
    return primary.unionByName(fallback.join(primary.select(*keys).distinct(), keys, "left_anti"))


def outer_merge(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "full")


def pair_match(a: DataFrame, b: DataFrame, a_pair: tuple[str, str], b_pair: tuple[str, str], a_ts: str, b_ts: str, tolerance_s: int) -> DataFrame:
    """Rows whose unordered pairs are equal and whose times differ by the tolerance at most, and how many matches an a row has."""
    key = lambda p: (F.least(*p), F.greatest(*p))
    x, y = a.withColumns(dict(zip(("_p", "_q"), key(a_pair), strict=True))), b.withColumns(dict(zip(("_p", "_q"), key(b_pair), strict=True)))
    x = x.withColumn("_row", F.struct(F.spark_partition_id(), F.monotonically_increasing_id()))
    close = F.abs(floor_epoch(F.col(a_ts), 1) - floor_epoch(F.col(b_ts), 1)) <= tolerance_s
    return x.join(y, ["_p", "_q"]).where(close).withColumn("match_count", F.count("*").over(Window.partitionBy("_row"))).drop("_p", "_q", "_row")


def point_in_window(points: DataFrame, windows: DataFrame, by: list[str], ts: str, lo: str, hi: str, bucket_s: int = 86_400) -> DataFrame:
    """Points within [lo, hi] windows of their key. Windows are dealt to the buckets that they touch, so a key with many rows is many groups."""
    sec = lambda c: F.floor(epoch_seconds(F.col(c)) / bucket_s)
    w = windows.withColumn("_bucket", F.explode(F.sequence(sec(lo), sec(hi))))
    return points.withColumn("_bucket", sec(ts)).join(w, [*by, "_bucket"]).where(F.col(ts).between(F.col(lo), F.col(hi))).drop("_bucket")


def null_safe_diff(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys of both tables whose values differ, nulls being equal to nulls."""
    x, y = a.alias("x"), b.alias("y")
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]
    differs = ~F.struct(*(F.col(f"x.{v}") for v in values)).eqNullSafe(F.struct(*(F.col(f"y.{v}") for v in values)))
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return x.join(y, cond).where(differs).select(*(F.col(f"x.{k}").alias(k) for k in keys))


def divergent_keys(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose rows do not all hold the same values: an aggregate, not a self join."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*values)).alias("versions")).where("versions > 1")


def canonical(df: DataFrame, c: str, aliases: DataFrame, variant: str, canonical_col: str) -> DataFrame:
    """df with canonical: the canonical name of the alias whose match key equals that of c, else c as it stands. Of several canonical
    names of one key the least counts; texts without a letter or digit have no key."""
    one = aliases.groupBy(name_key(F.col(variant)).alias("_key")).agg(F.min(canonical_col).alias("_canonical")).where("_key != ''")
    return df.withColumn("_key", name_key(F.col(c))).join(one, "_key", "left").withColumn("canonical", F.coalesce("_canonical", c)).drop("_canonical", "_key")

"""Market rules: scope, status ladders, evidence, alerts, coverage and text checks. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch, issue_list, safe_ratio
from millrace.operators.merge import table_diff

#: What may not stand in published text (fixed patterns).
FORBIDDEN = {
    "control": "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]",
    "formula": "^[=+@-]",
    "hash": "[0-9a-f]{40}",
    "url": "https?://",
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
}


def in_scope(slug: Column, tags: Column, slugs: list[str], prefixes: list[str], wanted: list[str]) -> Column:
    """Whether a slug is listed, begins with a prefix, or a tag is wanted; null counts as no."""
    found = slug.isin(slugs) | F.arrays_overlap(tags, F.array(*map(F.lit, wanted)))
    for p in prefixes:
        found = found | slug.startswith(p)
    return F.coalesce(found, F.lit(False))


def tag_allowed(tag: Column, allow: list[str], deny: list[str], keyword: str) -> Column:
    """deny beats allow, allow beats the keyword pattern."""
    return F.coalesce(F.when(tag.isin(deny), False).when(tag.isin(allow), True).otherwise(tag.rlike(keyword)), F.lit(False))


def volume_between(volume: Column, lo: float | None = None, hi: float | None = None) -> Column:
    v, out = F.coalesce(volume, F.lit(0)), F.lit(True)
    out = out & (v >= lo) if lo is not None else out
    return out & (v < hi) if hi is not None else out


def not_ended(end: Column, as_of: Column, days: int) -> Column:
    return F.coalesce(floor_epoch(end, 1) >= floor_epoch(as_of, 1) - days * 86_400, F.lit(True))


def price_status(status: Column, price: Column, age_hours: Column, fresh_hours: int) -> Column:
    return (
        F.when(status == "resolved", "historical_resolved").when(status == "closed", "historical_closed").when(status == "inactive", "inactive")
        .when((status == "live") & price.isNull(), "missing_live").when((status == "live") & (age_hours <= fresh_hours), "fresh_live").when(status == "live", "stale_live")
    )


def numeric_ids(df: DataFrame, c: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is digits only, and the rest (nulls too)."""
    good = F.coalesce(F.col(c).rlike("^[0-9]+$"), F.lit(False))
    return df.where(good), df.where(~good)


def tradability(**tests: Column) -> Column:
    """The names of the tests that hold, sorted."""
    return F.sort_array(F.array_compact(F.array(*(F.when(t, F.lit(n)) for n, t in tests.items()))))


def content_text(**fields: Column) -> Column:
    """'label: value' lines of the fields that hold more than blanks."""
    return F.concat_ws("\n", *(F.when(F.trim(v) != "", F.concat(F.lit(f"{n}: "), F.trim(v))) for n, v in fields.items()))


def forbidden_text(c: Column) -> Column:
    """Comma-joined names of the FORBIDDEN patterns that a text holds; null if none."""
    return issue_list(*((name, c.rlike(p)) for name, p in FORBIDDEN.items()))


def alerts(runs: DataFrame, by: str, order: str, metric: str, drop: float, jump: float) -> DataFrame:
    """(by, alert, severity, first_seen, last_seen, times): runs whose metric fell below drop or rose above jump times the one before."""
    before = F.lag(metric).over(Window.partitionBy(by).orderBy(order))
    kind = F.when(F.col(metric) < before * drop, "drop").when(F.col(metric) > before * jump, "jump")
    marked = runs.withColumn("alert", kind).where("alert IS NOT NULL")
    severity = F.when(F.col("alert") == "drop", "error").otherwise("warn").alias("severity")
    return marked.groupBy(by, "alert", severity).agg(F.min(order).alias("first_seen"), F.max(order).alias("last_seen"), F.count("*").alias("times"))


def health(alerts: DataFrame, by: str) -> DataFrame:
    """(by, errors, warnings, state)."""
    out = alerts.groupBy(by).agg(F.sum(F.when(F.col("severity") == "error", F.col("times")).otherwise(0)).alias("errors"), F.sum(F.when(F.col("severity") == "warn", F.col("times")).otherwise(0)).alias("warnings"))
    return out.withColumn("state", F.when(F.col("errors") > 0, "failing").when(F.col("warnings") > 0, "degraded").otherwise("healthy"))


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows each table has, how many are only in one (with multiplicity), and whether they are equal."""
    diff = table_diff(a, b).agg(F.coalesce(F.sum(F.when(F.col("excess") > 0, F.col("excess"))), F.lit(0)).alias("only_first"), F.coalesce(F.sum(F.when(F.col("excess") < 0, -F.col("excess"))), F.lit(0)).alias("only_second"))
    counts = a.agg(F.count("*").alias("first_rows")).crossJoin(b.agg(F.count("*").alias("second_rows")))
    return counts.crossJoin(diff).withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def token_coverage(df: DataFrame, key: str, ts: str, price: str, lo: Column, hi: Column, seconds: int) -> DataFrame:
    """Of each key: observed and expected buckets of [lo, hi], their ratio, the largest gap, the offsets at both ends, and whether the price never moved."""
    inside = df.where(F.col(ts).between(lo, hi)).groupBy(key, floor_epoch(F.col(ts), seconds).alias("_b")).agg(F.min(price).alias("_lo"), F.max(price).alias("_hi"))
    gaps = inside.withColumn("_gap", F.col("_b") - F.lag("_b").over(Window.partitionBy(key).orderBy("_b")))
    first, last = floor_epoch(lo, seconds), floor_epoch(hi, seconds)
    out = gaps.groupBy(key).agg(
        F.count("*").alias("observed"), F.max("_gap").alias("largest_gap"), (F.min("_b") - first).alias("start_offset"), (last - F.max("_b")).alias("finish_offset"), (F.min("_lo") == F.max("_hi")).alias("constant_price")
    )
    expected = ((last - first) / seconds + 1).cast("long")
    return out.withColumn("expected", expected).withColumn("ratio", F.round(safe_ratio(F.col("observed"), F.col("expected")), 8))


def profile_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, rows, nulls, mean, deviation, shortest, longest) of each column in one pass; mean and deviation of columns that are numbers."""
    numbers = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte") or f.dataType.typeName().startswith("decimal")}
    value = lambda c: F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
    size = lambda c: F.length(F.col(c).cast("string")).cast("long")
    aggs = [e for c in cols for e in (F.count_if(F.col(c).isNull()).alias(f"{c}__n"), F.round(F.avg(value(c)), 6).alias(f"{c}__m"), F.round(F.stddev_samp(value(c)), 6).alias(f"{c}__d"), F.min(size(c)).alias(f"{c}__s"), F.max(size(c)).alias(f"{c}__l"))]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    each = (F.struct(F.lit(c).alias("column_name"), *(F.col(f"{c}__{k}").alias(n) for k, n in zip("nmdsl", ("nulls", "mean", "deviation", "shortest", "longest"), strict=True))) for c in cols)
    return one.select("rows", F.explode(F.array(*each)).alias("_s")).select("rows", "_s.*")


def exact_percentiles(df: DataFrame, by: str, value: str, shares: list[float], bins: int = 1024) -> DataFrame:
    """(by, share, percentile): linear interpolation between the two order statistics around each rank; nulls are left out.

    Values are counted first. Bins of equal width between a group's ends hold these counts; only the counts of bins meet in a group's
    window, and only bins that hold a wanted rank are opened, so no task sees a group whole.
    """
    seen = df.where(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    ends = seen.groupBy(by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_all"))
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    binned = seen.join(ends, by).withColumn("_bin", F.coalesce(F.least(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(bins - 1)), F.lit(0)).cast("int"))
    running = Window.partitionBy(by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    totals = binned.groupBy(by, "_bin", "_all").agg(F.sum("_n").alias("_in")).withColumn("_before", F.sum("_in").over(running) - F.col("_in"))
    share = F.explode(F.array(*map(F.lit, shares)))
    ranks = totals.select("*", share.alias("share")).withColumn("_at", (F.col("_all") - 1) * F.col("share"))
    ranks = ranks.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at"))))).where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in")))
    opened = binned.select(by, "_bin", "_v", "_n").join(ranks.select(by, "_bin").distinct(), [by, "_bin"], "left_semi")
    inside = opened.withColumn("_to", F.sum("_n").over(Window.partitionBy(by, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    held = ranks.join(inside, [by, "_bin"]).where((F.col("_rank") - F.col("_before") < F.col("_to")) & (F.col("_rank") - F.col("_before") >= F.col("_to") - F.col("_n")))
    part = F.max("_at") - F.min("_rank")
    return held.groupBy(by, "share").agg((F.min("_v") + (F.max("_v") - F.min("_v")) * part).alias("percentile"))

"""Registries of markets and tokens: which token leads, what is eligible, what changed, what is covered."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch, safe_ratio
from millrace.operators.scans import last_seen, scan
from millrace.operators.windows import latest


def primary_token(tokens: DataFrame, market: str, token: str, is_yes: Column, index: Column) -> DataFrame:
    """One token of each market: a Yes token where there is one, else that of the lowest index; ties by id."""
    return latest(tokens, [market], [is_yes.desc_nulls_last(), index.asc_nulls_last(), F.col(token).asc()])


def latest_run(runs: DataFrame, order: list[Column]) -> DataFrame:
    """The last run of all: a bounded top-1, not a window over the table."""
    return runs.orderBy(*order).limit(1)


def latest_group(df: DataFrame, group: str) -> DataFrame:
    """All rows of the largest group value; the one-row maximum is broadcast."""
    return df.join(F.broadcast(df.agg(F.max(group).alias("_top"))), F.col(group) == F.col("_top")).drop("_top")


def with_previous(df: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """df with previous_<c> of each metric from the row before in its group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({f"previous_{c}": F.lag(c).over(w) for c in cols})


def interval_breaks(df: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """Intervals that do not start right after the one before in their group."""
    before = F.lag(hi).over(Window.partitionBy(*by).orderBy(lo, hi))
    return df.withColumn("previous_hi", before).where(F.col("previous_hi") + 1 != F.col(lo))


def sticky_eligibility(before: DataFrame, now: DataFrame, key: str, value: str, ts: str, floor: float) -> DataFrame:
    """(key, eligible, eligible_since): a key that ever met the floor stays eligible, with its first time."""
    met = lambda df: df.groupBy(key).agg(F.bool_or(F.col(value) >= floor).alias("met"), F.min(F.when(F.col(value) >= floor, F.col(ts))).alias("since"))
    return met(before).unionByName(met(now)).groupBy(key).agg(F.coalesce(F.bool_or("met"), F.lit(False)).alias("eligible"), F.min("since").alias("eligible_since"))


def merge_states(df: DataFrame, key: str, cursor: str, order: list[str], state: str, flag: Column) -> DataFrame:
    """Of each key the largest cursor, the state of its last row, and whether any row has the flag."""
    return df.groupBy(key).agg(F.max(cursor).alias("cursor"), F.max_by(state, F.struct(*order)).alias("state"), F.coalesce(F.bool_or(flag), F.lit(False)).alias("flagged"))


def rebuild_dirty(target: DataFrame, fresh: DataFrame, key: str, revision: str) -> DataFrame:
    """target with the rows of every key whose revision in fresh is another one replaced, new keys added, and keys that fresh lacks removed."""
    now, was = fresh.select(key, F.col(revision).alias("_now")).distinct(), target.select(key, F.col(revision).alias("_was")).distinct()
    same = now.join(was, key).where("_now <=> _was").select(key)
    return target.join(same, key, "left_semi").unionByName(fresh.join(same, key, "left_anti"))


def hash_sample(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """All rows of the ceil(n * share) keys of the lowest sha256(seed:key); null keys are no keys. Keys are counted in 65,536 buckets of their hash, and only
    the bucket that the cut goes through is ordered, so no task sees more than a sliver of the keys."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    hashed = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", digest).withColumn("_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    counts = sorted((r["_b"], r["count"]) for r in hashed.groupBy("_b").count().collect())
    left, cut = math.ceil(sum(n for _, n in counts) * share), 1 << 16
    for b, n in counts:
        if n > left:
            cut = b
            break
        left -= n
    part = hashed.where(F.col("_b") == cut).orderBy("_h", key).limit(left).select(key)
    return df.join(hashed.where(F.col("_b") < cut).select(key).unionByName(part), key, "left_semi")


def purge_ids(frames: dict[str, DataFrame], denied: DataFrame, key: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The frames without rows of denied ids, and (frame, rows_before, rows_after)."""
    kept = {name: df.join(denied.select(key).distinct(), key, "left_anti") for name, df in frames.items()}
    count = lambda df, name, c: df.agg(F.count("*").alias(c)).select(F.lit(name).alias("frame"), c)
    counts = [count(df, name, "rows_before").join(count(kept[name], name, "rows_after"), "frame") for name, df in frames.items()]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return kept, total


def step_metrics(df: DataFrame, by: list[str], step: str, steps: list[str], value: Column) -> DataFrame:
    """A column for each step with the largest value that a group has there."""
    return df.groupBy(*by).agg(*(F.max(F.when(F.col(step) == s, value)).alias(f"{s}_metric") for s in steps))


def coverage(df: DataFrame, key: str, bucket: Column, expected: int) -> DataFrame:
    """(key, observed, expected, ratio) of distinct buckets."""
    out = df.groupBy(key).agg(F.count_distinct(bucket).alias("observed"))
    return out.withColumn("expected", F.lit(expected).cast("long")).withColumn("ratio", F.round(safe_ratio(F.col("observed"), F.col("expected")), 8))


def layer_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(layer, n_rows) of each frame."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows") for name, df in frames.items()]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def opening_rank(df: DataFrame, by: str, team: str, order: list[str], price: str, n: int) -> DataFrame:
    """Of each group the n teams of the highest opening price, ranked; ties by team. A team's opening price is that of its first row."""
    opening = df.groupBy(by, team).agg(F.min_by(price, F.struct(*order)).alias("opening_price"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("opening_price"), team))
    return opening.withColumn("opening_rank", rank.cast("long")).where(F.col("opening_rank") <= n)


def two_sided(spine: DataFrame, yes: DataFrame, no: DataFrame, keys: list[str], value: str) -> DataFrame:
    """spine with yes_<value> and no_<value>, and how complete each row is."""
    y, n = yes.select(*keys, F.col(value).alias(f"yes_{value}")), no.select(*keys, F.col(value).alias(f"no_{value}"))
    out = spine.join(y, keys, "left").join(n, keys, "left")
    has_yes, has_no = F.col(f"yes_{value}").isNotNull(), F.col(f"no_{value}").isNotNull()
    return out.withColumn("status", F.when(has_yes & has_no, "complete").when(has_yes, "yes_only").when(has_no, "no_only").otherwise("no_fills"))


def history_hash(df: DataFrame, key: str, ts: str, text: Column, tie: str) -> DataFrame:
    """A digest of each key's rows in order of time: of its days' digests, so that no list is longer than a day's rows or the days."""
    day = floor_epoch(F.col(ts), 86400)
    each = df.select(key, day.alias("_day"), F.struct(ts, tie, text.alias("_text")).alias("_row"))
    days = each.groupBy(key, "_day").agg(F.sort_array(F.collect_list("_row")).alias("_rows")).withColumn("_digest", F.sha2(F.array_join(F.col("_rows._text"), ","), 256))
    whole = days.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_day", "_digest"))).alias("_days"))
    return whole.select(key, F.sha2(F.array_join(F.col("_days._digest"), ","), 256).alias("history_hash"))


def contained_in(inner: DataFrame, outer: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """inner with inside: whether one of its group's outer ranges [outer_lo, outer_hi] holds it whole. Ranges of a group are bounded by merging
    them first (merge_intervals); each inner row meets the last range that starts at or before it."""
    stacked = outer.select(*by, F.col("lo").alias("_at"), F.lit(0).alias("_side"), F.col("hi").alias("_hi"), F.lit(None).cast(inner.select(F.struct("*").alias("s")).schema["s"].dataType).alias("_row"))
    rows = inner.select(*by, F.col(lo).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(outer.schema["hi"].dataType).alias("_hi"), F.struct("*").alias("_row"))
    seen = scan(rows.unionByName(stacked), by, ["_at", "_side"], {"_last": last_seen(F.col("_hi"))}).where("_row IS NOT NULL")
    return seen.select("_row.*", F.coalesce(F.col(f"_row.{hi}") <= F.col("_last"), F.lit(False)).alias("inside"))


def compare_leaves(a: DataFrame, b: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, verdict) of each leaf of two sources: equal, different, only_first or only_second."""
    both = a.select(key, F.col(digest).alias("_a"), F.lit(True).alias("_in_a")).join(b.select(key, F.col(digest).alias("_b"), F.lit(True).alias("_in_b")), key, "full")
    return both.select(key, F.when(F.col("_in_b").isNull(), "only_first").when(F.col("_in_a").isNull(), "only_second").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("different").alias("verdict"))


def check_freshness(df: DataFrame, by: str, ts: str, as_of: Column, warn_s: int, error_s: int) -> DataFrame:
    """(by, last_at, state): how old a source's last row is at as_of."""
    age = floor_epoch(as_of, 1) - floor_epoch(F.col("last_at"), 1)
    return df.groupBy(by).agg(F.max(ts).alias("last_at")).withColumn("state", F.when(age > error_s, "error").when(age > warn_s, "warn").otherwise("pass"))


def issues(df: DataFrame, key: str, tests: dict[str, tuple[str, Column, Column]]) -> DataFrame:
    """(key, issue, severity, measured): a row for each failed test; a test is (severity, condition, measured)."""
    each = F.array(*(F.when(c, F.struct(F.lit(name).alias("issue"), F.lit(severity).alias("severity"), m.cast("double").alias("measured"))) for name, (severity, c, m) in tests.items()))
    return df.select(key, F.explode(F.array_compact(each)).alias("_i")).select(key, "_i.*")


def check_graph(nodes: DataFrame, edges: DataFrame, node: str, edge: str) -> DataFrame:
    """(id, issue): edges whose node is missing (dangling_edge) and nodes without an edge (lonely_node)."""
    n, e = nodes.select(F.col(node).alias("id")).distinct(), edges.select(F.col(edge).alias("id")).distinct()
    return e.join(n, "id", "left_anti").withColumn("issue", F.lit("dangling_edge")).unionByName(n.join(e, "id", "left_anti").withColumn("issue", F.lit("lonely_node")))


def touch_depth(levels: DataFrame, book: str, side: Column, price: str, size: str, reach: float = 0.03) -> DataFrame:
    """(book, bid_depth, ask_depth, imbalance): sizes within reach of the best price of each side."""
    s = levels.select(book, side.alias("_side"), F.col(price).alias("_p"), F.col(size).alias("_n"))
    best = s.groupBy(book).agg(F.max(F.when(F.col("_side") == "bid", F.col("_p"))).alias("_bid"), F.min(F.when(F.col("_side") == "ask", F.col("_p"))).alias("_ask"))
    near = s.join(best, book)
    bid = F.sum(F.when((F.col("_side") == "bid") & (F.col("_p") >= F.col("_bid") - reach), F.col("_n")))
    ask = F.sum(F.when((F.col("_side") == "ask") & (F.col("_p") <= F.col("_ask") + reach), F.col("_n")))
    out = near.groupBy(book).agg(F.coalesce(bid, F.lit(0.0)).alias("bid_depth"), F.coalesce(ask, F.lit(0.0)).alias("ask_depth"))
    return out.withColumn("imbalance", F.round(safe_ratio(F.col("bid_depth") - F.col("ask_depth"), F.col("bid_depth") + F.col("ask_depth")), 8))


def score_checkpoints(df: DataFrame, by: str, order: list[str], score: str) -> DataFrame:
    """df with the running score and whether it moved by one step at most since the row before."""
    w = Window.partitionBy(by).orderBy(*order)
    out = df.withColumn("running_score", F.sum(score).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return out.withColumn("unit_step", F.col("running_score") - F.coalesce(F.lag("running_score").over(w), F.lit(0)) <= 1)

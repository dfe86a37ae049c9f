"""Ledger operators: what is known of each token, which tokens are due, and what to fetch next. Times are epoch seconds unless named _at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEDGER = ("cursor", "last_checked_at", "next_check_at", "empty_run_streak", "fully_checked")


def merge_ledger(ledger: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """ledger with the states merged in, a row at most of each key on either side: cursors never fall, fully_checked sticks and ends the
    checks, other fields take the state's value where it has one."""
    side = lambda df, p: df.select(key, F.lit(True).alias(f"{p}in"), *(F.col(c).alias(f"{p}{c}") for c in LEDGER))
    both = side(ledger, "_l_").join(side(states, "_s_"), key, "full")
    old, new = lambda c: F.col(f"_l_{c}"), lambda c: F.col(f"_s_{c}")
    done = F.coalesce(new("fully_checked"), F.lit(False))

    def rule(c: str, merged: Column) -> Column:
        return F.when(F.col("_l_in").isNull(), new(c)).when(F.col("_s_in").isNull(), old(c)).otherwise(merged).alias(c)

    return both.select(
        key, F.greatest(old("cursor"), new("cursor")).alias("cursor"), rule("last_checked_at", F.coalesce(new("last_checked_at"), old("last_checked_at"))),
        rule("next_check_at", F.when(~done, F.coalesce(new("next_check_at"), old("next_check_at")))),
        rule("empty_run_streak", F.when(done, 0).otherwise(F.coalesce(new("empty_run_streak"), old("empty_run_streak"), F.lit(0)))),
        rule("fully_checked", F.coalesce(old("fully_checked"), F.lit(False)) | done),
    )


def reconcile_ledger(history: DataFrame, ledger: DataFrame, key: str, ts: Column) -> DataFrame:
    """(key, cursor, repaired) of each key with history or a ledger row: the cursor is at least the history's last time."""
    last = history.groupBy(key).agg(F.max(ts).alias("_last"))
    both = last.join(ledger.select(key, "cursor"), key, "full")
    stale = F.col("_last").isNotNull() & (F.col("cursor").isNull() | (F.col("_last") > F.col("cursor")))
    return both.select(key, F.greatest("cursor", "_last").alias("cursor"), stale.alias("repaired"))


def refresh_current(current: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest observation of each key among what is current and a batch."""
    both = current.unionByName(batch)
    rest = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def due_states(catalog: DataFrame, ledger: DataFrame, skips: DataFrame, key: str, as_of: Column) -> DataFrame:
    """(key, state) of each catalog token: persisted_skip, closed_done, not_yet or due. catalog holds closed."""
    marked = catalog.select(key, "closed").join(ledger.select(key, "next_check_at", "fully_checked"), key, "left").join(skips.select(key, F.lit(True).alias("_skip")).distinct(), key, "left")
    done = F.coalesce(F.col("closed"), F.lit(False)) & F.coalesce(F.col("fully_checked"), F.lit(False))
    state = F.when(F.col("_skip"), "persisted_skip").when(done, "closed_done").when(F.col("next_check_at") > as_of, "not_yet").otherwise("due")
    return marked.select(key, state.alias("state"))


def plan_tokens(tokens: DataFrame, key: str, now: int, overlap_s: int, recent_s: int, floor: int | None = None, force: bool = False, rebuild: bool = False) -> DataFrame:
    """(key, start_ts, end_ts, reason): the span to fetch of each token, or the reason why there is none.

    tokens holds created_ts, latest_ts, closed, fully_checked, skipped and, where known, is_valid (false: invalid_token) and skip_budget (runs that a token without data is still left out: empty_cache_skip;
    skip_budget_left is then returned too, one less, null once it is used up). With a floor, or when history is rebuilt (from created_ts), the routine skips do not count; force
    lifts persisted, recent and empty ones. Of repeated tokens the first by created_ts is planned and the others are dup_token.
    """
    n = F.row_number().over(Window.partitionBy(key).orderBy("created_ts"))
    created, latest = F.col("created_ts"), F.col("latest_ts")
    routine, eased = F.lit(floor is None and not rebuild), F.lit(floor is None and not rebuild and not force)
    budget = F.coalesce(F.col("skip_budget"), F.lit(0)) if "skip_budget" in tokens.columns else F.lit(0)
    valid = F.coalesce(F.col("is_valid"), F.lit(False)) if "is_valid" in tokens.columns else F.lit(True)
    start = created if rebuild else F.greatest(created, F.lit(floor)) if floor is not None else F.when(latest.isNotNull(), F.greatest(created, latest - overlap_s)).otherwise(created)
    reason = (
        F.when(F.col("_n") > 1, "dup_token").when(~valid, "invalid_token").when(eased & F.col("skipped"), "persisted_skip").when(routine & F.col("closed") & F.col("fully_checked"), "closed_done")
        .when(eased & (budget > 0), "empty_cache_skip").when(eased & (F.lit(now) - latest < recent_s), "recent_skip").when(start >= now, "already_current")
    )
    out = tokens.withColumn("_n", n).withColumn("reason", reason)
    spent = F.nullif(F.when(F.col("reason") == "empty_cache_skip", budget - 1).otherwise(budget), F.lit(0))
    left = [spent.alias("skip_budget_left")] if "skip_budget" in tokens.columns else []
    return out.select(key, F.when(F.col("reason").isNull(), start).alias("start_ts"), F.when(F.col("reason").isNull(), F.lit(now).cast("long")).alias("end_ts"), "reason", *left)


def group_plans(plans: DataFrame, key: str, size: int, slot_s: int = 86_400) -> DataFrame:
    """plans with group_no: the plans in order of (start, span, token), size to a group.

    A plan's place is its rank within its slot of start times plus the plans of all slots before; only the counts of slots meet in one
    window, so the order is global without one task that sees every plan.
    """
    slotted = plans.withColumn("_slot", F.floor(F.col("start_ts") / slot_s))
    counts = slotted.groupBy("_slot").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = slotted.withColumn("_rank", F.row_number().over(Window.partitionBy("_slot").orderBy("start_ts", F.col("end_ts") - F.col("start_ts"), key)))
    placed = ranked.join(counts.select("_slot", before.alias("_before")), "_slot")
    return placed.withColumn("group_no", F.floor((F.col("_before") + F.col("_rank") - 1) / size).cast("long")).drop("_slot", "_rank", "_before")


def chunk_windows(df: DataFrame, lo: str, hi: str, step: int) -> DataFrame:
    """df with a row for each step of [lo, hi) as chunk_lo and chunk_hi; the last ends at hi. Empty spans give no row."""
    at = F.explode(F.sequence(F.col(lo), F.col(hi) - 1, F.lit(step).cast("long")))
    return df.where(F.col(hi) > F.col(lo)).withColumn("chunk_lo", at).withColumn("chunk_hi", F.least(F.col("chunk_lo") + step, F.col(hi)))


def next_state(results: DataFrame, key: str, routine_s: int, empty_base_s: int, empty_max_s: int, error_s: int) -> DataFrame:
    """(key, cursor, next_check, empty_run_streak, fully_checked) after a run of plans.

    results holds start_ts, end_ts, checked_ts, rows_fetched, had_error, is_closed, empty_run_streak, max_seen_ts, contiguous_ts (the last
    time seen without a hole) and checked_until_ts. Errors keep contiguous progress only; empty runs back off by powers of two.
    """
    c = F.col
    error, rows, start = c("had_error"), c("rows_fetched"), c("start_ts")
    kept = F.when(c("contiguous_ts") > start, c("contiguous_ts")).when((rows == 0) & (c("checked_until_ts") > start), c("checked_until_ts"))
    cursor = F.when(error, kept).when(rows > 0, c("max_seen_ts")).otherwise(c("end_ts"))
    done = c("is_closed") & ~error
    streak = F.when(error | (rows > 0), 0).otherwise(c("empty_run_streak") + 1).cast("long")
    back_off = (F.lit(empty_base_s) * F.pow(F.lit(2.0), F.greatest(streak - 1, F.lit(0)))).cast("long")
    back_off = F.least(back_off, F.lit(empty_max_s)) if empty_max_s > 0 else back_off
    wait = F.when(error, error_s).when(done, F.lit(None)).when(rows > 0, routine_s).otherwise(back_off).cast("long")
    return results.select(key, cursor.alias("cursor"), (c("checked_ts") + wait).alias("next_check"), streak.alias("empty_run_streak"), done.alias("fully_checked"))


def terminal_empty(audits: DataFrame, key: str, order: list[str], empty: Column, ts: str, before: Column) -> DataFrame:
    """Keys whose latest audit is empty and older than the retry age."""
    last = audits.groupBy(key).agg(F.max_by(F.struct(empty.alias("empty"), F.col(ts).alias("at")), F.struct(*order)).alias("_r"))
    return last.where(F.col("_r.empty") & (F.col("_r.at") < before)).select(key, F.col("_r.at").alias("last_audit_at"))


def hours_of(windows: DataFrame, by: list[str], lo: str, hi: str, seconds: int = 3600) -> DataFrame:
    """The distinct hours that the windows of each group touch, both ends included."""
    hour = lambda c: F.floor(F.col(c) / seconds).cast("long") * seconds
    return windows.select(*by, F.explode(F.sequence(hour(lo), hour(hi), F.lit(seconds).cast("long"))).alias("hour")).distinct()


def merge_records(df: DataFrame, key: str, rank: list[str], fields: list[str], evidence: str) -> DataFrame:
    """One record of each key: each field from the highest-ranked row that has it, evidence as the sorted union of all rows' values."""
    best = [F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(*rank))).alias(f) for f in fields]
    return df.groupBy(key).agg(*best, F.array_join(F.sort_array(F.collect_set(evidence)), ",").alias("evidence"))


def prune_runs(runs: DataFrame, job: list[str], status: str, at: list[str], cutoff, keep: int = 1) -> DataFrame:
    """runs without what is old: rows whose time (the first of at) is not before cutoff stay, and so do the last `keep` of each job and status, by at. A run without a time is old; a null
    status is one like any other."""
    last = F.row_number().over(Window.partitionBy(*job, status).orderBy(*(F.desc_nulls_last(c) for c in at)))
    return runs.withColumn("_last", last).where(F.coalesce(F.col(at[0]) >= cutoff, F.lit(False)) | (F.col("_last") <= keep)).drop("_last")


def merge_alerts(history: DataFrame, batch: DataFrame, key: list[str], at: str) -> DataFrame:
    """(key, first_seen, last_seen, times, is_open): the history of alerts with a batch of new ones. An alert that is in the batch is open, one that is not is closed; repeated alerts of a
    batch count each. Nulls in keys are values. history: the same columns, one row a key."""
    fresh = batch.groupBy(*key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("times")).withColumn("is_open", F.lit(True))
    both = history.withColumn("is_open", F.lit(False)).select(*key, "first_seen", "last_seen", "times", "is_open").unionByName(fresh)
    return both.groupBy(*key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times").alias("times"), F.max("is_open").alias("is_open"))

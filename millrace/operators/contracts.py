"""Relational contracts of published data: each check counts the rows that break it, and all counts of a table leave as one small report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds, ratio_half_even
from millrace.operators.scans import last_seen, next_seen, scan


def issue_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """(issue, rows) of the checks that have rows, each counted where its rows are."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("issue"), "rows") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, counted).where("rows > 0")


def row_issues(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(issue, rows) of conditions on single rows, in one pass; a condition that is null does not hold."""
    one = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(checks.values())))
    rows = F.array(*(F.struct(F.lit(n).alias("issue"), F.col(f"_{i}").alias("rows")) for i, n in enumerate(checks)))
    return one.select(F.explode(rows).alias("r")).select("r.*").where("rows > 0")


def bar_math(bars: DataFrame) -> DataFrame:
    """Issues of settlement bars: vwap (not the exact ratio of the volumes, to 18 digits, ties to even), range (a price or vwap outside low and high), single (a lone
    fill whose prices differ), empty (no fills or no volume), derived (more derived fills than fills), times (first after last)."""
    exact = ratio_half_even(F.col("collateral_volume"), F.col("share_volume"))
    lone = (F.col("fills") == 1) & ~((F.col("open_price") == F.col("close_price")) & (F.col("high_price") == F.col("low_price")) & (F.col("open_price") == F.col("high_price")))
    outside = F.exists(F.array("open_price", "close_price", "vwap"), lambda p: (p < F.col("low_price")) | (p > F.col("high_price")))
    return row_issues(bars, {"vwap": ~F.col("vwap").eqNullSafe(exact), "range": outside, "single": lone, "empty": ~((F.col("fills") > 0) & (F.col("share_volume") > 0)), "derived": F.col("derived_fills") > F.col("fills"), "times": F.col("first_at") > F.col("last_at")})


def fill_contract(fills: DataFrame, tokens: DataFrame, chunks: DataFrame) -> DataFrame:
    """Issues of raw fills: grain (a place and ordinal twice), lone_derived (a derived leg without its base, or base of another kind), mapping (a token of another proposition or
    none), values (price not in (0, 1), volumes not above 0, or price not their ratio), chunk_count (a chunk that says other than it has), chunk_range (a block outside its chunk).

    fills: chunk_id, block_number, transaction_hash, log_index, ordinal, proposition_id, token_id, price, share_volume, collateral_volume, normalization_kind, is_derived. tokens: token_id,
    proposition_id. chunks: chunk_id, from_block, to_block, fill_count.
    """
    place = ["transaction_hash", "log_index"]
    grain = fills.groupBy(*place, "ordinal").agg(F.count("*").alias("n")).where("n > 1")
    legs = fills.groupBy(*place).agg(F.count_if("is_derived").alias("d"), F.count_if(~F.col("is_derived")).alias("b"), F.count_if(~F.col("is_derived") & F.col("normalization_kind").isin("mint", "merge")).alias("p"))
    known = tokens.select("token_id", F.col("proposition_id").alias("_p"))
    mapped = fills.join(known, "token_id", "left").where(~F.coalesce(F.col("_p") == F.col("proposition_id"), F.lit(False)))
    sound = (F.col("price") > 0) & (F.col("price") < 1) & (F.col("share_volume") > 0) & (F.col("collateral_volume") > 0) & (F.col("price") == ratio_half_even(F.col("collateral_volume"), F.col("share_volume")))
    counts = fills.groupBy("chunk_id").agg(F.count("*").alias("_n"), F.min("block_number").alias("_lo"), F.max("block_number").alias("_hi"))
    met = chunks.join(counts, "chunk_id", "full")
    return issue_counts({
        "grain": grain, "lone_derived": legs.where("d > 0 AND (b <> 1 OR p <> 1 OR d <> 1)"), "mapping": mapped, "values": fills.where(~F.coalesce(sound, F.lit(False))),
        "chunk_count": met.where("NOT coalesce(fill_count, -1) = coalesce(_n, 0)"), "chunk_range": met.where("_lo < from_block OR _hi > to_block"),
    })


def range_contract(ranges: DataFrame, chunks: DataFrame, key: list[str]) -> DataFrame:
    """(key, issue, rows) of completed chunks that do not part their key's range [from_block, to_block] exactly: gap (nothing scanned before a chunk, or after the last),
    overlap (a chunk starts before another ends), outside (a chunk beyond the range), unknown (chunks of a key without a range), missing (a range without chunks). Chunks: from_block,
    to_block; large keys are scanned in segments."""
    c = chunks.select(*key, F.col("from_block").alias("lo"), F.col("to_block").alias("hi"))
    ordered = scan(c, key, ["lo", "hi"], {"before": last_seen(F.col("hi"), own=False), "after": next_seen(F.col("lo"), own=False)})
    both = ordered.join(ranges.select(*key, "from_block", "to_block"), key, "full")
    start = F.coalesce(F.col("before") + 1, F.col("from_block"))
    issues = {
        "unknown": F.col("from_block").isNull(), "missing": F.col("lo").isNull(), "gap": (F.col("lo") > start) | (F.col("after").isNull() & (F.col("hi") < F.col("to_block"))), "overlap": F.col("lo") <= F.col("before"), "outside": (F.col("lo") < F.col("from_block")) | (F.col("hi") > F.col("to_block")),
    }
    named = F.array_compact(F.array(*(F.when(cond, F.lit(n)) for n, cond in issues.items())))
    return both.select(*key, F.explode(named).alias("issue")).groupBy(*key, "issue").agg(F.count("*").alias("rows"))


def run_contract(runs: DataFrame, job: str, run: str, recorded: str, ratio_floor: float, coverage_floor: float) -> DataFrame:
    """(job, run, issue) of runs with planned, processed, rows, requests, http_ok, http_errors, errors, tokens, covered: negative (a number below 0), planned (fewer
    than processed), http (more answers than requests), ratio (rows per token below ratio_floor), coverage (share of covered tokens below coverage_floor), regression (more errors than the run
    of the job before). Nulls break nothing; a run without tokens has no ratio."""
    numbers = ["planned", "processed", "rows", "requests", "http_ok", "http_errors", "errors", "tokens", "covered"]
    r = scan(runs, [job], [recorded, run], {"_before": last_seen(F.col("errors"), own=False)})
    issues = {
        "negative": F.exists(F.array(*numbers), lambda x: F.coalesce(x < 0, F.lit(False))), "planned": F.col("planned") < F.col("processed"), "http": F.col("http_ok") + F.col("http_errors") > F.col("requests"),
        "ratio": (F.col("tokens") > 0) & (F.col("rows") < F.col("tokens") * ratio_floor), "coverage": (F.col("tokens") > 0) & (F.col("covered") < F.col("tokens") * coverage_floor), "regression": F.col("errors") > F.col("_before"),
    }
    named = F.array_compact(F.array(*(F.when(cond, F.lit(n)) for n, cond in issues.items())))
    return r.select(job, run, F.explode(named).alias("issue"))


def readiness(sources: DataFrame, seen: DataFrame, as_of: Column) -> DataFrame:
    """(source, state, age_s) of each expected source: missing (no rows), future (its last row is after as_of: not point-in-time), stale (older than max_age_s) or ready. sources:
    source, max_age_s. seen: source, at."""
    last = seen.groupBy("source").agg(F.max("at").alias("_at"))
    age = epoch_seconds(as_of) - epoch_seconds(F.col("_at"))
    state = F.when(F.col("_at").isNull(), "missing").when(F.col("_at") > as_of, "future").when(age > F.col("max_age_s"), "stale").otherwise("ready")
    return sources.join(last, "source", "left").select("source", state.alias("state"), age.alias("age_s"))

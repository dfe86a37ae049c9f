"""Minute models: primary-token minutes and their mart, settlement minutes, and a match's observed and dense minutes.

All take bars or fills as tables and return tables; a market's minutes lie between the bounds of its window, so nothing is exploded further than that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch, issue_list, ratio_half_even
from millrace.operators.bars import minute_spine, minute_status
from millrace.operators.joins import prefer
from millrace.operators.scans import SEGMENT_ROWS, last_seen, scan

PRICES = ["open_price", "high_price", "low_price", "close_price", "avg_price"]
OBSERVED = ["observed_points", "first_observed_at", "last_observed_at"]


def token_minute_odds(match: DataFrame, futures: DataFrame) -> DataFrame:
    """Primary-token minutes of both sources with minute_source; where both have a (clob_token_id, odds_minute_epoch), those of match count."""
    tag = lambda df, name: df.withColumn("minute_source", F.lit(name))
    return prefer(tag(match, "match"), tag(futures, "futures").select(*match.columns, "minute_source"), ["clob_token_id", "odds_minute_epoch"])


def market_minute_mart(odds: DataFrame, primary: DataFrame, markets: DataFrame) -> DataFrame:
    """The public minute mart: minutes of primary tokens (market_id, clob_token_id, outcome_label) with their market's columns. Prices are renamed
    open_odds and so on; minutes of other tokens and of unknown markets are left out. primary and markets hold each key once."""
    named = odds.withColumnsRenamed({p: p.replace("_price", "_odds") for p in PRICES})
    tokens = primary.select("market_id", "clob_token_id", F.col("outcome_label").alias("primary_outcome_label"))
    return named.join(tokens, ["market_id", "clob_token_id"]).join(markets.drop("clob_token_id"), "market_id")


def settlement_minutes(fills: DataFrame, tokens: DataFrame, scans: DataFrame) -> DataFrame:
    """Bars of settled fills by (proposition_id, token_id, outcome_side, minute epoch) in chain order, with exact volumes and the volume-weighted price.

    fills: scan_id, proposition_id, token_id, block_timestamp, block_number, transaction_index, log_index, ordinal, price, share_volume, collateral_volume, is_derived.
    tokens: proposition_id, token_id, outcome_side, window_lo, window_hi; a fill counts in [lo, hi). scans: scan_id, status, raw_published, published_at, finished_at:
    only the fills of the last published one count.
    """
    newest = F.struct(F.col("published_at"), F.col("finished_at"), F.col("scan_id"))
    last = scans.where("status = 'published' AND raw_published").agg(F.max_by("scan_id", newest).alias("scan_id"))
    chosen = fills.join(F.broadcast(last), "scan_id").join(tokens, ["proposition_id", "token_id"]).where("block_timestamp >= window_lo AND block_timestamp < window_hi")
    at = F.struct("block_number", "transaction_index", "log_index", "ordinal")
    bars = chosen.groupBy("proposition_id", "token_id", "outcome_side", floor_epoch(F.col("block_timestamp"), 60).alias("minute_epoch")).agg(
        F.min_by("price", at).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"), F.max_by("price", at).alias("close_price"), F.count("*").alias("fills"), F.count_if("is_derived").alias("derived_fills"),
        F.sum("share_volume").cast("decimal(38,6)").alias("share_volume"), F.sum("collateral_volume").cast("decimal(38,6)").alias("collateral_volume"), F.min("block_timestamp").alias("first_at"), F.max("block_timestamp").alias("last_at"),
    )
    return bars.withColumn("vwap", ratio_half_even(F.col("collateral_volume"), F.col("share_volume")))


def settlement_candidate(minutes: DataFrame, working: DataFrame) -> DataFrame:
    """Each minute of each proposition's window [window_lo, window_hi) with the bars of its two sides (yes_ and no_ columns) and state: both, yes_only, no_only or
    no_fills, and pair_deviation, by how much both closes together differ from 1. working: proposition_id, window_lo, window_hi."""
    step = F.lit(60).cast("long")
    last = floor_epoch(F.col("window_hi") - F.expr("INTERVAL 1 MICROSECOND"), 60)
    spine = working.where("window_lo < window_hi").select("proposition_id", F.explode(F.sequence(floor_epoch(F.col("window_lo"), 60), last, step)).alias("minute_epoch"))
    values = ["open_price", "high_price", "low_price", "close_price", "vwap", "fills", "share_volume", "collateral_volume"]
    sided = minutes.groupBy("proposition_id", "minute_epoch").agg(*(F.max(F.when(F.col("outcome_side") == s, F.col(v))).alias(f"{s}_{v}") for s in ("yes", "no") for v in values))
    out = spine.join(sided, ["proposition_id", "minute_epoch"], "left")
    yes, no = F.col("yes_close_price").isNotNull(), F.col("no_close_price").isNotNull()
    state = F.when(yes & no, "both").when(yes, "yes_only").when(no, "no_only").otherwise("no_fills")
    return out.withColumn("state", state).withColumn("pair_deviation", F.abs(F.col("yes_close_price") + F.col("no_close_price") - 1))


def observed_minutes(registry: DataFrame, ohlc: DataFrame) -> DataFrame:
    """The minutes of each market in which one of its tokens was seen, within its window from minute to minute, both included: the yes token's bar as
    it is, the no token's as no_ columns. registry: market_id, yes_token_id, no_token_id, window_start_at, window_end_at and more, all kept. ohlc: market_id,
    clob_token_id, odds_minute_epoch, prices and observation columns; one row a token and minute."""
    sides = F.explode(F.array(F.struct(F.lit("yes").alias("side"), F.col("yes_token_id").alias("clob_token_id")), F.struct(F.lit("no").alias("side"), F.col("no_token_id").alias("clob_token_id"))))
    tokens = registry.select("market_id", floor_epoch(F.col("window_start_at"), 60).alias("_lo"), floor_epoch(F.col("window_end_at"), 60).alias("_hi"), sides.alias("_s")).select("market_id", "_lo", "_hi", "_s.*")
    seen = ohlc.join(tokens, ["market_id", "clob_token_id"]).where("odds_minute_epoch BETWEEN _lo AND _hi")
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = seen.groupBy("market_id", "odds_minute_epoch").agg(*(of(s, c).alias(("" if s == "yes" else "no_") + c) for s in ("yes", "no") for c in (*PRICES, *OBSERVED)))
    points = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("observed_points", "no_observed_points")}
    return both.withColumns(points).join(registry, "market_id")


def dense_minutes(observed: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every minute of the windows of observed markets. A minute without a bar of a side carries that side's last close, with is_observed false; before
    the first there is none. minutes_since_observation counts minute boundaries since the last observation."""
    bars = [*PRICES, *OBSERVED]
    markets = observed.drop("odds_minute_epoch", *bars, *(f"no_{c}" for c in bars)).dropDuplicates(["market_id"])
    spine = minute_spine(markets, "window_start_at", "window_end_at").withColumnRenamed("bucket", "odds_minute_epoch")
    joined = spine.join(observed.select("market_id", "odds_minute_epoch", *bars, *(f"no_{c}" for c in bars)), ["market_id", "odds_minute_epoch"], "left")
    carried = {f"_{p}{c}": last_seen(F.col(f"{p}{c}")) for p in ("", "no_") for c in ("close_price", "last_observed_at")}
    out = scan(joined, ["market_id"], ["odds_minute_epoch"], carried, rows)
    cols = {}
    for p, flag in (("", "is_observed"), ("no_", "is_no_observed")):
        seen, close, at = F.col(f"{p}close_price").isNotNull(), F.col(f"_{p}close_price"), F.col(f"_{p}last_observed_at")
        cols |= {flag: seen, f"{p}last_observed_at": at, f"{p}observed_points": F.coalesce(f"{p}observed_points", F.lit(0)).cast("long"), f"{p}minutes_since_observation": F.floor((F.col("odds_minute_epoch") - floor_epoch(at, 60)) / 60)}
        cols |= {f"{p}{c}": F.when(seen, F.col(f"{p}{c}")).otherwise(close) for c in PRICES}
    return out.withColumns(cols).drop(*carried, "first_observed_at", "no_first_observed_at")


def rebuild_changed(target: DataFrame, state: DataFrame, build: Callable[[DataFrame], DataFrame], market: str = "market_id", revision: str = "source_revision") -> DataFrame:
    """target brought up to state (market, revision, ...): rows of markets that are gone or have another revision go, and build(the changed markets) is added.
    Equals build(state) if target was built so. The caller writes the result to a new place."""
    current = state.select(market, revision).distinct()
    kept = target.join(current, [market, revision], "left_semi")
    dirty = state.join(target.select(market, revision).distinct(), [market, revision], "left_anti")
    return kept.unionByName(build(dirty).select(*target.columns))


def minute_quality(dense: DataFrame) -> DataFrame:
    """One row of counts over dense minutes: minutes, markets, unobserved (markets never seen), bounds (a price outside [0, 1]), order (low, open, close and high do not
    fit), axis (markets whose minutes have a hole or a copy), and blocking_keys, the names of those of the last four that are not 0."""
    prices = [f"{p}{c}" for p in ("", "no_") for c in PRICES]
    outside = F.exists(F.array(*prices), lambda x: F.coalesce((x < 0) | (x > 1), F.lit(False)))
    bad = F.lit(False)
    for p in ("", "no_"):
        bad = bad | F.coalesce((F.col(f"{p}low_price") > F.least(f"{p}open_price", f"{p}close_price")) | (F.col(f"{p}high_price") < F.greatest(f"{p}open_price", f"{p}close_price")), F.lit(False))
    m = dense.groupBy("market_id").agg(F.count("*").alias("_n"), F.count_distinct("odds_minute_epoch").alias("_d"), ((F.max("odds_minute_epoch") - F.min("odds_minute_epoch")) / 60 + 1).cast("long").alias("_span"), F.count_if("is_observed").alias("_seen"), F.count_if(outside).alias("_out"), F.count_if(bad).alias("_bad"))
    row = m.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("minutes"), F.count("*").alias("markets"), F.count_if(F.expr("_seen = 0")).alias("unobserved"), F.coalesce(F.sum("_out"), F.lit(0)).alias("bounds"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("order"), F.count_if(F.expr("_n <> _d OR _n <> _span")).alias("axis"))
    return row.withColumn("blocking_keys", F.nullif(F.concat_ws(",", *(F.when(F.col(c) > 0, F.lit(c)) for c in ("unobserved", "bounds", "order", "axis"))), F.lit("")))


def boundary_status(dense: DataFrame) -> DataFrame:
    """dense with minute_status: complete where both sides were seen, else at which end of its market's window the minute lies."""
    return dense.withColumn("minute_status", minute_status(F.col("is_observed") & F.col("is_no_observed"), F.col("odds_minute_epoch"), F.col("window_start_at"), F.col("window_end_at")))


def match_candidate(ohlc: DataFrame, working: DataFrame) -> DataFrame:
    """Each minute of each market's match, from that of started_at to that of finished_at, with the bars of both tokens as they are (null where there is none, nothing is
    carried), pair_deviation and minute_status. ohlc: clob_token_id, odds_minute_epoch, prices and observation columns, ticks within the match alone. working: market_id,
    yes_token_id, no_token_id, started_at, finished_at and more, all kept."""
    spine = minute_spine(working, "started_at", "finished_at").withColumnRenamed("bucket", "odds_minute_epoch")
    side = lambda s: ohlc.select(F.col("clob_token_id").alias(f"{s}_token_id"), "odds_minute_epoch", *(F.col(c).alias(f"{s}_{c}") for c in (*PRICES, *OBSERVED)))
    both = spine.join(side("yes"), ["yes_token_id", "odds_minute_epoch"], "left").join(side("no"), ["no_token_id", "odds_minute_epoch"], "left")
    complete = F.col("yes_close_price").isNotNull() & F.col("no_close_price").isNotNull()
    status = minute_status(complete, F.col("odds_minute_epoch"), F.col("started_at"), F.col("finished_at"))
    return both.withColumn("pair_deviation", F.abs(F.col("yes_close_price") + F.col("no_close_price") - 1)).withColumn("minute_status", status)


def modeling_games(dense: DataFrame, least_share: int = 99, longest_gap: int = 3) -> DataFrame:
    """(event_id, markets, expected, observed, longest_gap, reasons): reasons is null for events fit for modeling, else the comma-joined names of what they lack: markets (three of
    them, one for each role), prices (a minute without one), coverage (less than least_share of a hundred minutes observed), gap (more than longest_gap minutes on end without an
    observation). dense: dense_minutes() with event_id and result_role."""
    m = dense.groupBy("event_id", "market_id").agg(F.max("result_role").alias("_role"), F.count("*").alias("_n"), F.count_if("is_observed").alias("_seen"), F.count_if(F.col("close_price").isNull()).alias("_bare"), F.max("minutes_since_observation").alias("_gap"))
    e = m.groupBy("event_id").agg(F.count("*").alias("markets"), F.count_distinct("_role").alias("_roles"), F.sum("_n").alias("expected"), F.sum("_seen").alias("observed"), F.sum("_bare").alias("_bare"), F.coalesce(F.max("_gap"), F.lit(0)).alias("longest_gap"))
    lacks = (("markets", (F.col("markets") != 3) | (F.col("_roles") != 3)), ("prices", F.col("_bare") > 0), ("coverage", F.col("observed") * 100 < F.col("expected") * least_share), ("gap", F.col("longest_gap") > longest_gap))
    return e.withColumn("reasons", issue_list(*lacks)).drop("_roles", "_bare")


def eligible_markets(snapshots: DataFrame, registry: DataFrame, order: list[str], live: bool = True) -> DataFrame:
    """The last snapshot of each market (by order, then by all of its columns) that the registry holds as eligible (market_id, is_event_volume_eligible); live: of those that are
    active and not closed alone. A market that the registry has twice is eligible if one of its rows is."""
    content = F.struct(*order, *sorted(c for c in snapshots.columns if c not in order))
    last = snapshots.groupBy("market_id").agg(F.max_by(F.struct("*"), content).alias("_s")).select("_s.*")
    eligible = registry.groupBy("market_id").agg(F.max(F.coalesce("is_event_volume_eligible", F.lit(False))).alias("_e")).where("_e").select("market_id")
    chosen = last.join(eligible, "market_id", "left_semi")
    return chosen.where("active AND NOT coalesce(closed, false)") if live else chosen

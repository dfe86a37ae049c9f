"""Marts of the second venue: hourly prices of classified markets, their current state, coverage by stage, quality issues; odds to win; release summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch, safe_ratio
from millrace.operators.bars import progression_side
from millrace.operators.joins import checkpoint_prices
from millrace.operators.rules import price_status

STATUSES = ["resolved", "closed", "live", "inactive"]
PRICE_STATUSES = ["fresh_live", "stale_live", "missing_live", "historical_closed", "historical_resolved", "inactive"]


def classified_hourly(markets: DataFrame, candles: DataFrame, inverted: Column, market: str = "market_id") -> DataFrame:
    """Candles of the classified markets with the markets' columns, as bars of the side that goes on: where inverted holds (a market on elimination), prices are 1 - p."""
    return progression_side(candles.join(markets, market), inverted)


def classified_current(markets: DataFrame, hourly: DataFrame, now_epoch: Column, fresh_hours: int, market: str = "market_id", hour: str = "bucket", price: str = "close_price") -> DataFrame:
    """markets with current_price, its hour and age, current_price_status and is_actionable (alive, live and fresh). A market has the price of its latest hour, or none.

    markets: market, market_status, is_still_alive. hour: seconds of the epoch."""
    latest = hourly.groupBy(market).agg(F.max_by(price, hour).alias("current_price"), F.max(hour).alias("current_hour"))
    m = markets.join(latest, market, "left").withColumn("current_age_hours", F.round((now_epoch - F.col("current_hour")) / 3600.0, 4))
    m = m.withColumn("current_price_status", price_status(F.col("market_status"), F.col("current_price"), F.col("current_age_hours"), fresh_hours))
    return m.withColumn("is_actionable", F.coalesce(F.col("is_still_alive") & (F.col("current_price_status") == "fresh_live"), F.lit(False)))


def stage_coverage(markets: DataFrame, hourly: DataFrame, by: list[str], hours: int, volume: str, market: str = "market_id", hour: str = "bucket") -> DataFrame:
    """For each group of markets: how many, how many with prices and without, rows, expected rows (hours a market), rows a market, first and last hour, least and greatest volume, and completeness (at most 1, to 6 digits)."""
    n = hourly.groupBy(market).agg(F.count("*").alias("_n"), F.min(hour).alias("_lo"), F.max(hour).alias("_hi"))
    m = markets.join(n, market, "left")
    rows = F.sum(F.coalesce("_n", F.lit(0)))
    g = m.groupBy(*by).agg(
        F.count("*").alias("markets"), F.count("_n").alias("markets_with_prices"), (F.count("*") - F.count("_n")).alias("markets_without_prices"), rows.alias("hourly_rows"), (F.count("*") * hours).alias("expected_rows"),
        F.min(F.coalesce("_n", F.lit(0))).alias("least_rows"), F.max(F.coalesce("_n", F.lit(0))).alias("most_rows"), F.min("_lo").alias("first_hour"), F.max("_hi").alias("last_hour"), F.min(volume).alias("least_volume"), F.max(volume).alias("most_volume"),
    )
    return g.withColumn("completeness", F.least(F.round(F.col("hourly_rows") / F.col("expected_rows"), 6), F.lit(1.0)))


def venue_issues(current: DataFrame, teams: DataFrame, market: str = "market_id") -> DataFrame:
    """(issue_key, severity, team_name, issue_count) of current markets against the results' teams.

    current: market, team_name, source_status, market_status, is_still_alive, current_price, current_price_status. teams: team_name, tournament_status. Team names are compared in lower case. An issue of a
    market counts 1; of an eliminated team with live markets, these."""
    live, key = F.col("market_status") == "live", F.col(market).cast("string")
    kind = F.when(live, "live").when(F.col("market_status").isin("closed", "resolved"), "historical").otherwise("inactive")
    out = lambda c, known: ~F.coalesce(c.isin(known), F.lit(False))
    checks = F.array(
        F.when(F.col("current_price").isNull() & (F.coalesce(~live, F.lit(True)) | F.col("is_still_alive")), F.struct(F.concat(kind, F.lit("_missing_hourly_odds:"), key).alias("issue_key"), F.lit("warn").alias("severity"))),
        F.when((F.col("current_price_status") == "stale_live") & F.col("is_still_alive"), F.struct(F.concat(F.lit("live_stale_hourly_odds:"), key).alias("issue_key"), F.lit("warn").alias("severity"))),
        F.when(out(F.col("market_status"), STATUSES), F.struct(F.concat(F.lit("invalid_market_status:"), key).alias("issue_key"), F.lit("error").alias("severity"))),
        F.when(out(F.col("current_price_status"), PRICE_STATUSES), F.struct(F.concat(F.lit("invalid_current_price_status:"), key).alias("issue_key"), F.lit("error").alias("severity"))),
        F.when(live & (F.lower("source_status") != "active"), F.struct(F.concat(F.lit("live_contract_conflict:"), key).alias("issue_key"), F.lit("error").alias("severity"))),
    )
    of_markets = current.select("team_name", F.explode(F.array_compact(checks)).alias("i")).select("i.*", "team_name", F.lit(1).cast("long").alias("issue_count"))
    listed = current.where(live).groupBy(F.lower("team_name").alias("_k")).agg(F.count("*").alias("_live"))
    met = teams.withColumn("_k", F.lower("team_name")).join(listed, "_k", "left")
    active = F.col("tournament_status") == "active"
    absent = met.where(active & F.col("_live").isNull()).select(F.concat(F.lit("active_team_missing_live_stage_odds:"), "team_name").alias("issue_key"), F.lit("warn").alias("severity"), "team_name", F.lit(1).cast("long").alias("issue_count"))
    lagging = met.where(~active & F.col("_live").isNotNull()).select(F.concat(F.lit("live_stage_odds_for_eliminated_team:"), "team_name").alias("issue_key"), F.lit("warn").alias("severity"), "team_name", F.col("_live").alias("issue_count"))
    return of_markets.unionByName(absent).unionByName(lagging)


def odds_to_win(points: DataFrame, series: DataFrame, n: int, team: str = "team", ts: str = "at", price: str = "price") -> DataFrame:
    """A row for each point and each of the n teams of the highest price in the last hour at or before the first point (ties by team): opening_rank, opening_price, the price and its time: the last
    at or before the first point, the first after each other one.

    points: game_sequence (0: the start), ts and others, a small table. series: team, ts (the hour), price. Points meet the n ranks by a sequence in each row, so nothing is crossed."""
    start = points.where("game_sequence = 0").agg(F.min(ts).alias("_start"))
    before = series.join(F.broadcast(start), F.col(ts) <= F.col("_start")).drop("_start")
    snapshot = before.agg(F.max(ts).alias(ts))
    opening = before.join(F.broadcast(snapshot), ts).groupBy(team).agg(F.max(price).alias("opening_price"))
    ranked = opening.orderBy(F.desc("opening_price"), team).limit(n).agg(F.sort_array(F.collect_list(F.struct((-F.col("opening_price")).alias("_o"), F.col(team).alias(team), "opening_price"))).alias("_t"))
    ranked = ranked.select(F.posexplode("_t").alias("opening_rank", "_x")).select((F.col("opening_rank") + 1).alias("opening_rank"), f"_x.{team}", "_x.opening_price")
    each = points.withColumn("opening_rank", F.explode(F.sequence(F.lit(1), F.lit(n)))).join(F.broadcast(ranked), "opening_rank")
    some = series.join(F.broadcast(ranked.select(team)), team, "left_semi")
    return checkpoint_prices(each, some, [team], "game_sequence", ts, price).withColumnsRenamed({"asof_value": "odds_to_win", "asof_at": "odds_at"})


def minute_summary(minutes: DataFrame, by: list[str], market: str, bucket: str, status: str) -> DataFrame:
    """Release summary of minute rows: rows, markets, complete rows and their share, first and last minute, least and greatest number of rows a market, markets without a complete row."""
    one = minutes.groupBy(*by, market).agg(F.count("*").alias("_n"), F.count_if(F.col(status) == "complete").alias("_c"), F.min(bucket).alias("_lo"), F.max(bucket).alias("_hi"))
    g = one.groupBy(*by).agg(F.sum("_n").alias("rows"), F.count("*").alias("markets"), F.sum("_c").alias("complete_rows"), F.min("_lo").alias("first_minute"), F.max("_hi").alias("last_minute"), F.min("_n").alias("least_rows"), F.max("_n").alias("most_rows"), F.count_if(F.col("_c") == 0).alias("markets_without_complete"))
    return g.withColumn("complete_share", F.round(F.col("complete_rows") / F.col("rows"), 6))


def settlement_summary(bars: DataFrame, by: list[str], market: str) -> DataFrame:
    """Release summary of settlement minutes: rows, markets, minutes with fills, fills, derived fills, both volumes, and the VWAP of the group to 6 digits (null without shares)."""
    filled = F.coalesce(F.col("fills") > 0, F.lit(False))
    one = bars.groupBy(*by, market).agg(F.count("*").alias("_n"), F.count_if(filled).alias("_m"), *(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("fills", "derived_fills", "share_volume", "collateral_volume")))
    g = one.groupBy(*by).agg(F.sum("_n").alias("rows"), F.count("*").alias("markets"), F.sum("_m").alias("filled_minutes"), *(F.sum(c).alias(c) for c in ("fills", "derived_fills", "share_volume", "collateral_volume")))
    return g.withColumn("vwap", F.round(safe_ratio(F.col("collateral_volume").cast("double"), F.col("share_volume").cast("double")), 6))


def audit_counts(audit: DataFrame, run: str = "fetch_run_id", market: str = "market_id", token: str = "token_id") -> DataFrame:
    """For each run: audited rows, successes, empty ones, hard failures (error or cancelled), published rows, distinct markets and tokens. audit: run, market, token, fetch_status, raw_published."""
    s = F.col("fetch_status")
    per = audit.groupBy(run, market, token).agg(F.count("*").alias("_n"), *(F.count_if(c).alias(n) for n, c in {"success": s == "success", "empty": s == "empty", "hard": s.isin("error", "cancelled"), "published": F.col("raw_published")}.items()))
    per = per.groupBy(run, market).agg(F.sum("_n").alias("_n"), F.count(token).alias("_t"), *(F.sum(n).alias(n) for n in ("success", "empty", "hard", "published")))
    owned = audit.where(F.col(token).isNotNull()).groupBy(run, token).agg(F.lit(1).alias("_")).groupBy(run).agg(F.count("*").alias("tokens"))
    out = per.groupBy(run).agg(F.sum("_n").alias("audited"), *(F.sum(n).alias(n) for n in ("success", "empty", "hard", "published")), F.count(market).alias("markets"))
    return out.join(owned, run, "left").fillna(0, ["tokens"])


def raw_issues(raw: DataFrame, key: list[str], fidelity: str, expected: int = 1) -> DataFrame:
    """(issue, rows): empty (no row at all), fidelity (rows of another fidelity, or none), duplicate (keys that come more than once)."""
    one = raw.groupBy(*key).agg(F.count("*").alias("_n"), F.count_if(~F.col(fidelity).eqNullSafe(F.lit(expected))).alias("_f"))
    all_rows = one.agg(F.count("*").alias("k"), F.coalesce(F.sum("_f"), F.lit(0)).alias("f"), F.count_if(F.col("_n") > 1).alias("d"))
    named = F.array(F.struct(F.lit("empty").alias("issue"), (F.col("k") == 0).cast("long").alias("rows")), F.struct(F.lit("fidelity").alias("issue"), F.col("f").alias("rows")), F.struct(F.lit("duplicate").alias("issue"), F.col("d").alias("rows")))
    return all_rows.select(F.explode(named).alias("r")).select("r.*").where("rows > 0")


def match_quality(registry: DataFrame, dense: DataFrame, now_epoch: Column, grace_seconds: int = 3600, market: str = "market_id") -> DataFrame:
    """One row: due markets (their window ended at least the grace ago), others, unavailable ones, due ones that can be published, the minutes that each of these should have (both ends of the
    window count), and the dense minutes there are.

    registry: market, window_lo, window_hi, is_unavailable, a row a market. dense: market and a row a minute, counted before it is joined."""
    minutes = F.floor(floor_epoch(F.col("window_hi"), 60) / 60) - F.floor(floor_epoch(F.col("window_lo"), 60) / 60) + 1
    r = registry.join(dense.groupBy(market).agg(F.count("*").alias("_dense")), market, "left")
    r = r.select(minutes.alias("m"), (floor_epoch(F.col("window_hi"), 1) <= now_epoch - grace_seconds).alias("due"), F.coalesce("is_unavailable", F.lit(False)).alias("gone"), F.coalesce("_dense", F.lit(0)).alias("d"))
    due, open_ = F.col("due"), F.col("due") & ~F.col("gone")
    of = lambda c, v: F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0)).cast("long")
    return r.agg(
        F.count_if(due).alias("due_markets"), F.count_if(~due).alias("not_due_markets"), F.count_if("gone").alias("unavailable_markets"), F.count_if(open_).alias("publishable_due_markets"), of(F.lit(True), "m").alias("expected_minutes"),
        of(due, "m").alias("expected_due_minutes"), of(open_, "m").alias("expected_recoverable_minutes"), of(due, "d").alias("due_dense_minutes"), of(open_, "d").alias("recoverable_dense_minutes"),
    )

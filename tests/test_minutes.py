"""Minute models on the fixture of one match with three markets, and settlement minutes by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import bars, minutes
from millrace.operators.quality import GateClosed, gate

START = dt.datetime(2025, 1, 2, 12, 0, 30)


@pytest.fixture(scope="module")
def registry(spark):
    rows = [("e", f"m{i}", role, f"y{i}", f"n{i}", START, START + dt.timedelta(minutes=4), "r1") for i, role in enumerate(("home_win", "draw", "away_win"))]
    return spark.createDataFrame(rows, "event_id string, market_id string, result_role string, yes_token_id string, no_token_id string, window_start_at timestamp_ntz, window_end_at timestamp_ntz, source_revision string")


def ohlc(spark, ticks):
    df = spark.createDataFrame(ticks, "market_id string, clob_token_id string, ts timestamp_ntz, price double")
    return bars.ohlc(df, ["market_id", "clob_token_id"], "ts", "price", 60).withColumnRenamed("bucket", "odds_minute_epoch")


def ticks():
    at = lambda m, s=0: START + dt.timedelta(minutes=m, seconds=s)
    rows = []
    for i in range(3):
        rows += [(f"m{i}", f"y{i}", at(0), 0.2 + 0.1 * i), (f"m{i}", f"y{i}", at(3), 0.4 + 0.1 * i), (f"m{i}", f"n{i}", at(1), 0.55 + 0.05 * i), (f"m{i}", f"y{i}", at(-1), 0.9), (f"m{i}", f"y{i}", at(5), 0.9), (f"m{i}", "other", at(2), 0.9)]
    return rows


def test_observed_and_dense(spark, registry):
    observed = minutes.observed_minutes(registry, ohlc(spark, ticks()))
    base = int(START.replace(second=0, tzinfo=dt.timezone.utc).timestamp())
    assert sorted((r.market_id, (r.odds_minute_epoch - base) // 60, r.observed_points, r.no_observed_points) for r in observed.collect()) == [(f"m{i}", m, *p) for i in range(3) for m, p in ((0, (1, 0)), (1, (0, 1)), (3, (1, 0)))]
    for rows in (minutes.SEGMENT_ROWS, 2):
        dense = sorted((r for r in minutes.dense_minutes(observed, rows).collect() if r.market_id == "m1"), key=lambda r: r.odds_minute_epoch)
        assert [(r.is_observed, round(r.close_price, 9), r.observed_points, r.minutes_since_observation) for r in dense] == [(True, 0.3, 1, 0), (False, 0.3, 0, 1), (False, 0.3, 0, 2), (True, 0.5, 1, 0), (False, 0.5, 0, 1)]
        assert [(r.is_no_observed, r.no_close_price and round(r.no_close_price, 9)) for r in dense] == [(False, None), (True, 0.6), (False, 0.6), (False, 0.6), (False, 0.6)]
        assert dense[0].event_id == "e" and dense[0].result_role == "draw"
    quality = minutes.minute_quality(minutes.dense_minutes(observed))
    assert tuple(quality.first()) == (15, 3, 0, 0, 0, 0, None)
    assert gate(observed, quality).count() == 9
    status = {r.odds_minute_epoch: r.minute_status for r in minutes.boundary_status(minutes.dense_minutes(observed)).where("market_id = 'm1'").collect()}
    assert [status[base + 60 * m] for m in range(5)] == ["start_boundary_incomplete", "interior_incomplete", "interior_incomplete", "interior_incomplete", "finish_boundary_incomplete"]


def test_quality_blocks(spark, registry):
    rows = [*ticks(), ("m1", "y1", START, 1.5)]
    dense = minutes.dense_minutes(minutes.observed_minutes(registry, ohlc(spark, rows)))
    broken = dense.where(~((F.col("market_id") == "m0") & (F.col("odds_minute_epoch") % 180 == 60))).withColumn("low_price", F.when(F.col("market_id") == "m2", 0.95).otherwise(F.col("low_price")))
    quality = minutes.minute_quality(broken)
    assert quality.first().blocking_keys == "bounds,order,axis"
    with pytest.raises(GateClosed, match="bounds"):
        gate(dense, quality)
    assert tuple(minutes.minute_quality(dense.limit(0)).first())[:2] == (0, 0)


def test_rebuild_of_changed_markets(spark, registry):
    bars_now = ohlc(spark, ticks())
    build = lambda state: minutes.dense_minutes(minutes.observed_minutes(state, bars_now))
    target = build(registry)
    state = registry.where("market_id != 'm2'").withColumn("source_revision", F.when(F.col("market_id") == "m0", "r2").otherwise(F.col("source_revision")))
    got = minutes.rebuild_changed(target, state, build)
    assert sorted(map(str, got.collect())) == sorted(map(str, build(state).select(got.columns).collect())) and got.count() == 10


def test_mart(spark):
    schema = "market_id string, clob_token_id string, odds_minute_epoch long, open_price double, high_price double, low_price double, close_price double, avg_price double, observed_points long"
    match = spark.createDataFrame([("m", "t", 60, 0.1, 0.1, 0.1, 0.1, 0.1, 1)], schema)
    futures = spark.createDataFrame([("m", "t", 60, 0.9, 0.9, 0.9, 0.9, 0.9, 1), ("m", "t", 120, 0.2, 0.2, 0.2, 0.2, 0.2, 2), ("m", "u", 60, 0.8, 0.8, 0.8, 0.8, 0.8, 1), ("x", "t", 60, 0.8, 0.8, 0.8, 0.8, 0.8, 1)], schema)
    odds = minutes.token_minute_odds(match, futures)
    assert sorted((r.market_id, r.clob_token_id, r.odds_minute_epoch, r.close_price, r.minute_source) for r in odds.collect()) == [("m", "t", 60, 0.1, "match"), ("m", "t", 120, 0.2, "futures"), ("m", "u", 60, 0.8, "futures")]
    primary = spark.createDataFrame([("m", "t", "Yes")], "market_id string, clob_token_id string, outcome_label string")
    mart = minutes.market_minute_mart(odds, primary, spark.createDataFrame([("m", "Who?", "t")], "market_id string, question string, clob_token_id string"))
    assert sorted((r.odds_minute_epoch, r.close_odds, r.primary_outcome_label, r.question) for r in mart.collect()) == [(60, 0.1, "Yes", "Who?"), (120, 0.2, "Yes", "Who?")]


def test_settlement_minutes(spark):
    t, d = dt.datetime(2026, 6, 1, 10), Decimal
    fill = lambda scan, token, s, block, log, price, shares: (scan, "p", token, t + dt.timedelta(seconds=s), block, 0, log, 0, d(price), d(shares), d(shares) * d(price), log == 9)
    rows = [fill("new", "y", 5, 1, 2, "0.5", "2"), fill("new", "y", 5, 1, 1, "0.4", "1"), fill("new", "y", 50, 2, 9, "0.3", "1"), fill("new", "n", 130, 3, 1, "0.75", "4"), fill("old", "y", 6, 1, 1, "0.9", "9"), fill("new", "y", -1, 1, 1, "0.9", "9"), fill("new", "y", 240, 1, 1, "0.9", "9"), fill("new", "z", 9, 1, 1, "0.9", "9")]
    fills = spark.createDataFrame(rows, "scan_id string, proposition_id string, token_id string, block_timestamp timestamp_ntz, block_number long, transaction_index long, log_index long, ordinal int, price decimal(38,18), share_volume decimal(38,6), collateral_volume decimal(38,6), is_derived boolean")
    hi = t + dt.timedelta(minutes=4)
    tokens = spark.createDataFrame([("p", "y", "yes", t, hi), ("p", "n", "no", t, hi)], "proposition_id string, token_id string, outcome_side string, window_lo timestamp_ntz, window_hi timestamp_ntz")
    scans = spark.createDataFrame([("old", "published", True, t, t), ("new", "published", True, hi, t), ("bad", "failed", False, dt.datetime(2027, 1, 1), t)], "scan_id string, status string, raw_published boolean, published_at timestamp_ntz, finished_at timestamp_ntz")
    found = minutes.settlement_minutes(fills, tokens, scans)
    base = int(t.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {(r.outcome_side, (r.minute_epoch - base) // 60): (r.open_price, r.high_price, r.low_price, r.close_price, r.fills, r.derived_fills, r.vwap) for r in found.collect()}
    assert got == {("yes", 0): (d("0.4"), d("0.5"), d("0.3"), d("0.3"), 3, 1, d("0.425")), ("no", 2): (d("0.75"),) * 4 + (1, 0, d("0.75"))}
    work = spark.createDataFrame([("p", t, hi), ("q", t, t)], "proposition_id string, window_lo timestamp_ntz, window_hi timestamp_ntz")
    states = [(r.state, r.yes_fills, r.no_fills) for r in minutes.settlement_candidate(found, work).orderBy("minute_epoch").collect()]
    assert states == [("yes_only", 3, None), ("no_fills", None, None), ("no_only", None, 1), ("no_fills", None, None)]


def test_match_candidate(spark, registry):
    working = registry.where("market_id = 'm1'").selectExpr("market_id", "yes_token_id", "no_token_id", "window_start_at AS started_at", "window_start_at + INTERVAL 3 MINUTES AS finished_at")
    rows = [*ticks(), ("m1", "n1", START + dt.timedelta(minutes=3, seconds=9), 0.5)]
    got = minutes.match_candidate(ohlc(spark, rows).drop("market_id"), working).orderBy("odds_minute_epoch").collect()
    assert [(r.yes_close_price, r.no_close_price and round(r.no_close_price, 9), r.minute_status) for r in got] == [(0.30000000000000004, None, "start_boundary_incomplete"), (None, 0.6, "interior_incomplete"), (None, None, "interior_incomplete"), (0.5, 0.5, "complete")]
    assert got[3].pair_deviation == 0 and got[0].pair_deviation is None


def test_modeling_games(spark, registry):
    every = lambda markets, skip=(): [(m, f"y{m[1]}", START + dt.timedelta(minutes=i), 0.5) for m in markets for i in range(5) if i not in skip]
    games = lambda rows, **k: minutes.modeling_games(minutes.dense_minutes(minutes.observed_minutes(registry, ohlc(spark, rows))), **k).first()
    assert tuple(games(every(["m0", "m1", "m2"]))) == ("e", 3, 15, 15, 0, None)
    assert games(every(["m0", "m1"])).reasons == "markets"
    assert games(every(["m0", "m1"]) + every(["m2"], (0,))).reasons == "prices,coverage"
    assert games(every(["m0", "m1"]) + every(["m2"], (1, 2, 3, 4))).reasons == "coverage,gap"
    assert games(every(["m0", "m1"]) + every(["m2"], (4,)), least_share=90).reasons is None


def test_eligible_markets(spark):
    s = spark.createDataFrame([("a", 1, True, False), ("a", 2, False, False), ("b", 1, True, None), ("c", 1, True, False), ("d", 1, True, True), ("e", 1, True, False)], "market_id string, at int, active boolean, closed boolean")
    r = spark.createDataFrame([("a", True), ("b", False), ("b", True), ("c", None), ("d", True)], "market_id string, is_event_volume_eligible boolean")
    assert [(x.market_id, x.at) for x in minutes.eligible_markets(s, r, ["at"]).collect()] == [("b", 1)]
    assert sorted((x.market_id, x.at) for x in minutes.eligible_markets(s, r, ["at"], live=False).collect()) == [("a", 2), ("b", 1), ("d", 1)]

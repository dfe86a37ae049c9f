"""Contracts: each check on rows that break it and on rows that do not."""

import datetime as dt
import hashlib
import math
from decimal import Decimal as D

from pyspark.sql import functions as F

from millrace.operators import contracts as K
from millrace.operators.registry import hash_sample

T = dt.datetime(2026, 6, 1)


def test_bar_math(spark):
    good = (D("0.4"), D("0.5"), D("0.3"), D("0.3"), D("0.425"), 3, 1, D("4"), D("1.7"), T, T)
    rows = [good, (D("0.5"), D("0.5"), D("0.5"), D("0.5"), D("0.5"), 1, 0, D("2"), D("1"), T, T)]
    schema = "open_price decimal(38,18), high_price decimal(38,18), low_price decimal(38,18), close_price decimal(38,18), vwap decimal(38,18), fills long, derived_fills long, share_volume decimal(38,6), collateral_volume decimal(38,6), first_at timestamp_ntz, last_at timestamp_ntz"
    assert K.bar_math(spark.createDataFrame(rows, schema)).count() == 0
    bad = [(*good[:4], D("0.426"), *good[5:]), (*good[:5], 1, 0, *good[7:]), (D("0.6"), *good[1:]), (*good[:6], 4, *good[7:]), (*good[:9], T + dt.timedelta(1), T), (*good[:5], 0, 0, D(0), D(0), T, T)]
    assert {r.issue: r.rows for r in K.bar_math(spark.createDataFrame(bad, schema)).collect()} == {"vwap": 2, "single": 1, "range": 1, "derived": 1, "times": 1, "empty": 1}


def test_fills(spark):
    fill = lambda *r: r
    rows = [fill(1, 5, "t", 1, 0, "p", "y", D("0.5"), D(2), D(1), "complementary", False), fill(1, 6, "u", 1, 0, "p", "n", D("0.25"), D(4), D(1), "mint", False), fill(1, 6, "u", 1, 1, "p", "y", D("0.75"), D(4), D(3), "mint", True)]
    schema = "chunk_id int, block_number long, transaction_hash string, log_index long, ordinal int, proposition_id string, token_id string, price decimal(38,18), share_volume decimal(38,6), collateral_volume decimal(38,6), normalization_kind string, is_derived boolean"
    tokens = spark.createDataFrame([("y", "p"), ("n", "p")], "token_id string, proposition_id string")
    chunks = spark.createDataFrame([(1, 1, 9, 3), (2, 10, 19, 0)], "chunk_id int, from_block long, to_block long, fill_count long")
    assert K.fill_contract(spark.createDataFrame(rows, schema), tokens, chunks).count() == 0
    bad = [*rows, rows[0], fill(1, 50, "v", 1, 1, "q", "y", D("0.6"), D(2), D(1), "merge", True), fill(3, 50, "w", 1, 0, "p", None, D("0.5"), D(2), D(1), "complementary", False)]
    assert {r.issue: r.rows for r in K.fill_contract(spark.createDataFrame(bad, schema), tokens, chunks).collect()} == {"grain": 1, "lone_derived": 1, "mapping": 2, "values": 1, "chunk_count": 2, "chunk_range": 1}


def test_ranges(spark):
    ranges = spark.createDataFrame([("ok", 0, 29), ("gap", 0, 29), ("end", 0, 29), ("over", 0, 29), ("none", 0, 9)], "k string, from_block long, to_block long")
    c = [("ok", 0, 9), ("ok", 10, 29), ("gap", 5, 9), ("gap", 12, 29), ("end", 0, 20), ("over", 0, 12), ("over", 10, 31), ("odd", 1, 2)]
    got = {(r.k, r.issue): r.rows for r in K.range_contract(ranges, spark.createDataFrame(c, "k string, from_block long, to_block long"), ["k"]).collect()}
    assert got == {("gap", "gap"): 2, ("end", "gap"): 1, ("over", "overlap"): 1, ("over", "outside"): 1, ("none", "missing"): 1, ("odd", "unknown"): 1}


def test_runs(spark):
    schema = "job string, run int, at int, planned int, processed int, rows int, requests int, http_ok int, http_errors int, errors int, tokens int, covered int"
    good = (10, 10, 100, 20, 18, 2, 1, 10, 10)
    runs = [("a", 1, 1, *good), ("a", 2, 2, *good[:6], 3, *good[7:]), ("a", 3, 3, 9, *good[1:]), ("b", 4, 1, -1, -2, None, 1, 1, 1, None, 10, 5), ("b", 5, 2, *good[:2], 4, *good[3:]), ("b", 6, 3, *good[:6], 1, 0, 0)]
    got = {(r.run, r.issue) for r in K.run_contract(spark.createDataFrame(runs, schema), "job", "run", "at", 0.5, 0.9).collect()}
    assert got == {(2, "regression"), (3, "planned"), (4, "negative"), (4, "http"), (4, "coverage"), (5, "ratio")}


def test_readiness(spark):
    sources = spark.createDataFrame([(s, 60) for s in ("ready", "stale", "future", "missing")], "source string, max_age_s int")
    seen = spark.createDataFrame([("ready", T - dt.timedelta(seconds=60)), ("ready", T - dt.timedelta(9)), ("stale", T - dt.timedelta(seconds=61)), ("future", T + dt.timedelta(seconds=1)), ("other", T)], "source string, at timestamp_ntz")
    assert {r.source: r.state for r in K.readiness(sources, seen, F.lit(T).cast("timestamp_ntz")).collect()} == {s: s for s in ("ready", "stale", "future", "missing")}


def test_hash_sample(spark):
    df = spark.range(3000).selectExpr("id % 1000 AS k", "id AS v").union(spark.createDataFrame([(None, 1)], "k long, v long"))
    order = sorted(range(1000), key=lambda k: hashlib.sha256(f"s:{k}".encode()).hexdigest())
    for share in (0.0, 0.001, 0.3337, 1.0):
        assert sorted(r.k for r in hash_sample(df, "k", share, "s").collect()) == sorted(order[: math.ceil(1000 * share)] * 3)

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import bars, joins, merge, quality, windows
from millrace.plans import catalog, evidence, gates, ledger, market, registry, releases, venue

DATA = "/root/testdata/sf0.001"


PLANS = (market, registry, ledger, releases, catalog, venue, gates, evidence)
ALL, ALL_SQL = {k: q for p in PLANS for k, q in p.QUERIES.items()}, {k: q for p in PLANS for k, q in p.SQL.items()}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, name):
    got = ALL[name](spark, DATA)
    names = sorted(got.columns)
    db = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    want = db.execute(ALL_SQL[name]).df()[names]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(key, got.select(*names).collect())) == sorted(key(r) for r in db.execute(f"select {', '.join(names)} from ({ALL_SQL[name]})").fetchall())
    assert len(want) == got.count()


def test_ratio_half_even(spark):
    cases = [("7", "100", "0.07"), ("1", "3", "0.333333333333333333"), ("0.000001", "2000000000000", "0"), ("0.000003", "2000000000000", "0.000000000000000002"), ("5", "0", None)]
    rows = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b, _ in cases], "a decimal(38,6), b decimal(38,6)")
    got = [r[0] for r in rows.select(C.ratio_half_even(F.col("a"), F.col("b"))).collect()]
    assert got == [None if w is None else Decimal(w) for _, _, w in cases]


def test_asof_ties_and_strictness(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    left = spark.createDataFrame([(1, "a", t(5)), (2, "a", t(1)), (3, "b", t(9))], "id int, k string, at timestamp_ntz")
    right = spark.createDataFrame([("a", t(5), 1.0), ("a", t(5), 2.0), ("a", t(3), 7.0)], "k string, at timestamp_ntz, v double")
    got = lambda strict: {r.id: r.asof_value for r in joins.asof_join(left, right, ["k"], "at", "at", "v", strict).collect()}
    assert got(False) == {1: 2.0, 2: None, 3: None}
    assert got(True) == {1: 7.0, 2: None, 3: None}


def test_incremental_equals_full(spark):
    full = {tuple(r) for r in market.bars_hourly(spark, DATA).collect()}
    assert {tuple(r) for r in market.bars_incremental_hourly(spark, DATA).select(*market.bars_hourly(spark, DATA).columns).collect()} == full


def test_gate_both_ways(spark):
    df = spark.createDataFrame([(0.5,), (1.5,)], "p double")
    with pytest.raises(quality.GateClosed, match="price_range"):
        quality.gate(df, quality.quality_row(df, {"price_range": F.col("p") > 1}))
    assert quality.gate(df, quality.quality_row(df, {"price_range": F.col("p") > 2})).count() == 2


def test_merges(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    b = spark.createDataFrame([(2, 21), (2, 22), (3, 30)], "k int, v int")
    assert sorted(map(tuple, merge.merge_append(t, b, ["k"], [F.desc("v")]).collect())) == [(1, 10), (2, 20), (3, 30)]
    assert sorted(map(tuple, merge.merge_replace(t, b, ["k"], [F.desc("v")]).collect())) == [(1, 10), (2, 22), (3, 30)]


def test_intervals(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 3, 5), ("a", 5, 6), ("a", 9, 10)], "k string, lo int, hi int")
    merged = windows.merge_intervals(df, ["k"], "lo", "hi")
    assert sorted((r.lo, r.hi, r.members) for r in merged.collect()) == [(1, 6, 3), (9, 10, 1)]
    assert [(r.gap_lo, r.gap_hi) for r in windows.interval_gaps(merged, ["k"]).collect()] == [(6, 9)]


def test_empty_bars(spark):
    assert bars.ohlc(spark.createDataFrame([], "k int, ts timestamp_ntz, p double"), ["k"], "ts", "p", 60).count() == 0


def test_buckets_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30),), (dt.datetime(1969, 12, 31, 23, 59, 59),)], "t timestamp_ntz")
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in rows.select(C.floor_epoch(F.col("t"), 3600)).collect()] == [1704067200, -3600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratio_of_signs(spark):
    rows = spark.createDataFrame([(Decimal(-1), Decimal(3)), (Decimal(1), Decimal(-3)), (Decimal(0), Decimal(3))], "a decimal(38,6), b decimal(38,6)")
    assert [r[0] for r in rows.select(C.ratio_half_even(F.col("a"), F.col("b"))).collect()] == [None, None, Decimal(0)]

"""Small operators and functions, each against values worked out by hand, and streams and profiles against whole tables."""

import datetime as dt
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import books, joins, ledger, merge, profiles, quality, settlement
from millrace.streaming.joins import stream_distinct, stream_interval_join


def test_prefer(spark):
    a, b = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (1, "b")], [(1, "x"), (2, "y"), (2, "z"), (None, "n")]))
    assert sorted(map(tuple, joins.prefer(a, b, ["k"]).collect()), key=str) == [(1, "a"), (1, "b"), (2, "y"), (2, "z"), (None, "n")]


def test_null_safe_diff(spark):
    a, b = (spark.createDataFrame(r, "k string, v int, w int") for r in ([("a", 1, None), ("b", None, 2), (None, 3, 3)], [("a", 1, None), ("b", 0, 2), (None, 3, 4)]))
    assert sorted((r.k for r in joins.null_safe_diff(a, b, ["k"], ["v", "w"]).collect()), key=str) == [None, "b"]


def test_prune(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(6)], "t int, kept boolean")
    assert [r.t for r in merge.prune(df, "t", 3).orderBy("t").collect()] == [3, 4, 5]
    assert [r.t for r in merge.prune(df, "t", 3, F.col("kept")).orderBy("t").collect()] == [0, 2, 3, 4, 5]


def test_merge_rules_take_each_key_once(spark):
    target = spark.createDataFrame([(1, 5, 5, 5, 5, False), (2, 1, 1, 1, 1, None)], "k int, a int, b int, c int, d int, e boolean")
    batch = spark.createDataFrame([(1, 7, 7, 7, 7, False), (1, 3, 3, 3, 3, True), (3, None, 4, 4, 4, None), (3, 6, 2, 2, 2, None)], target.schema)
    got = merge.merge_rules(target, batch, ["k"], {"a": "new", "b": "keep", "c": "greatest", "d": "least", "e": "sticky"})
    assert sorted(map(tuple, got.collect())) == [(1, 7, 5, 7, 3, True), (2, 1, 1, 1, 1, False), (3, 6, 2, 4, 2, False)]


def test_checks(spark):
    bars = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5), (1.0, 0.9, 0.5, 0.8), (0.4, 2.0, 0.5, 1.0), (None, 2.0, 1.0, 1.5)], "open_price double, high_price double, low_price double, close_price double")
    assert sorted(r.high_price for r in quality.check_ohlc(bars).collect()) == [0.9, 2.0]
    assert sorted(r.p for r in quality.check_unit_interval(spark.createDataFrame([(0.0,), (1.0,), (1.01,), (-0.1,), (None,)], "p double"), ["p"]).collect()) == [-0.1, 1.01]
    axis = spark.createDataFrame([("ok", i) for i in range(3)] + [("hole", 0), ("hole", 2), ("late", 1), ("twice", 0), ("twice", 0), ("twice", 1)], "k string, i int")
    assert {r.k for r in quality.check_axis(axis, ["k"], "i").collect()} == {"hole", "late", "twice"}


def test_functions(spark):
    row = spark.range(1).select(
        C.compact_key(F.lit("Saint-Étienne  FC")).alias("key"), C.full_match(F.lit("ab"), "a|ab").alias("whole"), C.full_match(F.lit("abc"), "a|ab").alias("part"), C.haversine_km(F.lit(52.52), F.lit(13.405), F.lit(48.8566), F.lit(2.3522)).alias("km"),
        C.decimal_string(F.lit("1.5000")).alias("d1"), C.decimal_string(F.lit("100")).alias("d2"), C.decimal_string(F.lit("x")).alias("d3"), C.decimal_string(F.lit("1e30")).alias("d4"), C.clean_text(F.lit(" Ｗｅ\r\nﬁnd\x00 it\r ")).alias("text"),
        C.name_key(F.lit("Łódź Čech Őr ø")).alias("name"),
    ).first()
    assert (row.key, row.whole, row.part, row.d1, row.d2, row.d3, row.d4, row.name) == ("saintetiennefc", True, False, "1.5", "100", None, None, "lodz cech or o")
    assert abs(row.km - 877.46) < 0.5 and row.text.startswith("We\nfind it")


def _files(spark, root, parts, schema):
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(root)


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_stream_join_equals_batch(spark, tmp_path, how):
    draw, t = random.Random(3), dt.datetime(2026, 6, 1)
    side = lambda n: [(draw.choice(["a", "b", None]), i, t + dt.timedelta(seconds=i * 40 + draw.randrange(60))) for i in range(n)]
    left, right = side(60), side(60)
    end = t + dt.timedelta(days=9)
    schemas = {"left": "k string, i int, at timestamp", "right": "k string, j int, seen timestamp"}
    root, out, progress = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "progress")
    for cut in ((0, 25), (25, 60), None):
        for name, rows in (("left", left), ("right", right)):
            _files(spark, f"{root}/{name}", [rows[slice(*cut)] if cut else [("end", -1, end)]], schemas[name])
        l, r = (spark.readStream.schema(schemas[n]).parquet(f"{root}/{n}") for n in ("left", "right"))
        stream = stream_interval_join(l, r, ["k"], "at", "seen", 90, 30, "5 minutes", how)  # each run starts again from the checkpoint
        assert stream.writeStream.format("parquet").option("checkpointLocation", progress).option("path", out).trigger(availableNow=True).start().awaitTermination(120)
    got = sorted((r.i, -1 if r.j is None else r.j) for r in spark.read.parquet(out).collect() if r.i >= 0)
    want = [(i, j) for k, i, a in left for q, j, b in right if k == q and k and -90 <= (b - a).total_seconds() <= 30]
    lone = [(i, -1) for _, i, _ in left if i not in {x for x, _ in want}] if how == "left_outer" else []
    assert got == sorted(want + lone) and want


def test_stream_distinct(spark, tmp_path):
    t = dt.datetime(2026, 6, 1)
    rows = [(i % 20, t + dt.timedelta(seconds=i)) for i in range(100)]
    _files(spark, str(tmp_path / "in"), [rows[:50], rows[50:]], "k int, at timestamp")
    stream = stream_distinct(spark.readStream.schema("k int, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), ["k"], "at")
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "p")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(20))


def test_merged_profiles_equal_the_whole(spark):
    df = spark.range(20_000).selectExpr("id % 7 AS part", "CASE WHEN id % 10 <> 0 THEN (id * 7919) % 5000 END AS v", "concat('t', id % 300) AS s")
    parts = profiles.profile_parts(df, ["part"], ["v", "s"])
    assert parts.count() == 14
    merged, whole = ({r.column_name: r for r in profiles.merge_profiles(p, []).collect()} for p in (parts, profiles.profile_parts(df, [], ["v", "s"])))
    exact = df.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("d"), F.count_distinct("v").alias("n")).first()
    for p in (merged, whole):
        v, s = p["v"], p["s"]
        assert (v.rows, v.null_share, v.shortest, v.longest, s.quantiles, s.mean) == (20_000, 0.1, 1, 4, None, None)
        assert abs(v.mean - exact.m) < 1e-6 and abs(v.deviation - exact.d) < 1e-6 and abs(v.approx_distinct / exact.n - 1) < 0.03 and abs(s.approx_distinct - 300) <= 9
        ranks = [df.where(f"v <= {q}").count() / 18_000 for q in v.quantiles]
        assert all(abs(r - w) < 0.02 for r, w in zip(ranks, (0.05, 0.5, 0.95), strict=True))
    assert profiles.profile_parts(df.limit(0), ["part"], ["v"]).count() == 0


def test_pruned_runs(spark):
    rows = [("a", "ok", 1), ("a", "ok", 2), ("a", "ok", 9), ("a", "bad", 1), ("a", "bad", 3), ("b", None, 1), ("b", "ok", None), ("b", "ok", 4)]
    got = ledger.prune_runs(spark.createDataFrame(rows, "job string, status string, at int"), ["job"], "status", ["at"], 9)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "ok", 9), ("a", "bad", 3), ("b", None, 1), ("b", "ok", 4)], key=str)


def test_alert_history(spark):
    schema = "k string, first_seen int, last_seen int, times long, is_open boolean"
    history = spark.createDataFrame([("old", 1, 2, 2, True), ("again", 1, 1, 1, False), (None, 3, 3, 1, True)], schema)
    batch = spark.createDataFrame([("again", 5), ("again", 7), ("new", 6), (None, 6)], "k string, at int")
    got = {r.k: tuple(r)[1:] for r in ledger.merge_alerts(history, batch, ["k"], "at").collect()}
    assert got == {"old": (1, 2, 2, False), "again": (1, 7, 3, True), "new": (6, 6, 1, True), None: (3, 6, 2, True)}


def test_aggressors(spark):
    book = spark.createDataFrame([("t", 10, 0.4, 0.6), ("t", 20, 0.5, 0.7), ("t", 30, None, 0.7)], "k string, ms int, best_bid double, best_ask double")
    trades = spark.createDataFrame([("t", 5, 0.9), ("t", 10, 0.6), ("t", 19, 0.4), ("t", 20, 0.6), ("t", 35, 0.1), ("t", 36, 0.7), ("u", 50, 0.5)], "k string, ms int, price double")
    for rows in (1, books.SEGMENT_ROWS):
        got = books.aggressor_side(trades, book, ["k"], "ms", "price", rows)
        assert [r.aggressor for r in got.orderBy("ms").collect()] == ["unknown", "buy", "sell", "unknown", "unknown", "buy", "unknown"]


def test_rolling_metrics_equal_brute_force(spark):
    draw = random.Random(4)
    states = [(draw.choice("ab"), t, draw.random()) for t in draw.sample(range(3000), 120)]
    trades = [(draw.choice("ab"), draw.randrange(3000), float(draw.randrange(1, 9))) for _ in range(90)]
    s, t = spark.createDataFrame(states, "k string, ms long, mid double"), spark.createDataFrame(trades, "k string, ms long, size double")
    got = {(r.k, r.ms): (r.rolling_volume, r.rolling_deviation) for r in books.rolling_metrics(s, t, ["k"], "ms", "mid", "size", 250, 20).collect()}
    assert len(got) == 120
    for k in "ab":
        line = sorted((ms, m) for q, ms, m in states if q == k)
        changes = {b[0]: b[1] - a[1] for a, b in zip(line, line[1:], strict=False)}
        for ms, _ in line:
            near = [c for x, c in changes.items() if ms - 250 < x <= ms]
            volume, deviation = got[k, ms]
            assert volume == sum(z for q, x, z in trades if q == k and ms - 250 < x <= ms)
            assert deviation is None if not near else abs(deviation - statistics.pstdev(near)) < 1e-9


def test_books_in_canonical_form(spark):
    side = lambda *p: json.dumps([{"price": a, "size": b, "order_count": 1} for a, b in p])
    cases = {
        None: (side(("0.50", "10.0"), ("0.4", "1")), side(("0.6", "2"))), "json": ("{", "[]"), "number": (side(("x", "1")), "[]"), "bounds": (side(("0.5", "0")), "[]"), "duplicate": (side(("0.5", "1"), ("0.50", "2")), ""),
        "order": (side(("0.4", "1"), ("0.5", "1")), None), "crossed": (side(("0.7", "1")), side(("0.6", "1"))),
    }
    df = spark.createDataFrame([(str(k), *v) for k, v in cases.items()], "name string, bids_json string, asks_json string")
    got = {r.name: r for r in books.normalize_books(df).collect()}
    assert {n: str(r.issue) for n, r in got.items()} == {str(k): str(k) for k in cases}
    assert (got["None"].bids_json, got["None"].asks_json) == ('[{"price":"0.5","size":"10"},{"price":"0.4","size":"1"}]', '[{"price":"0.6","size":"2"}]')
    assert got["None"].content_sha256 and got["crossed"].content_sha256 is None
    assert books.normalize_books(spark.createDataFrame([("", None)], "bids_json string, asks_json string")).first().issue is None


def test_block_ranges(spark):
    t = dt.datetime(2026, 6, 1)
    at = lambda m: t + dt.timedelta(minutes=m)
    blocks = spark.createDataFrame([(100 + i, at(2 * i)) for i in range(30)], "block_number long, block_timestamp timestamp_ntz")
    windows = spark.createDataFrame([("x", at(1), at(4)), ("x", at(4), at(9)), ("x", at(20), at(21)), ("x", at(21), at(22)), ("y", at(-9), at(1)), ("y", at(90), at(99))], "k string, window_lo timestamp_ntz, window_hi timestamp_ntz")
    assert sorted(map(tuple, settlement.block_ranges(windows, blocks, ["k"]).collect())) == [("x", 101, 104), ("x", 110, 110), ("y", 100, 100)]

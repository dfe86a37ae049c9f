"""Segmented scans: equal to one window, with no task that holds a large key whole."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import bars, books, catalog, joins, registry, scans, windows
from millrace.operators.scans import Scan, last_seen, next_seen, scan

ROWS = 6


@pytest.fixture(scope="module")
def ticks(spark):
    draw = random.Random(11)
    rows = [(draw.choice(["hot"] * 6 + [None] * 3 + ["cold", "b"]), draw.randrange(400), i, draw.choice([None, draw.randrange(50)])) for i in range(160)]
    return spark.createDataFrame([*rows, ("one", None, 900, 3)], "k string, t int, i int, v int").selectExpr("*", "t + v % 7 * 5 AS hi", "timestamp_seconds(t * 977)::timestamp_ntz AS at").repartition(5)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_scan_equals_a_window(spark, ticks):
    w = Window.partitionBy("k").orderBy("t", "i")
    before, own = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    pair = F.when(F.col("v") % 3 == 0, F.struct("v", "i"))
    kinds = {"last": last_seen(F.col("v")), "strict": last_seen(pair, own=False), "next": next_seen(pair), "sum": Scan("sum", F.col("v")), "low": Scan("min", F.col("v"), own=False), "n": Scan("sum", F.lit(1))}
    want = ticks.withColumns({"last": F.last("v", True).over(own), "strict": F.last(pair, True).over(before), "next": F.first(pair, True).over(ahead), "sum": F.sum("v").over(own), "low": F.min("v").over(before), "n": F.sum(F.lit(1)).over(own)})
    for rows in (ROWS, 1, 40, scans.SEGMENT_ROWS):
        assert rows_of(scan(ticks, ["k"], ["t", "i"], kinds, rows).select(want.columns)) == rows_of(want)
    assert scan(ticks.limit(0), ["k"], ["t"], kinds, 1).count() == 0


def test_no_task_holds_a_large_key(spark, ticks):
    large = scans.large_keys(ticks, ["k"], ROWS)
    assert {r.k for r in large.collect()} >= {"hot", None, "cold"} and "one" not in {r.k for r in large.collect()}
    cut = scans.segments(ticks, ["k"], ["t", "i"], large, ROWS)
    sizes = cut.groupBy("_large", "_segment").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("_large", "_segment").collect()
    assert max(r.n for r in sizes) <= 3 * ROWS and len(sizes) > 15
    assert all(a.hi <= b.lo for a, b in zip(sizes, sizes[1:], strict=False) if a["_large"] == b["_large"])


def test_large_keys_are_bounded(spark, ticks, monkeypatch):
    monkeypatch.setattr(scans, "MOST_LARGE", 1)
    assert [r.k for r in scans.large_keys(ticks, ["k"], ROWS).collect()] == ["hot"]
    assert rows_of(windows.locf(ticks, ["k"], ["t", "i"], ["v"], ROWS)) == rows_of(windows.locf(ticks, ["k"], ["t", "i"], ["v"]))


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("forward", [False, True])
def test_asof_of_a_large_key(spark, ticks, strict, forward):
    left, right = ticks.where("i % 2 = 0"), ticks.where("i % 2 = 1 AND v IS NOT NULL")
    got = rows_of(joins.asof_join(left, right, ["k"], "t", "t", "v", strict, forward, ROWS))
    assert got == rows_of(joins.asof_join(left, right, ["k"], "t", "t", "v", strict, forward))
    held = [(r.k, r.t, r.v) for r in right.collect() if r.t is not None]
    for r in joins.asof_join(left, right, ["k"], "t", "t", "v", strict, forward, ROWS).collect():
        if r.t is None:
            continue
        good = [(t, v) for k, t, v in held if k == r.k and (t > r.t if forward and strict else t >= r.t if forward else t < r.t if strict else t <= r.t)]
        edge = (min if forward else max)((t for t, _ in good), default=None)
        assert (r.asof_at, r.asof_value) == (edge, max((v for t, v in good if t == edge), default=None))


def test_intervals_and_runs_of_a_large_key(spark, ticks):
    spans = ticks.where("hi IS NOT NULL")
    for f in (
        lambda n: windows.merge_intervals(spans, ["k"], "t", "hi", n),
        lambda n: windows.interval_gaps(windows.merge_intervals(spans, ["k"], "t", "hi", n), ["k"], n),
        lambda n: catalog.merge_members(spans, ["k"], "t", "hi", 3, n),
        lambda n: windows.max_gap(ticks, ["k"], ["t", "i"], F.coalesce(F.col("v") > 20, F.lit(False)), n),
        lambda n: windows.with_gap(ticks, ["k"], "at", ["i"], n),
        lambda n: windows.sequence_by(ticks, ["k"], ["t", "i"], n),
        lambda n: bars.dense(bars.ohlc(ticks, ["k"], "at", "v", 3600), ["k"], 3600, n),
        lambda n: books.level_intervals(ticks.withColumn("p", F.col("i") % 4), "k", ["t", "i"], "at", F.col("i") % 23 == 0, "p", "v", n),
    ):
        assert rows_of(f(ROWS)) == rows_of(f(scans.SEGMENT_ROWS))


def test_times_do_not_depend_on_the_session_zone(spark):
    ntz = spark.createDataFrame([("a", 1, "2024-03-10 01:30:00"), ("a", 2, "2024-03-10 03:30:00")], "k string, i int, s string").selectExpr("k", "i", "s::timestamp_ntz AS at", "i AS v")
    edges = ntz.selectExpr("k", "at AS lo", "at + INTERVAL 1 HOUR AS hi")
    text = spark.createDataFrame([("2024-07-01T10:00:00",), ("2024-07-01",), ("2024-07-01T10:00:00.123456789Z",), ("2024-07-01 12:00:00+02:00",), ("soon",), (None,)], "s string")

    def seen():
        from millrace.functions.columns import parse_ts

        gaps = [r.gap_seconds for r in windows.with_gap(ntz, ["k"], "at", ["i"]).orderBy("i").collect()]
        sums = [r.rolling_sum for r in windows.rolling_sum(ntz, ["k"], "at", "v", 7200).orderBy("i").collect()]
        inside = joins.point_in_window(ntz, edges, ["k"], "at", "lo", "hi", 3600).count()
        return gaps, sums, inside, [r[0] for r in text.select(F.unix_seconds(parse_ts(F.col("s")))).collect()]

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        first = seen()
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert seen() == first == ([None, 7200], [1, 2], 2, [1719828000, 1719792000, 1719828000, 1719828000, None, None])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_contained_ranges_of_a_large_key(spark, monkeypatch):
    outer = spark.createDataFrame([("a", 10 * i, 10 * i + 6) for i in range(30)], "k string, lo int, hi int")
    inner = spark.createDataFrame([("a", x, x + 3) for x in range(0, 320, 3)] + [("z", 1, 2)], "k string, a int, b int")
    want = [(r.k, r.a, r.inside) for r in registry.contained_in(inner, outer, ["k"], "a", "b").orderBy("k", "a").collect()]
    assert want == [("a", x, x % 10 <= 3 and x < 300) for x in range(0, 320, 3)] + [("z", 1, False)]


def test_canonical_matches_by_key(spark):
    aliases = spark.createDataFrame([("Côte d'Ivoire", "Ivory Coast"), ("cote d ivoire", "Ivorians"), ("!", "None")], "v string, c string")
    got = joins.canonical(spark.createDataFrame([("COTE D'IVOIRE",), ("Peru",), ("?",), (None,)], "n string"), "n", aliases, "v", "c").collect()
    assert {r.n: r.canonical for r in got} == {"COTE D'IVOIRE": "Ivorians", "Peru": "Peru", "?": "?", None: None}


def test_equal_intervals_in_any_sequence(spark, monkeypatch):
    def unlucky(df, *rest):
        """Rows that tie come in the sequence that a window may give them: those that join what is before them first."""
        last = [F.col(c).desc() if c == "_joins" else F.col(c) for c in df.columns if c in ("_new", "_joins")]
        return scan(df.coalesce(1).sortWithinPartitions(*last) if last else df, *rest)

    df = spark.createDataFrame([("a", 0, 5), ("a", 8, 9), ("a", 8, 9), ("a", 20, 20), ("a", 20, 20), ("a", 20, 21)], "k string, lo int, hi int")
    for module in (windows, catalog):
        monkeypatch.setattr(module, "scan", unlucky)
    want = [("a", 0, 5, 1), ("a", 8, 9, 2), ("a", 20, 21, 3)]
    assert sorted(map(tuple, windows.merge_intervals(df, ["k"], "lo", "hi").collect())) == want
    members = catalog.merge_members(df, ["k"], "lo", "hi").groupBy("k", "merged").agg(F.min("lo"), F.max("hi"), F.count("*")).drop("merged")
    assert sorted(map(tuple, members.collect())) == want


def test_equal_intervals_are_ordered_once(spark, monkeypatch):
    """Copies of an interval are one row before they are cut in segments; those that don't join each other stay apart."""
    rows = [("a", i % 9 * 10, i % 9 * 10 + 3 + i % 2) for i in range(400)] + [("a", 95, 91)] * 3 + [("a", None, -2)] * 3 + [("a", None, None)] * 2 + [("a", 99, None)] * 2 + [("b", 1, 2)] * 2
    df = spark.createDataFrame(rows, "k string, lo int, hi int")
    cut = []

    def counted(df, *rest):
        cut.append(df.count())
        return scan(df, *rest)

    monkeypatch.setattr(windows, "scan", counted)
    want = [("a", x, x + 4, len([r for r in rows if r[1] == x])) for x in range(0, 90, 10)] + [("a", 95, 91, 1)] * 3 + [("a", None, -2, 1)] * 3 + [("a", None, None, 1)] * 2 + [("a", 99, None, 1)] * 2 + [("b", 1, 2, 2)]
    for n in (ROWS, scans.SEGMENT_ROWS):
        assert rows_of(windows.merge_intervals(df, ["k"], "lo", "hi", n).select("k", "lo", "hi", "members")) == sorted(str(r) for r in spark.createDataFrame(want, "k string, lo int, hi int, members long").collect())
    assert cut == [29, 29, len(rows), len(rows)]


def test_segments_are_bounded(spark, ticks, monkeypatch):
    monkeypatch.setattr(scans, "MOST_SEGMENTS", 5)
    assert scans.segments(ticks, ["k"], ["t", "i"], scans.large_keys(ticks, ["k"], 1), 1).select("_segment").distinct().count() == 5
    for f in (lambda n: windows.locf(ticks, ["k"], ["t", "i"], ["v"], n), lambda n: windows.merge_intervals(ticks.where("hi IS NOT NULL"), ["k"], "t", "hi", n)):
        assert rows_of(f(1)) == rows_of(f(scans.SEGMENT_ROWS))

"""Books replayed from a stream: equal to a replay in order, whatever the order of arrival, and across a restart."""

import json
import random
from decimal import Decimal

import pytest

from millrace.streaming import books

NAMES = [c.split()[0] for c in books.EVENT.split(", ")]


def events(n=260, seed=4):
    draw, rows = random.Random(seed), []
    side = lambda lo, hi: json.dumps([[f"0.{p}", str(draw.randrange(1, 9))] for p in draw.sample(range(lo, hi), draw.randrange(0, 4))])
    for i in range(n):
        at = 10_000 + i * 100
        kind = draw.choice(["price_change"] * 6 + ["book", "last_trade_price", "tick_size_change"])
        row = {"token": draw.choice("abc"), "event_type": kind, "received": at, "source": at - draw.randrange(0, 90), "sequence": i}
        if kind == "book":
            row |= {"bids": side(10, 40), "asks": side(60, 90)}
        elif kind == "price_change":
            buy = draw.random() < 0.5
            row |= {"price": f"0.{draw.randrange(30, 36) if buy else draw.randrange(64, 70)}", "size": draw.choice(["0", "5", "2.50"]), "side": "BUY" if buy else "SELL"}
        elif kind == "last_trade_price":
            row |= {"price": "0.5", "size": "3", "side": "BUY"}
        rows.append(row)
    for i, bad in ((40, {"price": "abc"}), (60, {"side": "MID"}), (80, {"source": 10**9}), (90, {"event_type": "book", "bids": '[["0.2","1"],["0.2","1"]]'}), (120, {"event_type": "price_change", "price": "0.95", "size": "1", "side": "BUY"}), (121, {"event_type": "book", "bids": "[]", "asks": "[]"})):
        rows[i] |= bad
    return [{c: r.get(c) for c in NAMES} for r in rows]


SEEDS = [("a", '[["0.31","7"]]', '[["0.69","7"],["0.7","1"]]'), ("b", "[]", "[]")]
WINDOWS = [("a", "w1", 12_000, 20_000), ("a", "w2", 18_000, 30_000), ("b", "w1", 0, 10**9), ("z", "w9", 0, 1)]


def brute(rows):
    """The rules again, over whole lists, with the levels of a side in a plain dictionary."""
    out, state = [], {t: ({}, {}) for t in "abc"}
    state["a"] = ({Decimal("0.31"): Decimal(7)}, {Decimal("0.69"): Decimal(7), Decimal("0.7"): Decimal(1)})
    for r in sorted(rows, key=lambda r: (r["received"], r["source"], r["sequence"])):
        bids, asks = ({**x} for x in state[r["token"]])
        issue, kind = None, r["event_type"]
        if r["received"] < r["source"]:
            issue = "times"
        elif kind == "book":
            sides = [json.loads(r[c] or "[]") for c in ("bids", "asks")]
            if any(len({p for p, _ in x}) < len(x) for x in sides):
                issue = "levels"
            else:
                bids, asks = ({Decimal(p): Decimal(s) for p, s in x} for x in sides)
        elif kind == "price_change":
            try:
                price = Decimal(r["price"])
                side = {"BUY": bids, "SELL": asks}[r["side"]]
                side[price] = Decimal(r["size"])
                if not side[price]:
                    del side[price]
            except (ArithmeticError, KeyError):
                issue = "price_change"
        if issue is None:
            state[r["token"]] = (bids, asks)
            if kind in ("book", "price_change") and bids and asks and max(bids) > min(asks):
                issue = "crossed"
        if issue:
            out.append(("issue", r["token"], None, r["sequence"], issue))
            continue
        for t, name, lo, hi in WINDOWS:
            if t == r["token"] and lo <= r["received"] < hi and kind in ("book", "price_change", "last_trade_price"):
                out.append(("trade", t, name, r["sequence"], r["price"]) if kind == "last_trade_price" else ("snapshot", t, name, r["sequence"], (sorted(bids.items(), reverse=True), sorted(asks.items()))))
    return sorted(out, key=str)


def seen(rows):
    book = lambda text: [(Decimal(p), Decimal(s)) for p, s in json.loads(text)]
    what = {"issue": lambda r: r.issue, "trade": lambda r: r.price, "snapshot": lambda r: (book(r.bids), book(r.asks))}
    return sorted(((r.kind, r.token, r.window_id, r.sequence, what[r.kind](r)) for r in rows), key=str)


def test_rules_equal_brute_force():
    rows, out = events(900, 8), []
    for t in "abc":
        book = books.Book(*next((s[1:] for s in SEEDS if s[0] == t), (None, None)))
        mine = sorted((r for r in rows if r["token"] == t), key=books._order)
        found = books.replay(t, book, mine, [(n, lo, hi) for x, n, lo, hi in WINDOWS if x == t])
        out += [type("Row", (), dict(zip([c.split()[0] for c in books.OUT.split(", ")], r, strict=True))) for r in found]
    assert seen(out) == brute(rows)
    assert {r.issue for r in out if r.kind == "issue"} == {"price_change", "times", "levels", "crossed"}


def test_stream_equals_brute_force_and_resumes(spark, tmp_path):
    draw, rows = random.Random(1), events()
    files = [rows[i : i + 65] for i in range(0, len(rows), 65)]
    late = [draw.sample(x, len(x)) for x in files]  # within a file events arrive in any order
    late[1].append(late[0].pop())  # and one arrives a file later
    end = {c: None for c in NAMES} | {"token": "c", "event_type": "tick_size_change", "received": 10**7, "source": 1, "sequence": 10**6}
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    books.use_rocksdb(spark)
    try:
        for i, part in enumerate([*late, [end]]):
            frame = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in part], books.EVENT)
            frame.coalesce(1).write.mode("append").parquet(source)
            stream = books.stream_books(
                spark.readStream.schema(books.EVENT).parquet(source), spark.createDataFrame(SEEDS, "token string, bids string, asks string"),
                spark.createDataFrame(WINDOWS, "token string, window_id string, lo long, hi long"), "20 seconds",
            )
            # each run starts anew from the checkpoint, as after a crash
            query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
            assert query.awaitTermination(120), i
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    assert seen(spark.read.parquet(out).collect()) == brute(rows)


@pytest.mark.parametrize("text", ["x", '[["a","1"]]', '[["2","1"]]', '[["0.1","-1"]]', '[["0.1"]]', "3"])
def test_malformed_sides(text):
    assert books._levels(text) is None


def test_tokens_share_the_keys_of_state(spark, tmp_path):
    """A call into Python a bucket, not a token; also a token that is null, and windows only of some."""
    rows = [{c: None for c in NAMES} | {"token": None if t == 0 else f"t{t}", "event_type": "price_change", "received": 1000 + i, "source": 1000, "sequence": i, "price": f"0.{t + 10}", "size": str(i + 1), "side": "BUY"} for t in range(40) for i in range(3)]
    end = {c: None for c in NAMES} | {"token": "t1", "event_type": "end", "received": 10**7, "source": 1, "sequence": 9}
    kept, buckets = spark.conf.get("spark.sql.streaming.stateStore.providerClass"), books.BUCKETS
    books.use_rocksdb(spark)
    try:
        books.BUCKETS = 3
        spark.createDataFrame([tuple(r[c] for c in NAMES) for r in [*rows, end]], books.EVENT).write.parquet(str(tmp_path / "in"))
        seeds = spark.createDataFrame([("t2", '[["0.5","1"]]', "[]"), ("t90", "[]", "[]")], "token string, bids string, asks string")
        spans = spark.createDataFrame([(f"t{t}", "w", 1001, 1003) for t in range(1, 30)], "token string, window_id string, lo long, hi long")
        stream = books.stream_books(spark.readStream.schema(books.EVENT).parquet(str(tmp_path / "in")), seeds, spans, "1 second")
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        timers = [p.stateOperators[0].customMetrics["numRegisteredTimers"] for p in query.recentProgress if p.stateOperators]
        assert 0 < max(timers) <= 3
    finally:
        books.BUCKETS = buckets
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    got = sorted((r.token, r.sequence, r.levels) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((f"t{t}", i, 2 if t == 2 else 1) for t in range(1, 30) for i in (1, 2))

"""Payloads as tables: nothing is lost, whatever the JSON holds."""

import datetime as dt
import json

from millrace.operators import payloads as P


def test_pages(spark):
    event = {"id": 7, "title": "Ａ  game\r\n", "volume": "12.5", "markets": [{"id": "m1", "conditionId": "c1"}, {"id": "m2"}, {"no": 1}, "x"]}
    pages = [
        ("c", "events_open", 1, json.dumps({"events": [event, {"id": "8", "markets": "bad"}, 5, {"title": "no id"}]})),
        ("c", "events_closed", 1, json.dumps({"events": [{"id": "7", "title": "later", "slug": "seven"}]})),
        ("c", "markets_open", 1, json.dumps({"markets": [{"id": "m1", "question": "Who?", "condition_id": "c2", "events": [{"id": "7"}, {"id": "9", "title": "nine"}]}]})),
        ("c", "markets_closed", 1, json.dumps({"markets": {}})), ("c", "markets_closed", 2, "{"), ("c", "markets_closed", 3, "[1]"), ("c", "other", 1, "{}"), ("c", "markets_closed", 4, "{}"), ("c", None, 1, None), ("c", "markets_open", 2, None),
    ]
    events, markets, edges, issues = P.normalize_pages(spark.createDataFrame(pages, "crawl_id string, pass_name string, page_number int, payload_json string"))
    e = {r.event_id: r for r in events.collect()}
    assert set(e) == {"7", "8", "9"} and e["9"].title == "nine"
    assert (e["7"].title, e["7"].slug, e["7"].volume, e["7"].mentions) == ("later", "seven", 12.5, 3)  # events_closed comes before events_open
    m = {r.market_id: r for r in markets.collect()}
    assert {k: (r.title, r.condition_id, r.versions) for k, r in m.items()} == {"m1": ("Who?", "c2", 2), "m2": (None, None, 0)}
    assert {(r.event_id, r.market_id): r.evidence for r in edges.collect()} == {("7", "m1"): "events_endpoint,markets_endpoint", ("7", "m2"): "events_endpoint", ("9", "m1"): "markets_endpoint"}
    got = {(r["pass"], r.issue): r.rows for r in issues.collect()}
    assert got == {
        ("events_open", "row"): 1, ("events_open", "id"): 1, ("events_open", "nested"): 3, ("markets_closed", "array"): 1, ("markets_closed", "json"): 1, ("markets_closed", "object"): 1, ("other", "pass"): 1, ("", "pass"): 1, ("markets_open", "json"): 1,
    }


def test_memberships(spark):
    event = {"id": "e1", "markets": [{"id": "a", "events": [{"id": "e9"}, {"id": "e1"}, {"id": "e9"}]}, {"id": 5, "events": None}, {"id": "b", "events": [{"x": 1}, {"id": "e2"}]}, {"question": "no id"}, 3]}
    df = spark.createDataFrame([(1, json.dumps(event)), (2, "nope"), (3, json.dumps({"id": "e3", "markets": "x"})), (4, json.dumps({"markets": []})), (5, None)], "n int, payload_json string")
    got = sorted((r.market_id, r.member_event_id, r.source_ordinal, r.is_enclosing_event) for r in P.explode_event_payload(df).collect())
    assert got == [("5", "e1", 0, True), ("a", "e1", 1, True), ("a", "e9", 0, False), ("b", "e1", 1, True), ("b", "e2", 1, False)]
    assert tuple(P.bad_payloads(df).first()) == (5, 2, 1, 1)


def test_markets(spark):
    rows = [
        {"id": 1, "question": " Q ", "conditionId": "0xA", "outcomes": ["Yes", "No"], "clobTokenIds": '["1","2"]', "volumeNum": 3, "active": True, "closed": "false", "createdAt": "2026-06-01T10:00:00.1234567Z", "endDateIso": "2026-07-01", "game_start_time": 1780000000, "events": [{"id": "x"}, {"id": "y", "slug": "s", "is_enclosing_event": True}], "resolved": "true", "line": "NaN"},
        {"id": "2", "sports_market_type": "moneyline", "volume": "n/a", "createdAt": "2026-06-01 12:00:00+02:00", "endDate": "soon", "gameStartTime": "1780000000123", "events": [{"id": "x"}]},
        {"question": "no id"},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("[]",), (None,)], "payload_json string")
    got = P.normalize_markets(df).collect()
    one, two = got[0], got[1]
    assert (one.question, one.condition_id, one.outcomes, one.clob_token_ids, one.volume, one.active, one.closed, one.event_id, one.event_slug, one.is_resolved, one.line) == ("Q", "0xA", '["Yes","No"]', '["1","2"]', 3.0, True, False, "y", "s", True, None)
    assert (one.created_at, one.end_date, one.game_start_time) == (dt.datetime(2026, 6, 1, 10, 0, 0, 123456), dt.datetime(2026, 7, 1), dt.datetime(2026, 5, 28, 20, 26, 40))
    assert (two.sports_market_type, two.volume, two.created_at, two.end_date, two.game_start_time, two.event_id, two.is_resolved) == ("moneyline", None, dt.datetime(2026, 6, 1, 10), None, dt.datetime(2026, 5, 28, 20, 26, 40), "x", False)
    assert [r.market_id for r in got] == ["1", "2", None, None, None]


def test_candles(spark):
    candles = [{"end_period_ts": 7200, "price": {"open_dollars": "0.41", "mean_dollars": "x"}, "volume_fp": "2.50", "volume": 9}, {"end_period_ts": "10800", "price": None, "volume_fp": "", "volume": "3.49"}, {"price": {}}, 4]
    df = spark.createDataFrame([("T", json.dumps(candles)), ("U", "{}"), ("V", None)], "market_ticker string, candles_json string")
    got = [(r.market_ticker, r.hour_start_utc, r.open_price, r.avg_price, r.volume) for r in P.normalize_candles(df).orderBy("hour_start_utc").collect()]
    assert got == [("T", dt.datetime(1970, 1, 1, 1), 0.41, None, 3), ("T", dt.datetime(1970, 1, 1, 2), None, None, 3)]


def test_admitted(spark):
    rows = [("m", 1, '{"id":"m","question":"old"}'), ("m", 2, '{"id":"m","question":"new"}'), ("x", 1, '{"id":"x"}'), ("n", 1, "{")]
    df = spark.createDataFrame(rows, "market string, seen int, payload_json string")
    got = P.admitted_markets(df, spark.createDataFrame([("m",), ("n",), ("m",)], "market string"), "market", "seen").collect()
    assert [(r.market_id, r.question, r.seen) for r in got] == [("m", "new", 2)]

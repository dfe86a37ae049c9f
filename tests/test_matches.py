"""Matching, plans and minute bands on fixtures of known outcome."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from millrace.operators import matches

T = dt.datetime(2026, 6, 11, 19)
MARKET = "market_id string, event_id string, sports_market_type string, group_item_title string, outcomes string, clob_token_ids string, event_start_time timestamp_ntz, event_finished_time timestamp_ntz, event_ended boolean, closed boolean"


def later(minutes):
    return T + dt.timedelta(minutes=minutes)


def test_mutual_match_equals_brute_force(spark):
    draw = random.Random(2)
    side = lambda n: [(i, draw.choice(["x", "y", None]), draw.choice(["x", "z"]), None if draw.random() < 0.1 else T + dt.timedelta(seconds=draw.randrange(4000))) for i in range(n)]
    a, b = side(60), side(50)
    schema = "{0}i int, {0}h string, {0}w string, {0}t timestamp_ntz"
    got = {r.ai: (r.bi, r.reason) for r in matches.mutual_match(spark.createDataFrame(a, schema.format("a")), spark.createDataFrame(b, schema.format("b")), "ai", "bi", ("ah", "aw"), ("bh", "bw"), "at", "bt", 90).collect()}
    close = lambda x, y: None not in (*x, *y) and {x[1], x[2]} == {y[1], y[2]} and abs((x[3] - y[3]).total_seconds()) <= 90
    for x in a:
        good = [y for y in b if close(x, y)]
        want = (None, "incomplete") if None in x else (None, "none") if not good else (None, "many") if len(good) > 1 else (None, "taken") if sum(close(o, good[0]) for o in a) > 1 else (good[0][0], None)
        assert got[x[0]] == want
    assert {r for _, r in got.values()} == {None, "incomplete", "none", "many", "taken"}


def markets(event, home, away, start=T, n=3, ended=True, finish=None):
    titles = [home, f"Draw ({home} v {away})", away][:n]
    return [(f"{event}-{i}", event, "moneyline", t, '["Yes","No"]', json.dumps([f"{event}{i}y", f"{event}{i}n"]), start, finish or start + dt.timedelta(hours=2), ended, True) for i, t in enumerate(titles)]


def advance(name, x, y, start=T, tokens=None):
    return [(name, f"e-{name}", "soccer_team_to_advance", None, json.dumps([x, y]), json.dumps(tokens or [f"{name}x", f"{name}y"]), start, None, None, True)]


def test_plan_and_working_set(spark):
    rows = (
        markets("g1", "Côte d'Ivoire", "Peru") + markets("k1", "Chile", "Ghana", later(300)) + markets("two", "A", "B", n=2) + markets("open", "C", "D", ended=False) + markets("one", "E", "E")
        + markets("d1", "F", "G") + markets("d2", "G", "F") + markets("back", "H", "I", finish=T - dt.timedelta(hours=1)) + advance("adv", "Ghana", "Chile", later(301)) + advance("far", "Chile", "Ghana", later(330)) + advance("bad", "Peru", "Cote d Ivoire", tokens=["q", "q"])
    )
    rows += [("t1", "g9", "moneyline", "J", '["No","Yes"]', '["s1","s2"]', T, later(120), True, True), ("t2", "g9", "moneyline", "K", '["No","Yes"]', '["s1","s3"]', T, later(120), True, True), ("t3", "g9", "moneyline", "draw", '["Up","Down"]', '["s4","s5"]', T, later(120), True, True)]
    df = spark.createDataFrame(rows, MARKET)
    plans, left_out = matches.match_plan(df)
    got = sorted({(r.market_id, r.event_id, r.stage) for r in plans.collect()})
    assert got == [("adv", "k1", "knockout")]  # g1 lends its clock to "bad", whose tokens are equal
    why = {r.market_id: r.reasons for r in left_out.collect()}
    assert why == {
        "two-0": "moneylines", "two-1": "moneylines,teams", "open-0": "timing", "open-1": "timing", "open-2": "timing", "one-0": "teams", "one-1": "teams", "one-2": "teams", "d1-0": "duplicate_event", "d1-1": "duplicate_event", "d1-2": "duplicate_event",
        "d2-0": "duplicate_event", "d2-1": "duplicate_event", "d2-2": "duplicate_event", "back-0": "timing", "back-1": "timing", "back-2": "timing", "far": "event_none", "bad": "tokens", "t3": "outcomes", "t1": "shared_token", "t2": "shared_token",
    } | {"two-0": "moneylines,teams"}
    plans, left_out = matches.match_plan(df.where("market_id != 'bad'"))
    fixtures = spark.createDataFrame([(1, "Peru", "Cote d'Ivoire", later(600)), (2, "Chile", "Ghana", later(0)), (3, "Nobody", "Else", T)], "fixture_id int, home_team string, away_team string, kickoff_at timestamp_ntz")
    found, lost = matches.working_set(plans, df, fixtures)
    table = {r.market_id: (r.fixture_id, r.proposition, r.yes_token_id, r.no_token_id) for r in found.collect()}
    assert table == {"g1-0": (1, "away_win", "g10y", "g10n"), "g1-1": (1, "draw", "g11y", "g11n"), "g1-2": (1, "home_win", "g12y", "g12n"), "adv": (2, "home_advances", "advy", "advx")}
    assert lost.count() == 0
    again = fixtures.union(spark.createDataFrame([(4, "Ghana", "Chile", T)], fixtures.schema))
    assert {(r.event_id, r.reason) for r in matches.working_set(plans, df, again)[1].collect()} == {("k1", "many")}


def test_registry(spark):
    market = lambda e, i, title, tokens='["a","b"]': (f"{e}{i}", e, title, '["Yes","No"]', tokens, "moneyline", T if e == "m" else None)
    rows = [market(e, i, t) for e in ("ok", "m", "new", "no") for i, t in enumerate(("Alpha FC", "Draw", "Beta United"))] + [market("few", 0, "Alpha FC"), *(market("tok", i, t, '["a"]') for i, t in enumerate(("Alpha FC", "Draw", "Beta United")))]
    m = spark.createDataFrame(rows, "market_id string, event_id string, group_item_title string, outcomes string, clob_token_ids string, sports_market_type string, game_start_time timestamp_ntz")
    title = "Alpha FC vs. Beta United"
    e = [("ok", title, T, later(115), True), ("m", f"{title} - More", None, None, True), ("new", title, later(6000), None, True), ("no", title, None, None, True), ("few", title, T, later(90), True), ("tok", title, T, later(90), True), ("who", "Winner?", T, later(90), True), ("none", title, T, later(9), True)]
    events = spark.createDataFrame(e, "event_id string, event_title string, event_start_at timestamp_ntz, finished_at timestamp_ntz, is_closed boolean")
    good, bad = matches.match_registry(events, m, F.lit(later(1000)).cast("timestamp_ntz"))
    rows = {(r.event_id, r.result_role): r for r in good.collect()}
    assert set(rows) == {(x, r) for x in ("ok", "m") for r in ("home_win", "draw", "away_win")}
    assert rows["ok", "draw"].timing_status == "finished" and (rows["m", "draw"].timing_status, rows["m", "draw"].kickoff_source, rows["m", "draw"].window_end_at) == ("inferred", "market_game_start", later(120))
    assert {r.event_id: r.reason for r in bad.collect()} == {"new": "finish", "no": "kickoff", "few": "roles", "tok": "tokens", "who": "title", "none": "roles"}


def test_minute_bands(spark):
    at = lambda m, s=0, us=0: T + dt.timedelta(minutes=m, seconds=s, microseconds=us)
    p = [("m", "1H", 1, 45, at(0), at(47, 10)), ("m", "2H", 46, 90, at(62, 7), at(107, 7, 900)), ("n", "1H", 1, 45, at(0), at(40)), ("o", "ET1", 91, 105, at(0), at(15, 30))]
    periods = spark.createDataFrame(p, "match_id string, period string, first_minute int, last_minute int, started_at timestamp_ntz, ended_at timestamp_ntz")
    events = spark.createDataFrame([("m", "1H", 45, 2), ("m", "1H", 30, 9), ("m", "2H", 90, None), ("o", "ET1", 105, 1)], "match_id string, period string, match_minute int, stoppage_minute int")
    rows = matches.minute_bands(periods, events).collect()
    assert [(r.match_id, r.issue, r.band_start) for r in rows if r.issue] == [("n", "too_short", None)]
    for (m, period, first, last, lo, hi), labels in zip(p, (["45+1", "45+2", "45+3"], [], None, ["105+1"]), strict=True):
        mine = sorted((r for r in rows if (r.match_id, r.period) == (m, period) and not r.issue), key=lambda r: r.band_start)
        if labels is None:
            assert not mine
            continue
        assert [r.label for r in mine] == [*map(str, range(first, last + 1)), *labels]
        assert mine[0].band_start == lo and mine[-1].band_end == hi and all(a.band_end == b.band_start for a, b in zip(mine, mine[1:], strict=False))

"""Catalog rules on small tables of known outcome."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import catalog

LEDGER = "market_id string, field_name string, reason string, attempts long, last_checked_at timestamp_ntz, next_retry_at timestamp_ntz"


def test_unresolved_fields_are_tried_again_later(spark):
    now, later = dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 9)
    old = dt.datetime(2025, 12, 1)
    ledger = spark.createDataFrame([("a", "event_slug", "none", None, old, old), ("b", "event_slug", "none", 4, old, old)], LEDGER)
    batch = spark.createDataFrame([("a", "event_slug", "gone"), ("a", "event_slug", "absent"), ("c", "slug", "blank")], "market_id string, field_name string, reason string")
    at = F.lit(now.isoformat()).cast("timestamp_ntz")
    got = {(r.market_id, r.field_name): tuple(r)[2:] for r in catalog.mark_unresolved(ledger, batch, ["market_id", "field_name"], at).collect()}
    assert got == {("a", "event_slug"): ("gone", 1, now, later), ("b", "event_slug"): ("none", 4, old, old), ("c", "slug"): ("blank", 1, now, later)}
    assert catalog.mark_unresolved(ledger.limit(0), batch.limit(0), ["market_id", "field_name"], at).count() == 0


def test_digests_of_rows_in_any_order(spark):
    rows = [(1, "a", None), (1, "b", ""), (1, "a", None), (2, "a", ""), (2, "b", ""), (2, "a", "")]
    df = spark.createDataFrame(rows, "k int, x string, y string")
    got = {r.k: r.digest for r in catalog.multiset_digest(df, ["k"], ["x", "y"]).collect()}
    assert got == {r.k: r.digest for r in catalog.multiset_digest(df.orderBy(F.desc("x")).repartition(5), ["k"], ["x", "y"]).collect()}
    assert got[1] != got[2]  # a null is not an empty text
    once = catalog.multiset_digest(df.distinct().where("k = 1"), [], ["x", "y"]).first()
    assert once.n_rows == 2 and once.digest != got[1]
    assert catalog.multiset_digest(df.limit(0), ["k"], ["x"]).count() == 0


def test_roles_of_odd_questions(spark):
    cases = [("moneyline", "DRAW ", None, "draw"), ("MoneyLine", "Málaga", None, "home_win"), ("moneyline", "", "Will Malaga beat Real Betis", "home_win"), (None, "Draw", "Will Real Betis vs Málaga end in a draw?", "draw"),
             ("moneyline", "Other", "will REAL BETIS beat malaga?", "away_win"), ("totals", "Málaga", "Will Málaga score?", None), (None, None, None, None), (None, None, "Will Málaga beat Sevilla?", None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, kind string, label string, question string, want string")
    got = df.select("i", "want", catalog.market_role_of(F.col("kind"), F.col("label"), F.col("question"), F.lit("Málaga"), F.lit("Real Betis")).alias("role")).collect()
    assert [(r.i, r.role) for r in got] == [(r.i, r.want) for r in got]


def test_metadata_that_waits_for_its_retry(spark):
    markets = spark.createDataFrame([("a", None, "", "x"), ("b", "2026", None, None), ("c", "2026", "e", "s"), ("d", "2026", "", "s")], "id string, end_date string, event_slug string, slug string")
    tokens = spark.createDataFrame([("a",), ("b",), ("b",), ("d",)], "id string")
    unresolved = spark.createDataFrame([("d", "event_slug", 11), ("a", "event_slug", 10), ("b", "slug", 99)], "id string, field_name string, next_retry_at int")
    got = {r.id: r.missing for r in catalog.missing_metadata(markets, tokens, unresolved, "id", F.lit(10)).collect()}
    assert got == {"a": "end_date,event_slug", "b": "event_slug,slug", "c": "tokens"}

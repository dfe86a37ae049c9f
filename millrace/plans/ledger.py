"""Queries of the ledger, rule and book operators over the driver tables, each with its SQL. Every query reads its tables whole.

events stands for ticks and runs, customer for the token catalog, orders for its observations and lineitem for book changes and logs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators import bars, books, joins, ledger, rules
from millrace.plans.market import OHLC_SQL, _t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _at(*args):
    return F.lit(dt.datetime(*args)).cast("timestamp_ntz")


def _epoch(c):
    return floor_epoch(F.col(c), 1)


# Ticks arrive up to 29 hours late, each fiftieth without a time of arrival.
TICKS_SQL = "SELECT *, CASE WHEN event_id % 50 <> 0 THEN ts + to_hours((event_id % 30)::INT) END AS ingested_at FROM events"
FULL_SQL = OHLC_SQL.format(key="user_id", ts="ts", p="value", t="k", s=3600).replace(" FROM k", ", max(ingested_at) AS latest_ingested_at FROM k")


def _ticks(spark, d):
    late = F.when(F.col("event_id") % 50 != 0, F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 30).cast("int")))
    return _t(spark, d, "events").withColumn("ingested_at", late)


@query(f"WITH k AS ({TICKS_SQL}) {FULL_SQL}")
def late_bars_hourly(spark, d):
    """Bars of the ticks that had arrived by a day, brought up to date by time of arrival; equal to a full build."""
    ticks = _ticks(spark, d)
    target = bars.ohlc(ticks.where(F.col("ingested_at") < _at(2024, 1, 12)), ["user_id"], "ts", "value", 3600, F.max("ingested_at").alias("latest_ingested_at"))
    return bars.incremental_ohlc(target, ticks, ["user_id"], "ts", "value", "ingested_at", 3600, 7200)


@query(f"WITH b AS ({OHLC_SQL.format(key='user_id', ts='ts', p='value', t='events', s=60)}) SELECT *, bucket + 60 - epoch_us(last_observed_at) // 1000000 AS close_age_seconds FROM b")
def release_minutes(spark, d):
    return bars.ohlc_release(_t(spark, d, "events"), ["user_id"], "ts", "value", 60)


@query(f"""WITH b AS ({OHLC_SQL.format(key='event_type', ts='ts', p='value', t='events', s=3600)}) SELECT event_type, bucket,
 CASE WHEN event_type = 'error' THEN 1 - open_price ELSE open_price END AS open_price, CASE WHEN event_type = 'error' THEN 1 - low_price ELSE high_price END AS high_price,
 CASE WHEN event_type = 'error' THEN 1 - high_price ELSE low_price END AS low_price, CASE WHEN event_type = 'error' THEN 1 - close_price ELSE close_price END AS close_price, observed_points FROM b""")
def progression_bars(spark, d):
    hours = bars.ohlc(_t(spark, d, "events"), ["event_type"], "ts", "value", 3600)
    return bars.progression_side(hours, F.col("event_type") == "error").select("event_type", "bucket", "open_price", "high_price", "low_price", "close_price", "observed_points")


MINUTES_SQL = """m AS (SELECT user_id, event_id, ts AS lo, ts + INTERVAL 1 HOUR AS hi FROM events WHERE event_type = 'error'),
 s AS (SELECT *, unnest(generate_series(epoch_us(lo) // 60000000 * 60, epoch_us(hi) // 60000000 * 60, 60)) AS bucket FROM m),
 y AS (SELECT user_id, epoch_us(ts) // 60000000 * 60 AS bucket, arg_max(value, struct_pack(a := ts, b := value)) AS yes_close_price FROM events WHERE event_type = 'click' AND value IS NOT NULL GROUP BY ALL),
 n AS (SELECT user_id, epoch_us(ts) // 60000000 * 60 AS bucket, arg_max(value, struct_pack(a := ts, b := value)) AS no_close_price FROM events WHERE event_type = 'view' AND value IS NOT NULL GROUP BY ALL),
 j AS (SELECT *, yes_close_price IS NOT NULL AND no_close_price IS NOT NULL AS complete FROM s LEFT JOIN y USING (user_id, bucket) LEFT JOIN n USING (user_id, bucket)),
 r AS (SELECT user_id, event_id, bucket, yes_close_price, no_close_price, CASE WHEN complete THEN 'both_observed' WHEN yes_close_price IS NOT NULL THEN 'yes_only' WHEN no_close_price IS NOT NULL THEN 'no_only' ELSE 'no_fills' END AS fill_status,
 CASE WHEN complete THEN 'complete' WHEN bucket = epoch_us(lo) // 60000000 * 60 THEN 'start_boundary_incomplete' WHEN bucket = epoch_us(hi) // 60000000 * 60 THEN 'finish_boundary_incomplete' ELSE 'interior_incomplete' END AS minute_status,
 abs(yes_close_price + no_close_price - 1) AS deviation FROM j)"""


def _minutes(spark, d):
    e = _t(spark, d, "events")
    spine = bars.minute_spine(e.where("event_type = 'error'").select("user_id", "event_id", F.col("ts").alias("lo"), F.expr("ts + INTERVAL 1 HOUR").alias("hi")), "lo", "hi")
    side = lambda kind, name: bars.ohlc(e.where(F.col("event_type") == kind), ["user_id"], "ts", "value", 60).select("user_id", "bucket", F.col("close_price").alias(name))
    both = spine.join(side("click", "yes_close_price"), ["user_id", "bucket"], "left").join(side("view", "no_close_price"), ["user_id", "bucket"], "left")
    yes, no = F.col("yes_close_price"), F.col("no_close_price")
    fills = F.when(yes.isNotNull() & no.isNotNull(), "both_observed").when(yes.isNotNull(), "yes_only").when(no.isNotNull(), "no_only").otherwise("no_fills")
    status = bars.minute_status(yes.isNotNull() & no.isNotNull(), F.col("bucket"), F.col("lo"), F.col("hi"))
    return both.select("user_id", "event_id", "bucket", yes, no, fills.alias("fill_status"), status.alias("minute_status"), bars.pair_deviation(yes, no).alias("deviation"))


@query(f"WITH {MINUTES_SQL} SELECT * FROM r")
def match_minutes(spark, d):
    return _minutes(spark, d)


@query(f"WITH {MINUTES_SQL} SELECT user_id, count(*) AS minutes, count(*) FILTER (WHERE minute_status = 'complete') AS complete, count(*) FILTER (WHERE fill_status = 'no_fills') AS empty, count(*) FILTER (WHERE deviation > 0.05) AS anomalies FROM r GROUP BY 1")
def match_minute_quality(spark, d):
    n = lambda cond, name: F.count_if(F.coalesce(cond, F.lit(False))).alias(name)
    return _minutes(spark, d).groupBy("user_id").agg(F.count("*").alias("minutes"), n(F.col("minute_status") == "complete", "complete"), n(F.col("fill_status") == "no_fills", "empty"), n(F.col("deviation") > 0.05, "anomalies"))


LEDGER_SQL = """SELECT user_id, max(epoch_us(ts) // 1000000) AS cursor, max(ts) AS last_checked_at, CASE WHEN count(*) % 2 = 0 THEN max(ts) + INTERVAL 1 HOUR END AS next_check_at,
 nullif(count(*) % 3, 0) AS empty_run_streak, min(value) < 1 AS fully_checked FROM events WHERE event_type = '{kind}' GROUP BY 1"""


def _ledger(spark, d, kind):
    return _t(spark, d, "events").where(F.col("event_type") == kind).groupBy("user_id").agg(
        F.max(_epoch("ts")).alias("cursor"), F.max("ts").alias("last_checked_at"), F.expr("CASE WHEN count(*) % 2 = 0 THEN max(ts) + INTERVAL 1 HOUR END").alias("next_check_at"),
        F.expr("nullif(count(*) % 3, 0)").alias("empty_run_streak"), (F.min("value") < 1).alias("fully_checked"),
    )


@query(f"""WITH l AS ({LEDGER_SQL.format(kind='view')}), s AS ({LEDGER_SQL.format(kind='error')}), j AS (SELECT l, s, coalesce(l.user_id, s.user_id) AS user_id, l.user_id IS NULL AS fresh, s.user_id IS NULL AS old, coalesce(s.fully_checked, false) AS done FROM l FULL JOIN s ON l.user_id = s.user_id)
 SELECT user_id, greatest(l.cursor, s.cursor) AS cursor, coalesce(s.last_checked_at, l.last_checked_at) AS last_checked_at,
 CASE WHEN fresh THEN s.next_check_at WHEN old THEN l.next_check_at WHEN done THEN NULL ELSE coalesce(s.next_check_at, l.next_check_at) END AS next_check_at,
 CASE WHEN fresh THEN s.empty_run_streak WHEN old THEN l.empty_run_streak WHEN done THEN 0 ELSE coalesce(s.empty_run_streak, l.empty_run_streak, 0) END AS empty_run_streak,
 CASE WHEN fresh THEN s.fully_checked WHEN old THEN l.fully_checked ELSE coalesce(l.fully_checked, false) OR done END AS fully_checked FROM j""")
def merged_ledger(spark, d):
    return ledger.merge_ledger(_ledger(spark, d, "view"), _ledger(spark, d, "error"), "user_id")


@query(f"""WITH l AS ({LEDGER_SQL.format(kind='view')}), h AS (SELECT user_id, max(epoch_us(ts) // 1000000) AS last FROM events GROUP BY 1)
 SELECT user_id, greatest(cursor, last) AS cursor, last IS NOT NULL AND (cursor IS NULL OR last > cursor) AS repaired FROM h FULL JOIN l USING (user_id)""")
def reconciled_ledger(spark, d):
    return ledger.reconcile_ledger(_t(spark, d, "events"), _ledger(spark, d, "view"), "user_id", _epoch("ts"))


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def current_projection(spark, d):
    """What was current by 1998, refreshed by a batch that begins before that."""
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    refresh = lambda current, batch: ledger.refresh_current(current, batch, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    first = refresh(o.where(F.col("o_orderdate") < _at(1998, 1, 1)), o.limit(0))
    return refresh(first, o.where(F.col("o_orderdate") >= _at(1997, 7, 1))).select(o.columns)


DUE_SQL = """l AS (SELECT o_custkey AS k, bool_and(o_orderstatus <> 'O') AS fully_checked, CASE WHEN count(*) % 2 = 0 THEN max(o_orderdate) + INTERVAL 90 DAY END AS next_check_at FROM orders GROUP BY 1),
 r AS (SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'persisted_skip' WHEN coalesce(c_acctbal < 0, false) AND coalesce(fully_checked, false) THEN 'closed_done' WHEN next_check_at > TIMESTAMP '2000-01-01' THEN 'not_yet' ELSE 'due' END AS state FROM customer LEFT JOIN l ON c_custkey = k)"""


def _due(spark, d):
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    known = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_and(F.col("o_orderstatus") != "O").alias("fully_checked"), F.expr("CASE WHEN count(*) % 2 = 0 THEN max(o_orderdate) + INTERVAL 90 DAY END").alias("next_check_at"))
    return ledger.due_states(c.withColumn("closed", F.col("c_acctbal") < 0), known, c.where("c_nationkey = 3"), "c_custkey", _at(2000, 1, 1))


@query(f"WITH {DUE_SQL} SELECT c_custkey FROM r WHERE state = 'due'")
def due_tokens(spark, d):
    return _due(spark, d).where("state = 'due'").select("c_custkey")


@query(f"WITH {DUE_SQL} SELECT state, count(*) AS tokens FROM r GROUP BY 1")
def due_counts(spark, d):
    return _due(spark, d).groupBy("state").agg(F.count("*").alias("tokens"))


NOW = 946_684_800
PLAN_SQL = f"""t AS (SELECT o_custkey, min(epoch_us(o_orderdate) // 1000000) AS c, max(epoch_us(o_orderdate) // 1000000) FILTER (WHERE o_orderstatus = 'F') AS l, count(*) % 2 = 0 AS closed, bool_and(o_totalprice > 20000) AS full_, count(*) % 11 = 0 AS skip FROM orders GROUP BY 1),
 p AS (SELECT o_custkey, CASE WHEN l IS NULL THEN c ELSE greatest(c, l - 3600) END AS s, CASE WHEN skip THEN 'persisted_skip' WHEN closed AND full_ THEN 'closed_done' WHEN {NOW} - l < 86400 * 200 THEN 'recent_skip' WHEN s >= {NOW} THEN 'already_current' END AS reason FROM t),
 q AS (SELECT o_custkey, CASE WHEN reason IS NULL THEN s END AS start_ts, CASE WHEN reason IS NULL THEN {NOW}::BIGINT END AS end_ts, reason FROM p)"""


def _plans(spark, d):
    o = _t(spark, d, "orders").withColumn("_t", _epoch("o_orderdate"))
    tokens = o.groupBy("o_custkey").agg(
        F.min("_t").alias("created_ts"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("_t"))).alias("latest_ts"), (F.count("*") % 2 == 0).alias("closed"),
        F.bool_and(F.col("o_totalprice") > 20000).alias("fully_checked"), (F.count("*") % 11 == 0).alias("skipped"),
    )
    return ledger.plan_tokens(tokens, "o_custkey", NOW, 3600, 86_400 * 200)


@query(f"WITH {PLAN_SQL} SELECT * FROM q")
def token_plans(spark, d):
    return _plans(spark, d)


@query(f"WITH {PLAN_SQL}, g AS (SELECT *, (row_number() OVER (ORDER BY start_ts, end_ts - start_ts, o_custkey) - 1) // 20 AS group_no FROM q WHERE reason IS NULL) SELECT group_no, count(*) AS plans, min(start_ts) AS group_start, max(end_ts) AS group_end FROM g GROUP BY 1")
def plan_groups(spark, d):
    grouped = ledger.group_plans(_plans(spark, d).where("reason IS NULL"), "o_custkey", 20)
    return grouped.groupBy("group_no").agg(F.count("*").alias("plans"), F.min("start_ts").alias("group_start"), F.max("end_ts").alias("group_end"))


@query("""WITH w AS (SELECT l_orderkey, min(epoch_us(l_shipdate) // 1000000) AS lo, max(epoch_us(l_shipdate) // 1000000) AS hi FROM lineitem GROUP BY 1),
 c AS (SELECT l_orderkey, hi, unnest(range(lo, hi, 15552000)) AS chunk_lo FROM w) SELECT l_orderkey, chunk_lo, least(chunk_lo + 15552000, hi) AS chunk_hi FROM c""")
def chunked_windows(spark, d):
    w = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(_epoch("l_shipdate")).alias("lo"), F.max(_epoch("l_shipdate")).alias("hi"))
    return ledger.chunk_windows(w, "lo", "hi", 180 * 86_400).select("l_orderkey", "chunk_lo", "chunk_hi")


@query("""WITH r AS (SELECT user_id, min(epoch_us(ts) // 1000000) AS a, max(epoch_us(ts) // 1000000) AS z, count(*) FILTER (WHERE event_type = 'purchase') AS n, bool_or(event_type = 'error' AND value > 95) AS err, count(*) % 2 = 0 AS closed,
 count(*) % 7 AS streak, max(epoch_us(ts) // 1000000) FILTER (WHERE event_type = 'view') AS cont, max(epoch_us(ts) // 1000000) FILTER (WHERE event_type = 'click') AS upto FROM events GROUP BY 1),
 s AS (SELECT *, CASE WHEN err OR n > 8 THEN 0 ELSE streak + 1 END AS st FROM r)
 SELECT user_id, CASE WHEN err THEN CASE WHEN cont > a THEN cont WHEN n <= 8 AND upto > a THEN upto END WHEN n > 8 THEN z - 10 ELSE z END AS cursor,
 z + CASE WHEN err THEN 300 WHEN closed THEN NULL WHEN n > 8 THEN 3600 ELSE least(600 * (2 ** greatest(st - 1, 0))::BIGINT, 7200) END AS next_check, st AS empty_run_streak, closed AND NOT err AS fully_checked FROM s""")
def next_checks(spark, d):
    """Users as tokens; up to eight purchases count as an empty run."""
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("_t")))
    runs = _t(spark, d, "events").withColumn("_t", _epoch("ts")).groupBy("user_id").agg(
        F.min("_t").alias("start_ts"), F.max("_t").alias("end_ts"), F.max("_t").alias("checked_ts"), F.greatest(F.count_if(F.col("event_type") == "purchase") - 8, F.lit(0)).alias("rows_fetched"),
        F.bool_or((F.col("event_type") == "error") & (F.col("value") > 95)).alias("had_error"), (F.count("*") % 2 == 0).alias("is_closed"), (F.count("*") % 7).alias("empty_run_streak"),
        (F.max("_t") - 10).alias("max_seen_ts"), last("view").alias("contiguous_ts"), last("click").alias("checked_until_ts"),
    )
    return ledger.next_state(runs, "user_id", 3600, 600, 7200, 300)


@query("""WITH l AS (SELECT o_custkey, arg_max(struct_pack(e := o_totalprice < 150000, at := o_orderdate), struct_pack(a := o_orderdate, b := o_orderkey)) AS r FROM orders GROUP BY 1)
 SELECT o_custkey, r.at AS last_audit_at FROM l WHERE r.e AND r.at < TIMESTAMP '1999-06-01'""")
def terminal_empty(spark, d):
    return ledger.terminal_empty(_t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_totalprice") < 150000, "o_orderdate", _at(1999, 6, 1))


@query("""WITH w AS (SELECT o_custkey, epoch_us(o_orderdate) // 1000000 + o_orderkey % 48 * 1800 AS lo FROM orders)
 SELECT DISTINCT o_custkey, unnest(generate_series(lo // 3600 * 3600, (lo + 5400) // 3600 * 3600, 3600)) AS hour FROM w""")
def archive_hours(spark, d):
    w = _t(spark, d, "orders").select("o_custkey", (_epoch("o_orderdate") + F.col("o_orderkey") % 48 * 1800).alias("lo")).withColumn("hi", F.col("lo") + 5400)
    return ledger.hours_of(w, ["o_custkey"], "lo", "hi")


@query("""WITH v AS (SELECT o_custkey, substr(o_orderpriority, 1, 1)::INT AS priority, o_orderdate, o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS price, o_orderpriority FROM orders)
 SELECT o_custkey, arg_max(status, struct_pack(a := priority, b := o_orderdate, c := o_orderkey)) FILTER (WHERE status IS NOT NULL) AS status, arg_max(price, struct_pack(a := priority, b := o_orderdate, c := o_orderkey)) FILTER (WHERE price IS NOT NULL) AS price,
 string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS evidence FROM v GROUP BY 1""")
def merged_records(spark, d):
    v = _t(spark, d, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), "o_orderdate", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("price"), "o_orderpriority")
    return ledger.merge_records(v, "o_custkey", ["priority", "o_orderdate", "o_orderkey"], ["status", "price"], "o_orderpriority")


VIEWS = "(SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL)"


def _views(spark, d):
    e = _t(spark, d, "events")
    return e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'").select("user_id", "ts", "value")


@query(f"WITH q AS {VIEWS} SELECT p.event_id, q.v AS asof_value, q.ts AS asof_at FROM events p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.ts <= q.ts WHERE p.event_type = 'purchase'")
def asof_forward(spark, d):
    return joins.asof_join(*_views(spark, d), ["user_id"], "ts", "ts", "value", forward=True).select("event_id", "asof_value", "asof_at")


@query(f"""WITH q AS {VIEWS}, p AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS s FROM events WHERE event_type = 'purchase'), a AS (SELECT * FROM p WHERE s = 0), b AS (SELECT * FROM p WHERE s > 0)
 SELECT event_id, v AS price FROM a ASOF LEFT JOIN q ON a.user_id = q.user_id AND a.ts >= q.ts UNION ALL SELECT event_id, v FROM b ASOF LEFT JOIN q ON b.user_id = q.user_id AND b.ts < q.ts""")
def checkpoint_prices(spark, d):
    from millrace.operators.windows import sequence_by

    points, series = _views(spark, d)
    return joins.checkpoint_prices(sequence_by(points, ["user_id"], ["ts", "event_id"]), series, ["user_id"], "event_sequence", "ts", "value").select("event_id", F.col("asof_value").alias("price"))


@query(f"""WITH q AS {VIEWS}, p AS (SELECT * FROM events WHERE event_type = 'purchase'), a AS (SELECT p.event_id, p.user_id, p.ts, q.v AS bv, epoch_us(p.ts) // 1000000 - epoch_us(q.ts) // 1000000 AS bt FROM p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.ts > q.ts),
 b AS (SELECT a.*, q.v AS av, epoch_us(q.ts) // 1000000 - epoch_us(a.ts) // 1000000 AS aft FROM a ASOF LEFT JOIN q ON a.user_id = q.user_id AND a.ts <= q.ts)
 SELECT event_id, CASE WHEN bt <= 3600 THEN bv END AS before_primary, CASE WHEN aft <= 3600 THEN av END AS after_primary, CASE WHEN bt <= 86400 THEN bv END AS before_extended, CASE WHEN aft <= 86400 THEN av END AS after_extended FROM b""")
def purchase_reactions(spark, d):
    out = joins.reactions(*_views(spark, d), ["user_id"], "ts", "value", {"primary": 3600, "extended": 86_400})
    return out.select("event_id", "before_primary", "after_primary", "before_extended", "after_extended")


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_nationkey ELSE NULL END AS a, (c_custkey % 5)::INT AS b FROM customer) SELECT c_custkey, r_name FROM c LEFT JOIN region ON coalesce(a, b) = r_regionkey""")
def priority_regions(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.col("c_nationkey")).alias("_a"), (F.col("c_custkey") % 5).cast("int").alias("_b"))
    return joins.join_priority(c, _t(spark, d, "region"), ["_a", "_b"], "r_regionkey").select("c_custkey", "r_name")


@query("""WITH g AS (SELECT l_partkey % 97 AS h, l_suppkey % 97 AS w, sum(l_linenumber)::BIGINT AS x, count(*) AS y FROM lineitem GROUP BY 1, 2), a AS (SELECT DISTINCT l_partkey % 97 AS home, l_suppkey % 97 AS away FROM lineitem WHERE l_returnflag = 'A')
 SELECT home, away, h <> home AS swapped, CASE WHEN h <> home THEN y ELSE x END AS home_score, CASE WHEN h <> home THEN x ELSE y END AS away_score FROM a JOIN g ON (h = home AND w = away) OR (h = away AND w = home AND h <> w)""")
def oriented_scores(spark, d):
    sides = _t(spark, d, "lineitem").withColumns({"home": F.col("l_partkey") % 97, "away": F.col("l_suppkey") % 97})
    scores = sides.groupBy("home", "away").agg(F.sum("l_linenumber").alias("x"), F.count("*").alias("y"))
    fixtures = sides.where("l_returnflag = 'A'").select("home", "away").distinct()
    return joins.oriented_match(fixtures, scores.withColumnsRenamed({"home": "h", "away": "w"}), ("home", "away"), ("h", "w"), ("x", "y")).select("home", "away", "swapped", "home_score", "away_score")


@query("""SELECT p_partkey, coalesce(p_brand IN ('Brand#1', 'Brand#7') OR list_has_any(string_split(p_name, ' '), ['ring', 'bolt']) OR starts_with(p_brand, 'Brand#2'), false) AS in_scope,
 CASE WHEN p_type = 'SMALL' THEN false WHEN p_type = 'ECONOMY' THEN true ELSE regexp_matches(p_type, 'PROMO|MED') END AS tag_allowed, coalesce(p_retailprice, 0) >= 950 AND coalesce(p_retailprice, 0) < 1050 AS in_volume FROM part""")
def market_scopes(spark, d):
    return _t(spark, d, "part").select(
        "p_partkey", rules.in_scope(F.col("p_brand"), F.split("p_name", " "), ["Brand#1", "Brand#7"], ["Brand#2"], ["ring", "bolt"]).alias("in_scope"),
        rules.tag_allowed(F.col("p_type"), ["ECONOMY"], ["SMALL"], "PROMO|MED").alias("tag_allowed"), rules.volume_between(F.col("p_retailprice"), 950, 1050).alias("in_volume"),
    )


STATUS = {"HOUSEHOLD": "resolved", "MACHINERY": "closed", "FURNITURE": "inactive"}


@query("""WITH p AS (SELECT o_custkey, arg_max(o_totalprice, struct_pack(a := o_orderdate, b := o_orderkey)) FILTER (WHERE o_orderstatus <> 'P') AS price, max(o_orderdate) FILTER (WHERE o_orderstatus <> 'P') AS seen FROM orders GROUP BY 1),
 m AS (SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'resolved' WHEN 'MACHINERY' THEN 'closed' WHEN 'FURNITURE' THEN 'inactive' ELSE 'live' END AS s, price, (epoch_us(TIMESTAMP '2000-01-01') - epoch_us(seen)) // 3600000000 AS age FROM customer LEFT JOIN p ON c_custkey = o_custkey)
 SELECT c_custkey, CASE WHEN s = 'resolved' THEN 'historical_resolved' WHEN s = 'closed' THEN 'historical_closed' WHEN s = 'inactive' THEN 'inactive' WHEN price IS NULL THEN 'missing_live' WHEN age <= 4800 THEN 'fresh_live' ELSE 'stale_live' END AS price_status FROM m""")
def price_statuses(spark, d):
    o = _t(spark, d, "orders").where("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("price"), F.max("o_orderdate").alias("at"))
    status = F.lit("live")
    for segment, name in STATUS.items():
        status = F.when(F.col("c_mktsegment") == segment, name).otherwise(status)
    age = F.floor((floor_epoch(_at(2000, 1, 1), 1) - _epoch("at")) / 3600)
    return _t(spark, d, "customer").join(o, "c_custkey", "left").select("c_custkey", rules.price_status(status, F.col("price"), age, 4800).alias("price_status"))


@query("""WITH c AS (SELECT CASE WHEN c_acctbal < 0 THEN 'x' || c_custkey ELSE c_custkey::VARCHAR END AS id FROM customer) SELECT id, coalesce(regexp_full_match(id, '[0-9]+'), false) AS numeric FROM c""")
def numeric_ids(spark, d):
    c = _t(spark, d, "customer").select(F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string")).alias("id"))
    good, rest = rules.numeric_ids(c, "id")
    return good.withColumn("numeric", F.lit(True)).unionByName(rest.withColumn("numeric", F.lit(False)))


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_nationkey < 10 THEN 'accepting' END, CASE WHEN c_acctbal > 5000 THEN 'funded' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'open' END) AS evidence,
 concat_ws(chr(10), CASE WHEN trim(c_name) <> '' THEN 'name: ' || trim(c_name) END, CASE WHEN trim(nullif(c_mktsegment, 'BUILDING')) <> '' THEN 'segment: ' || trim(c_mktsegment) END) AS content,
 coalesce(TIMESTAMP '2024-01-01' + to_days(c_nationkey::INT) >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY, true) AS not_ended FROM customer""")
def market_evidence(spark, d):
    evidence = rules.tradability(accepting=F.col("c_nationkey") < 10, funded=F.col("c_acctbal") > 5000, open=F.col("c_mktsegment") == "BUILDING")
    content = rules.content_text(name=F.col("c_name"), segment=F.nullif("c_mktsegment", F.lit("BUILDING")))
    end = _at(2024, 1, 1) + F.make_dt_interval(days=F.col("c_nationkey"))
    return _t(spark, d, "customer").select("c_custkey", F.array_join(evidence, ",").alias("evidence"), content.alias("content"), rules.not_ended(end, _at(2024, 1, 20), 7).alias("not_ended"))


@query(r"""SELECT doc_id, nullif(concat_ws(',', CASE WHEN regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]') THEN 'control' END, CASE WHEN regexp_matches(text, '^[=+@-]') THEN 'formula' END, CASE WHEN regexp_matches(text, '[0-9a-f]{40}') THEN 'hash' END,
 CASE WHEN regexp_matches(text, 'https?://') THEN 'url' END, CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}') THEN 'email' END), '') AS issues FROM documents""")
def forbidden_texts(spark, d):
    return _t(spark, d, "documents").select("doc_id", rules.forbidden_text(F.col("text")).alias("issues"))


RUNS_SQL = """r AS (SELECT event_type, epoch_us(ts) // 86400000000 * 86400 AS day, count(*) AS n FROM events GROUP BY 1, 2), l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS b FROM r),
 m AS (SELECT *, CASE WHEN n < b * 0.9 THEN 'drop' WHEN n > b * 1.1 THEN 'jump' END AS alert FROM l),
 a AS (SELECT event_type, alert, CASE WHEN alert = 'drop' THEN 'error' ELSE 'warn' END AS severity, min(day) AS first_seen, max(day) AS last_seen, count(*) AS times FROM m WHERE alert IS NOT NULL GROUP BY ALL)"""


def _alerts(spark, d):
    runs = _t(spark, d, "events").groupBy("event_type", floor_epoch(F.col("ts"), 86_400).alias("day")).agg(F.count("*").alias("n"))
    return rules.alerts(runs, "event_type", "day", "n", 0.9, 1.1)


@query(f"WITH {RUNS_SQL} SELECT * FROM a")
def run_alerts(spark, d):
    return _alerts(spark, d)


@query(f"""WITH {RUNS_SQL}, h AS (SELECT event_type, sum(CASE WHEN severity = 'error' THEN times ELSE 0 END)::BIGINT AS errors, sum(CASE WHEN severity = 'warn' THEN times ELSE 0 END)::BIGINT AS warnings FROM a GROUP BY 1)
 SELECT *, CASE WHEN errors > 0 THEN 'failing' WHEN warnings > 0 THEN 'degraded' ELSE 'healthy' END AS state FROM h""")
def run_health(spark, d):
    return rules.health(_alerts(spark, d), "event_type")


@query("""WITH a AS (SELECT user_id, event_type FROM events WHERE value > 10), b AS (SELECT user_id, event_type FROM events WHERE event_type <> 'error'), x AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b), y AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
 SELECT (SELECT count(*) FROM a) AS first_rows, (SELECT count(*) FROM b) AS second_rows, (SELECT count(*) FROM x) AS only_first, (SELECT count(*) FROM y) AS only_second, false AS equal""")
def compared_tables(spark, d):
    e = _t(spark, d, "events")
    return rules.compare_tables(e.where("value > 10").select("user_id", "event_type"), e.where("event_type <> 'error'").select("user_id", "event_type"))


@query("""WITH b AS (SELECT user_id, epoch_us(ts) // 86400000000 * 86400 AS b, min(value) AS l, max(value) AS h FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25' GROUP BY 1, 2), g AS (SELECT *, b - lag(b) OVER (PARTITION BY user_id ORDER BY b) AS gap FROM b)
 SELECT user_id, count(*) AS observed, max(gap) AS largest_gap, min(b) - epoch_us(TIMESTAMP '2024-01-03') // 1000000 AS start_offset, epoch_us(TIMESTAMP '2024-01-25') // 1000000 - max(b) AS finish_offset, min(l) = max(h) AS constant_price, 23::BIGINT AS expected, round(count(*) / 23, 8) AS ratio FROM g GROUP BY 1""")
def token_day_coverage(spark, d):
    return rules.token_coverage(_t(spark, d, "events"), "user_id", "ts", "value", _at(2024, 1, 3), _at(2024, 1, 25), 86_400)


@query("""SELECT 'value' AS column_name, count(*) AS rows, count_if(value IS NULL)::BIGINT AS nulls, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS deviation, min(length(value::VARCHAR)) AS shortest, max(length(value::VARCHAR)) AS longest FROM events
 UNION ALL SELECT 'event_type', count(*), count_if(event_type IS NULL)::BIGINT, NULL, NULL, min(length(event_type)), max(length(event_type)) FROM events""")
def event_profile(spark, d):
    return rules.profile_stats(_t(spark, d, "events"), ["value", "event_type"])


@query("""WITH s AS (SELECT unnest([0.05, 0.5, 0.95])::DOUBLE AS share) SELECT event_type, share, round(CASE share WHEN 0.05 THEN quantile_cont(value, 0.05) WHEN 0.5 THEN quantile_cont(value, 0.5) ELSE quantile_cont(value, 0.95) END, 8) AS percentile FROM events, s GROUP BY 1, 2""")
def exact_percentiles(spark, d):
    out = rules.exact_percentiles(_t(spark, d, "events"), "event_type", "value", [0.05, 0.5, 0.95])
    return out.select("event_type", "share", F.round("percentile", 8).alias("percentile"))


CHANGES_SQL = """c AS (SELECT l_partkey AS token, l_shipdate AS ts, l_returnflag = 'R' AS reset, l_discount AS price, CASE WHEN l_linestatus = 'F' AND l_tax < 0.03 THEN 0 ELSE l_quantity END AS size,
 row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS i FROM lineitem)"""
TIMES = [dt.datetime(year, 7, 1) for year in range(1996, 2002)]


@query(f"""WITH {CHANGES_SQL}, t AS (SELECT unnest([make_timestamp(y, 7, 1, 0, 0, 0) FOR y IN range(1996, 2002)]) AS snapshot_at), r AS (SELECT token, snapshot_at, max(i) FILTER (WHERE reset) AS r FROM c JOIN t ON ts <= snapshot_at GROUP BY 1, 2),
 s AS (SELECT c.token, r.snapshot_at, price, arg_max(size, i) AS size FROM c JOIN r ON c.token = r.token AND ts <= snapshot_at AND i >= coalesce(r, 0) GROUP BY ALL)
 SELECT token, snapshot_at, count(*) AS levels, sum(size) AS total_size, max(price) AS best_price FROM s WHERE size > 0 GROUP BY ALL""")
def replayed_books(spark, d):
    size = F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") < 0.03), 0.0).otherwise(F.col("l_quantity"))
    changes = _t(spark, d, "lineitem").withColumn("token", F.col("l_partkey")).withColumn("new_size", size)
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return books.book_at(books.level_intervals(changes, "token", order, "l_shipdate", F.col("l_returnflag") == "R", "l_discount", "new_size"), "token", TIMES)


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'A' AS buy, (l_quantity * 1000000)::BIGINT AS sh, (l_extendedprice * 100)::BIGINT AS co FROM lineitem)
 SELECT l_orderkey, l_linenumber, CASE WHEN buy THEN 'buy' ELSE 'sell' END AS side, (l_partkey + 1)::DECIMAL(20,0) AS token_id, sh::DECIMAL(20,0) AS shares, co::DECIMAL(20,0) AS collateral, lpad(printf('%x', l_suppkey), 40, '0') AS maker FROM l""")
def decoded_fills(spark, d):
    """Logs are written from lineitem as topics and data words, then decoded."""
    word = lambda c: F.lpad(F.lower(F.hex(c)), 64, "0")
    buy, token, zero = F.col("l_returnflag") == "A", F.col("l_partkey") + 1, F.lit(0).cast("long")
    shares, collateral = (F.col("l_quantity") * 1_000_000).cast("long"), F.round(F.col("l_extendedprice") * 100).cast("long")
    data = F.concat(word(F.when(buy, zero).otherwise(token)), word(F.when(buy, token).otherwise(zero)), word(F.when(buy, collateral).otherwise(shares)), word(F.when(buy, shares).otherwise(collateral)))
    logs = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", data.alias("data"), word(F.col("l_suppkey")).alias("topic"))
    return books.decode_fills(logs, "data", "topic").select("l_orderkey", "l_linenumber", "side", "token_id", "shares", "collateral", "maker")


@query("""WITH e AS (SELECT *, coalesce(l_returnflag = 'R', false) AS m, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM lineitem)
 SELECT l_orderkey, i::BIGINT AS event_no, coalesce(sum(m::INT) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS segment,
 CASE WHEN m THEN 'matched' WHEN lead(m) OVER (PARTITION BY l_orderkey ORDER BY i) THEN 'active' WHEN bool_or(m) OVER (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) THEN 'passive' ELSE 'open' END AS role FROM e""")
def fill_segments(spark, d):
    from millrace.operators.windows import sequence_by

    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    out = books.segment_events(sequence_by(_t(spark, d, "lineitem"), ["l_orderkey"], order), "l_orderkey", ["event_sequence"], F.col("l_returnflag") == "R")
    return out.select("l_orderkey", (F.col("event_sequence") + 1).alias("event_no"), "segment", "role")

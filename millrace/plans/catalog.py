"""Queries of the catalog operators over the driver tables, each with its SQL. Every query reads its tables whole.

orders stand for tokens and plans, customer for markets, part for listed series, lineitem for chunks, intervals and fills.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators import catalog
from millrace.plans.market import _t

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Rungs of the ladder that the queries use: suffix, stage, rank, direction.
LADDER = [("ECONOMY", "group", 1, "reach"), ("STANDARD", "round", 2, "reach"), ("PROMO", "final", 3, "win")]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT o_orderkey, o_custkey, CASE o_orderkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_name END AS outcome_label
 FROM orders JOIN customer ON o_custkey = c_custkey""")
def token_working_set(spark, d):
    markets = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.to_json(F.array("c_mktsegment", "c_name")).alias("outcomes"))
    tokens = _t(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 3).cast("int").alias("place"))
    return catalog.token_working_set(tokens, markets, "o_custkey", "place", "outcomes").drop("place")


@query("""SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'group' WHEN 'STANDARD' THEN 'round' WHEN 'PROMO' THEN 'final' END AS stage,
 CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'PROMO' THEN 3 END AS stage_rank,
 CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'reach' WHEN p_type = 'PROMO' THEN 'win' END AS direction,
 nullif(upper(regexp_extract(p_brand, '^Brand#(.+)$', 1)), '') AS group_label FROM part""")
def stage_classes(spark, d):
    return _t(spark, d, "part").select("p_partkey", *catalog.classify_stage(F.col("p_type"), LADDER), catalog.group_label(F.col("p_brand"), "brand#").alias("group_label"))


@query("""WITH n AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS home, split_part(p_name, ' ', 2) AS away,
 CASE WHEN p_size > 40 THEN 'A Draw!' WHEN p_size > 25 THEN upper(split_part(p_name, ' ', 1)) WHEN p_size > 10 THEN split_part(p_name, ' ', 2) || '?' ELSE p_type END AS label FROM part),
 k AS (SELECT *, trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS key FROM n),
 r AS (SELECT *, CASE WHEN key = home THEN 'home' WHEN key = away THEN 'away' WHEN key = 'a draw' THEN 'draw' ELSE 'other' END AS role FROM k),
 t AS (SELECT *, CASE role WHEN 'home' THEN home WHEN 'away' THEN away END AS team_name FROM r)
 SELECT p_partkey, role, team_name, CASE WHEN role = 'draw' THEN 'draw' ELSE team_name || ' wins' END AS yes_represents,
 CASE WHEN role = 'draw' THEN 'either team wins' ELSE team_name || ' does not win' END AS no_represents FROM t""")
def propositions(spark, d):
    home, away = (F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2))
    size = F.col("p_size")
    label = F.when(size > 40, "A Draw!").when(size > 25, F.upper(home)).when(size > 10, F.concat(away, F.lit("?"))).otherwise(F.col("p_type"))
    roles = _t(spark, d, "part").select("p_partkey", home.alias("home"), away.alias("away"), catalog.market_role(label, home, away).alias("role"))
    return roles.select("p_partkey", "role", *catalog.proposition(F.col("role"), F.col("home"), F.col("away")))


@query("SELECT p_partkey FROM part WHERE NOT coalesce((p_brand = 'Brand#13' AND p_type IN ('ECONOMY', 'PROMO')) OR (p_brand = 'Brand#5' AND p_type = 'STANDARD'), false)")
def suffixes_excluded(spark, d):
    return catalog.exclude_suffixes(_t(spark, d, "part"), "p_brand", "p_type", {"Brand#13": ["ECONOMY", "PROMO"], "Brand#5": ["STANDARD"]}).select("p_partkey")


@query("""WITH a AS (SELECT DISTINCT user_id AS id, 0 AS r FROM events UNION ALL SELECT DISTINCT o_custkey, 1 FROM orders UNION ALL SELECT DISTINCT c_custkey, 2 FROM customer)
 SELECT id, count(*) AS n_sources, CASE min(r) WHEN 0 THEN 'events' WHEN 1 THEN 'orders' ELSE 'registry' END AS scope_source FROM a GROUP BY id""")
def scope_candidates(spark, d):
    ids = {"events": ("events", "user_id"), "orders": ("orders", "o_custkey"), "registry": ("customer", "c_custkey")}
    return catalog.scope_candidates({name: _t(spark, d, t).select(F.col(c).alias("id")) for name, (t, c) in ids.items()}, ["id"])


@query("""WITH t AS (SELECT c_custkey AS id, c_custkey IN (SELECT o_custkey FROM orders) AS h, c_custkey IN (SELECT user_id FROM events) AS l FROM customer)
 SELECT count(*) AS n_tokens, count_if(h)::BIGINT AS history_tokens, count_if(l)::BIGINT AS ledger_tokens, count_if(h) / count(*) AS history_ratio, count_if(l) / count(*) AS ledger_ratio FROM t""")
def planning_context(spark, d):
    ids = lambda t, c: _t(spark, d, t).select(F.col(c).alias("id"))
    return catalog.planning_context(ids("customer", "c_custkey"), "id", {"history": ids("orders", "o_custkey"), "ledger": ids("events", "user_id")})


@query("""WITH i AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS lo, epoch_us(ts) // 1000000 + 3600 AS hi FROM events),
 m AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 7200 THEN 0 ELSE 1 END AS new FROM i)
 SELECT user_id, event_id, sum(new) OVER (PARTITION BY user_id ORDER BY lo, hi)::BIGINT AS merged FROM m""")
def interval_members(spark, d):
    spans = _spans(spark, d).withColumn("hi", F.col("lo") + 3600)
    return catalog.merge_members(spans, ["user_id"], "lo", "hi", 7200).select("user_id", "event_id", "merged")


def _spans(spark, d):
    return _t(spark, d, "events").select("user_id", "event_id", floor_epoch(F.col("ts"), 1).alias("lo"))


@query("""WITH i AS (SELECT user_id, epoch_us(ts) // 1000000 AS lo, epoch_us(ts) // 1000000 + 86400 AS hi FROM events),
 m AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM i),
 g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM m),
 u AS (SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY user_id, g),
 c AS (SELECT c_custkey AS user_id, 1704067200 AS target_lo, 1706745600 AS target_hi FROM customer),
 x AS (SELECT user_id, target_lo, target_hi, greatest(lo, target_lo) AS lo, least(hi, target_hi) AS hi FROM c JOIN u USING (user_id) WHERE hi > target_lo AND lo < target_hi),
 y AS (SELECT * FROM x UNION ALL SELECT user_id, target_lo, target_hi, target_lo, target_lo FROM c UNION ALL SELECT user_id, target_lo, target_hi, target_hi, target_hi FROM c),
 z AS (SELECT user_id, hi AS gap_lo, lead(lo) OVER (PARTITION BY user_id ORDER BY lo, hi) AS gap_hi FROM y)
 SELECT user_id, gap_lo::BIGINT AS gap_lo, gap_hi::BIGINT AS gap_hi FROM z WHERE gap_hi > gap_lo""")
def target_gaps(spark, d):
    target = _t(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(1704067200).cast("long").alias("target_lo"), F.lit(1706745600).cast("long").alias("target_hi"))
    return catalog.target_gaps(target, _spans(spark, d).withColumn("hi", F.col("lo") + 86400), ["user_id"], "lo", "hi")


@query("""WITH k AS (SELECT o_custkey, o_orderpriority, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY ALL)
 SELECT o_custkey, count(*) AS n_items, string_agg(o_orderpriority || ':' || o_orderkey, ',' ORDER BY o_orderpriority) AS items FROM k GROUP BY o_custkey""")
def merged_payloads(spark, d):
    got = catalog.merge_payloads(_t(spark, d, "orders"), "o_custkey", "o_orderpriority", [F.col("o_orderdate"), F.col("o_orderkey")], "o_orderkey")
    item = lambda x: F.concat_ws(":", x.o_orderpriority, x.o_orderkey.cast("string"))
    return got.withColumn("items", F.array_join(F.transform("items", item), ","))


@query("""WITH k AS (SELECT DISTINCT o_custkey, o_orderkey::VARCHAR AS m FROM orders)
 SELECT o_custkey, count(*)::INTEGER AS n_members, sha256(string_agg(m, ',' ORDER BY m)) AS members_sha256 FROM k GROUP BY o_custkey""")
def inventory_hashes(spark, d):
    return catalog.inventory_hash(_t(spark, d, "orders"), "o_custkey", "o_orderkey")


WINDOWS = """SELECT o_orderkey, o_custkey, greatest(o_orderdate, TIMESTAMP '1996-01-01') AS window_lo, least(o_orderdate + INTERVAL 90 DAY, TIMESTAMP '1997-06-30') AS window_hi
 FROM orders WHERE greatest(o_orderdate, TIMESTAMP '1996-01-01') < least(o_orderdate + INTERVAL 90 DAY, TIMESTAMP '1997-06-30')"""


@query(WINDOWS)
def futures_windows(spark, d):
    start, end = (F.lit(dt.datetime(*day)).cast("timestamp_ntz") for day in ((1996, 1, 1), (1997, 6, 30)))
    orders = _t(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).withColumn("ended", F.col("o_orderdate") + F.expr("INTERVAL 90 DAY"))
    return catalog.futures_windows(orders, "o_orderdate", "ended", start, end).select("o_orderkey", "o_custkey", "window_lo", "window_hi")


@query(f"""WITH w AS ({WINDOWS}), l AS (SELECT o_custkey, max((window_lo, o_orderkey)) AS m, arg_max(window_lo, (window_lo, o_orderkey)) AS lo, arg_max(window_hi, (window_lo, o_orderkey)) AS hi FROM w GROUP BY o_custkey)
 SELECT w.o_orderkey, w.window_lo = l.lo AND w.window_hi = l.hi AS reusable FROM w JOIN l USING (o_custkey)""")
def reusable_windows(spark, d):
    plans = futures_windows(spark, d)
    return catalog.reusable(plans, plans, ["o_custkey"], ["window_lo", "o_orderkey"]).select("o_orderkey", "reusable")


@query("""WITH l AS (SELECT l_partkey, arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY l_partkey)
 SELECT l_partkey, l_suppkey FROM l WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def refreshed_registry(spark, d):
    eligible = _t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return catalog.refresh_registry(_t(spark, d, "lineitem"), eligible, "l_suppkey", "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"]).select("l_partkey", "l_suppkey")


@query("""SELECT 'nations' AS name, count(*) AS found, 25::BIGINT AS expected, count(*) = 25 AS ok FROM nation
 UNION ALL SELECT 'orders without customers', count(*), 0, count(*) = 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
 UNION ALL SELECT 'orders', count(*), 1, count(*) = 1 FROM orders""")
def inventory_checks(spark, d):
    orders, customer = _t(spark, d, "orders"), _t(spark, d, "customer")
    lost = orders.join(customer, orders.o_custkey == customer.c_custkey, "left_anti")
    return catalog.check_inventory({"nations": (_t(spark, d, "nation"), 25), "orders without customers": (lost, 0), "orders": (orders, 1)})


@query("""WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 4 ELSE 3 END AS expected FROM orders), n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
 SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM c JOIN n ON o_orderkey = l_orderkey WHERE n = expected)""")
def published_scan(spark, d):
    chunks = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", 4).otherwise(3).alias("expected"))
    return catalog.publish_scan(_t(spark, d, "lineitem"), chunks, "l_orderkey", "expected").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""WITH g AS (SELECT event_type, user_id, ts::DATE AS day, count(*) AS n, count_if(value > 100) AS i FROM events GROUP BY ALL)
 SELECT event_type, sum(n)::BIGINT AS n_events, sum(i)::BIGINT AS n_in_scope, sum(n - 1)::BIGINT AS n_repeated_logs FROM g GROUP BY event_type""")
def leaf_audits(spark, d):
    events = _t(spark, d, "events").withColumn("day", F.col("ts").cast("timestamp_ntz").cast("date"))
    return catalog.leaf_audit(events, ["event_type"], ["user_id", "day"], F.col("value") > 100)

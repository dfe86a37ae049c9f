"""Queries of the registry operators over the driver tables, each with its SQL. Every query reads its tables whole.

events stands for ticks and runs, orders and customer for registries, lineitem for book levels and intervals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators import bars, joins, registry, windows
from millrace.plans.market import SQL as MARKET_SQL
from millrace.plans.market import _t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


PRIMARY_SQL = """SELECT user_id, event_id, event_type FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'view') DESC NULLS LAST, value ASC NULLS LAST, event_id) = 1"""


@query(PRIMARY_SQL)
def primary_tokens(spark, d):
    events = _t(spark, d, "events")
    return registry.primary_token(events, "user_id", "event_id", F.col("event_type") == "view", F.col("value")).select("user_id", "event_id", "event_type")


@query(f"""WITH p AS ({PRIMARY_SQL}), b AS ({MARKET_SQL['bars_hourly'].replace('SELECT user_id', 'SELECT user_id, event_type', 1)})
 SELECT b.* FROM b JOIN p USING (user_id, event_type) WHERE bucket BETWEEN epoch_us(TIMESTAMP '2024-01-02') // 1000000 AND epoch_us(TIMESTAMP '2024-01-20') // 1000000""")
def primary_hourly_odds(spark, d):
    keys = ["user_id", "event_type"]
    hours = bars.ohlc(_t(spark, d, "events"), keys, "ts", "value", 3600).join(primary_tokens(spark, d).select(*keys), keys, "left_semi")
    at = lambda day: floor_epoch(F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz"), 1)
    return hours.where(F.col("bucket").between(at(2), at(20)))


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def latest_run(spark, d):
    return registry.latest_run(_t(spark, d, "orders"), [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "o_custkey", "o_orderdate")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_group(spark, d):
    return registry.latest_group(_t(spark, d, "orders"), "o_orderdate").select("o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_o_totalprice FROM orders")
def run_trends(spark, d):
    return registry.with_previous(_t(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"]).select("o_custkey", "o_orderkey", "previous_o_totalprice")


@query("""SELECT l_orderkey, l_linenumber, previous_hi FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber + (l_quantity::BIGINT % 2)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linenumber + (l_quantity::BIGINT % 2)) AS previous_hi FROM lineitem)
 WHERE previous_hi + 1 <> l_linenumber""")
def interval_breaks(spark, d):
    ranges = _t(spark, d, "lineitem").withColumn("hi", F.col("l_linenumber") + F.col("l_quantity").cast("long") % 2)
    return registry.interval_breaks(ranges, ["l_orderkey"], "l_linenumber", "hi").select("l_orderkey", "l_linenumber", "previous_hi")


@query("""SELECT o_custkey, coalesce(bool_or(o_totalprice >= 150000), false) AS eligible, min(CASE WHEN o_totalprice >= 150000 THEN o_orderdate END) AS eligible_since FROM orders GROUP BY 1""")
def sticky_eligibility(spark, d):
    orders = _t(spark, d, "orders")
    done = F.col("o_orderstatus") == "F"
    return registry.sticky_eligibility(orders.where(done), orders.where(~done), "o_custkey", "o_totalprice", "o_orderdate", 150000)


@query("SELECT user_id, max(ts) AS cursor, arg_max(event_type, struct_pack(t := ts, e := event_id)) AS state, bool_or(value > 180) AS flagged FROM events GROUP BY 1")
def writer_states(spark, d):
    return registry.merge_states(_t(spark, d, "events"), "user_id", "ts", ["ts", "event_id"], "event_type", F.col("value") > 180)


REVISED_SQL = "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price, count(*)::VARCHAR || ':' || max(o_orderkey)::VARCHAR AS revision FROM orders GROUP BY 1"


@query(REVISED_SQL)
def rebuilt_markets(spark, d):
    """The state before the open orders, brought up to date market by market."""
    orders = _t(spark, d, "orders")
    state = lambda df: df.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_price"), F.concat_ws(":", F.count("*").cast("string"), F.max("o_orderkey").cast("string")).alias("revision"))
    return registry.rebuild_dirty(state(orders.where("o_orderstatus <> 'P'")), state(orders), "o_custkey", "revision")


@query("""WITH k AS (SELECT DISTINCT o_custkey FROM orders), r AS (SELECT o_custkey, row_number() OVER (ORDER BY sha256('seed-7:' || o_custkey::VARCHAR), o_custkey) AS n FROM k)
 SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM r WHERE n <= ceil((SELECT count(*) FROM k) * 0.1))""")
def hash_sample(spark, d):
    return registry.hash_sample(_t(spark, d, "orders"), "o_custkey", 0.1, "seed-7").select("o_orderkey", "o_custkey")


@query("""WITH x AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')
 SELECT 'orders' AS frame, count(*) AS rows_before, count(*) FILTER (o_orderkey NOT IN (SELECT k FROM x)) AS rows_after FROM orders UNION ALL
 SELECT 'lineitem', count(*), count(*) FILTER (l_orderkey NOT IN (SELECT k FROM x)) FROM lineitem""")
def purged_ids(spark, d):
    orders, lines = _t(spark, d, "orders").withColumnRenamed("o_orderkey", "id"), _t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "id")
    return registry.purge_ids({"orders": orders, "lineitem": lines}, orders.where("o_orderpriority = '1-URGENT'"), "id")[1]


@query("""SELECT user_id, max(CASE WHEN event_type = 'view' THEN (props->>'k')::BIGINT END) AS view_metric, max(CASE WHEN event_type = 'click' THEN (props->>'k')::BIGINT END) AS click_metric,
 max(CASE WHEN event_type = 'purchase' THEN (props->>'k')::BIGINT END) AS purchase_metric FROM events GROUP BY 1""")
def step_metrics(spark, d):
    return registry.step_metrics(_t(spark, d, "events"), ["user_id"], "event_type", ["view", "click", "purchase"], F.get_json_object("props", "$.k").cast("long"))


@query("SELECT user_id, count(DISTINCT epoch_us(ts) // 3600000000) AS observed, 720::BIGINT AS expected, round(count(DISTINCT epoch_us(ts) // 3600000000) / 720, 8) AS ratio FROM events GROUP BY 1")
def token_hours(spark, d):
    return registry.coverage(_t(spark, d, "events"), "user_id", floor_epoch(F.col("ts"), 3600), 720)


@query("SELECT 'events' AS layer, count(*) AS n_rows FROM events UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def layer_counts(spark, d):
    return registry.layer_counts({name: _t(spark, d, name) for name in ("events", "orders", "lineitem")})


@query("""WITH o AS (SELECT event_type, user_id, arg_min(value, struct_pack(t := ts, e := event_id)) AS opening_price FROM events GROUP BY 1, 2)
 SELECT event_type, user_id, opening_price, row_number() OVER (PARTITION BY event_type ORDER BY opening_price DESC, user_id) AS opening_rank FROM o QUALIFY opening_rank <= 5""")
def opening_ranks(spark, d):
    return registry.opening_rank(_t(spark, d, "events"), "event_type", "user_id", ["ts", "event_id"], "value", 5)


@query("""WITH h AS (SELECT user_id, epoch_us(ts) // 86400000000 * 86400 AS bucket, event_type, value FROM events)
 SELECT s.user_id, s.bucket, y.v AS yes_price, n.v AS no_price, CASE WHEN y.v IS NOT NULL AND n.v IS NOT NULL THEN 'complete' WHEN y.v IS NOT NULL THEN 'yes_only' WHEN n.v IS NOT NULL THEN 'no_only' ELSE 'no_fills' END AS status
 FROM (SELECT DISTINCT user_id, bucket FROM h) s LEFT JOIN (SELECT user_id, bucket, max(value) AS v FROM h WHERE event_type = 'purchase' GROUP BY 1, 2) y USING (user_id, bucket)
 LEFT JOIN (SELECT user_id, bucket, max(value) AS v FROM h WHERE event_type = 'click' GROUP BY 1, 2) n USING (user_id, bucket)""")
def two_sided_days(spark, d):
    h = _t(spark, d, "events").withColumn("bucket", floor_epoch(F.col("ts"), 86400))
    side = lambda kind: h.where(F.col("event_type") == kind).groupBy("user_id", "bucket").agg(F.max("value").alias("price"))
    return registry.two_sided(h.select("user_id", "bucket").distinct(), side("purchase"), side("click"), ["user_id", "bucket"], "price")


@query("""WITH x AS (SELECT user_id, epoch_us(ts) // 86400000000 AS day, sha256(string_agg(event_id::VARCHAR || '=' || round(value * 100)::BIGINT::VARCHAR, ',' ORDER BY ts, event_id)) AS h FROM events GROUP BY 1, 2)
 SELECT user_id, sha256(string_agg(h, ',' ORDER BY day)) AS history_hash FROM x GROUP BY 1""")
def history_hashes(spark, d):
    text = F.concat_ws("=", F.col("event_id").cast("string"), F.round(F.col("value") * 100).cast("long").cast("string"))
    return registry.history_hash(_t(spark, d, "events"), "user_id", "ts", text, "event_id")


@query("""WITH r AS (SELECT l_suppkey, min(l_linenumber)::BIGINT * 10000 AS lo, max(l_linenumber)::BIGINT * 20000 AS hi FROM lineitem GROUP BY 1),
 c AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_orderkey AS lo, l_orderkey + 500 AS hi FROM lineitem)
 SELECT c.l_suppkey, l_orderkey, l_linenumber, coalesce(c.lo >= r.lo AND c.hi <= r.hi, false) AS inside FROM c LEFT JOIN r USING (l_suppkey)""")
def contained_chunks(spark, d):
    lines = _t(spark, d, "lineitem")
    ranges = lines.groupBy("l_suppkey").agg((F.min("l_linenumber").cast("long") * 10000).alias("a"), (F.max("l_linenumber").cast("long") * 20000).alias("b"))
    chunks = lines.select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_orderkey").alias("c_lo"), (F.col("l_orderkey") + 500).alias("c_hi"))
    return registry.contained_in(chunks, windows.merge_intervals(ranges, ["l_suppkey"], "a", "b"), ["l_suppkey"], "c_lo", "c_hi").select("l_suppkey", "l_orderkey", "l_linenumber", "inside")


@query("""WITH a AS (SELECT o_custkey AS leaf, count(*) AS h FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), b AS (SELECT o_custkey AS leaf, count(*) AS h FROM orders WHERE o_totalprice > 50000 GROUP BY 1)
 SELECT leaf, CASE WHEN b.h IS NULL THEN 'only_first' WHEN a.h IS NULL THEN 'only_second' WHEN a.h = b.h THEN 'equal' ELSE 'different' END AS verdict FROM a FULL JOIN b USING (leaf)""")
def compared_leaves(spark, d):
    orders = _t(spark, d, "orders").withColumnRenamed("o_custkey", "leaf")
    digest = lambda df: df.groupBy("leaf").agg(F.count("*").alias("h"))
    return registry.compare_leaves(digest(orders.where("o_orderstatus <> 'P'")), digest(orders.where("o_totalprice > 50000")), "leaf", "h")


@query("""SELECT event_type, max(ts) AS last_at, CASE WHEN 1706745600 - epoch_us(max(ts)) // 1000000 > 172800 THEN 'error' WHEN 1706745600 - epoch_us(max(ts)) // 1000000 > 100000 THEN 'warn' ELSE 'pass' END AS state FROM events GROUP BY 1""")
def source_freshness(spark, d):
    return registry.check_freshness(_t(spark, d, "events"), "event_type", "ts", F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"), 100000, 172800)


@query("""SELECT o_orderkey, 'low_price' AS issue, 'warn' AS severity, o_totalprice AS measured FROM orders WHERE o_totalprice < 20000 UNION ALL
 SELECT o_orderkey, 'still_open', 'error', o_custkey::DOUBLE FROM orders WHERE o_orderstatus = 'P'""")
def order_issues(spark, d):
    tests = {"low_price": ("warn", F.col("o_totalprice") < 20000, F.col("o_totalprice")), "still_open": ("error", F.col("o_orderstatus") == "P", F.col("o_custkey"))}
    return registry.issues(_t(spark, d, "orders"), "o_orderkey", tests)


@query("""SELECT DISTINCT o_custkey AS id, 'dangling_edge' AS issue FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL
 SELECT c_custkey, 'lonely_node' FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def graph_issues(spark, d):
    return registry.check_graph(_t(spark, d, "customer").where("c_acctbal > 0"), _t(spark, d, "orders"), "c_custkey", "o_custkey")


@query("""WITH s AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN 'bid' ELSE 'ask' END AS side, l_discount AS p, l_quantity AS n FROM lineitem),
 b AS (SELECT l_orderkey, max(p) FILTER (side = 'bid') AS bid, min(p) FILTER (side = 'ask') AS ask FROM s GROUP BY 1),
 t AS (SELECT l_orderkey, coalesce(sum(n) FILTER (side = 'bid' AND p >= bid - 0.03::DOUBLE), 0) AS bid_depth, coalesce(sum(n) FILTER (side = 'ask' AND p <= ask + 0.03::DOUBLE), 0) AS ask_depth FROM s JOIN b USING (l_orderkey) GROUP BY 1)
 SELECT *, round((bid_depth - ask_depth) / nullif(bid_depth + ask_depth, 0), 8) AS imbalance FROM t""")
def touch_depths(spark, d):
    return registry.touch_depth(_t(spark, d, "lineitem"), "l_orderkey", F.when(F.col("l_returnflag") == "N", "bid").otherwise("ask"), "l_discount", "l_quantity")


@query("""WITH r AS (SELECT user_id, event_id, ts, (sum(CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 ELSE 0 END) OVER w)::BIGINT AS running_score FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
 SELECT user_id, event_id, running_score, running_score - coalesce(lag(running_score) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) <= 1 AS unit_step FROM r""")
def score_checkpoints(spark, d):
    goals = _t(spark, d, "events").withColumn("goals", F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", 2).otherwise(0))
    return registry.score_checkpoints(goals, "user_id", ["ts", "event_id"], "goals").select("user_id", "event_id", "running_score", "unit_step")


@query("""WITH t AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id, ts, max(value) AS bid FROM events WHERE event_type = 'view' GROUP BY 1, 2)
 SELECT t.user_id, event_id, CASE WHEN bid IS NULL THEN 'unknown' WHEN value >= bid + 10 THEN 'buy' WHEN value <= bid THEN 'sell' ELSE 'unknown' END AS side FROM t ASOF LEFT JOIN b ON t.user_id = b.user_id AND t.ts >= b.ts""")
def aggressor_sides(spark, d):
    events = _t(spark, d, "events")
    at = joins.asof_join(events.where("event_type = 'purchase'"), events.where("event_type = 'view'"), ["user_id"], "ts", "ts", "value")
    return at.select("user_id", "event_id", F.when(F.col("value") >= F.col("asof_value") + 10, "buy").when(F.col("value") <= F.col("asof_value"), "sell").otherwise("unknown").alias("side"))


@query("""SELECT p_partkey, w AS word FROM part, (VALUES ('STEEL'), ('BRASS'), ('TIN'), ('COPPER'), ('NICKEL'), ('SMALL'), ('a'), ('1')) v(w) WHERE contains(p_type, w)""")
def contained_words(spark, d):
    words = spark.createDataFrame([(w,) for w in ("STEEL", "BRASS", "TIN", "COPPER", "NICKEL", "SMALL", "a", "1")], "word string")
    parts = _t(spark, d, "part")
    return parts.join(F.broadcast(words), F.contains("p_type", "word")).select("p_partkey", "word")


@query("""SELECT c_custkey, split_part(c_name, '#', 2) AS suffix, 'C' || lpad(c_custkey::VARCHAR, 8, '0') AS label, '{"k":' || c_custkey || ',"n":' || c_nationkey || '}' AS canonical, regexp_matches(c_mktsegment, 'BUILD|AUTO|a') AS forbidden FROM customer""")
def customer_labels(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", F.split_part("c_name", F.lit("#"), F.lit(2)).alias("suffix"), F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("label"), F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))).alias("canonical"), F.col("c_mktsegment").rlike("BUILD|AUTO|a").alias("forbidden"))


@query("""SELECT event_id, (i - 1)::INTEGER AS ordinal, CASE i WHEN 1 THEN (props->>'k')::BIGINT ELSE user_id END AS item FROM events, range(1, 3) r(i)""")
def json_items(spark, d):
    array = F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit(","), F.col("user_id").cast("string"), F.lit("]"))
    return _t(spark, d, "events").select("event_id", F.posexplode(F.from_json(array, "array<bigint>")).alias("ordinal", "item"))

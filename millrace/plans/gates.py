"""Queries of matching, clocks, replays and publication checks over the driver tables, each with its SQL. Every query reads its tables whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators import bars, books, contracts, ledger, matches, minutes, publication, scans, settlement, windows
from millrace.plans.market import OHLC_SQL, _t
from millrace.sources import bundles, snapshots

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("""WITH a AS (SELECT o_orderkey AS id, least(o_custkey, o_orderkey % 5) AS p, greatest(o_custkey, o_orderkey % 5) AS q, epoch_us(o_orderdate) // 1000000 AS t FROM orders), b AS (SELECT id AS b_id, p, q, t + 86400 * (1 + id % 3) AS bt FROM a),
 f AS (SELECT a.id, b.b_id FROM a JOIN b ON a.p = b.p AND a.q = b.q AND abs(t - bt) <= 172800), n AS (SELECT id, count(*) AS n, min(b_id) AS b_id FROM f GROUP BY 1), m AS (SELECT b_id, count(*) AS m FROM f GROUP BY 1)
 SELECT a.id AS o_orderkey, CASE WHEN n = 1 AND m = 1 THEN n.b_id END AS match_id, CASE WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'many' WHEN m > 1 THEN 'taken' END AS reason FROM a LEFT JOIN n USING (id) LEFT JOIN m ON m.b_id = n.b_id""")
def mutual_matches(spark, d):
    """Orders against records of them one to three days later with the two sides of their pair swapped."""
    a = _t(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 5).alias("side"), "o_orderdate")
    moved = F.col("o_orderdate") + F.make_dt_interval(days=(1 + F.col("o_orderkey") % 3).cast("int"))
    b = a.select(F.col("o_orderkey").alias("match_id"), F.col("side").alias("home"), F.col("o_custkey").alias("away"), moved.alias("at"))
    return matches.mutual_match(a, b, "o_orderkey", "match_id", ("o_custkey", "side"), ("home", "away"), "o_orderdate", "at", 172_800)


@query("""WITH p AS (SELECT o_orderkey AS k, o_orderdate AS t, 2700 + o_orderkey % 400 - CASE WHEN o_orderkey % 50 = 0 THEN 1000 ELSE 0 END AS s FROM orders), e AS (SELECT l_orderkey AS k, max(l_linenumber) AS shown FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
 n AS (SELECT k, t, s, 45 + greatest(coalesce(shown, 0), CASE WHEN s > 2700 THEN (s - 2700 + 59) // 60 ELSE 0 END) AS n FROM p LEFT JOIN e USING (k)),
 b AS (SELECT *, unnest(range(0, n)) AS i FROM n WHERE (n - 1) * 60 < s)
 SELECT k AS match_id, CASE WHEN i < 45 THEN (i + 1)::VARCHAR ELSE '45+' || (i - 44) END AS label, t + to_minutes(i) AS band_start, CASE WHEN i = n - 1 THEN t + to_seconds(s) ELSE t + to_minutes(i + 1) END AS band_end, NULL::VARCHAR AS issue FROM b
 UNION ALL SELECT k, NULL, NULL, NULL, 'too_short' FROM n WHERE (n - 1) * 60 >= s""")
def half_bands(spark, d):
    """First halves that begin with orders and last up to seven minutes longer, or are cut short; lines are the stoppage shown."""
    length = 2700 + F.col("o_orderkey") % 400 - F.when(F.col("o_orderkey") % 50 == 0, 1000).otherwise(0)
    periods = _t(spark, d, "orders").select(F.col("o_orderkey").alias("match_id"), F.lit("1H").alias("period"), F.lit(1).alias("first_minute"), F.lit(45).alias("last_minute"), F.col("o_orderdate").alias("started_at"), (F.col("o_orderdate") + F.make_dt_interval(secs=length.cast("decimal(18,6)"))).alias("ended_at"))
    events = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("match_id"), F.lit("1H").alias("period"), F.lit(45).alias("match_minute"), F.when(F.col("l_returnflag") == "N", F.col("l_linenumber")).alias("stoppage_minute"))
    return matches.minute_bands(periods, events).select("match_id", "label", "band_start", "band_end", "issue")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def replayed_orders(spark, d):
    """All orders, twice, replayed onto those before 1998: what is new is added once, the rest must be identical."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    o = _t(spark, d, "orders")
    return publication.append_replay(o.where(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")).select(*columns), o.select(*columns).unionByName(o.select(*columns)), ["o_orderkey"])


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 7 = 0 AND o_totalprice IS NOT NULL THEN 'o_totalprice' END, CASE WHEN o_orderkey % 11 = 0 AND o_custkey IS NOT NULL THEN 'o_custkey' END) AS columns FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def replay_changes(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    batch = o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("o_custkey"))
    return publication.replay_differences(o, batch, ["o_orderkey"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("""WITH p AS (SELECT o_custkey, o_orderpriority, count(*) AS n, count_if(o_orderstatus = 'F') AS f FROM orders GROUP BY 1, 2), r AS (SELECT o_custkey, sum(n)::BIGINT AS pages, count_if(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS known, count_if(f <> 1) AS open FROM p GROUP BY 1)
 SELECT r.o_custkey, pages, nullif(concat_ws(',', CASE WHEN known < 5 THEN 'missing_pass' END, CASE WHEN open > 0 THEN 'incomplete' END, CASE WHEN c_acctbal < 0 THEN 'issues' END), '') AS reasons FROM r LEFT JOIN customer ON c_custkey = r.o_custkey""")
def crawl_states(spark, d):
    """Customers as crawls, their orders as pages of a pass for each priority; customers in debt have issues."""
    pages = _t(spark, d, "orders").withColumn("done", F.col("o_orderstatus") == "F")
    issues = _t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return publication.crawl_readiness(pages, issues, PRIORITIES, "o_custkey", "o_orderpriority", "done")


@query("""WITH s AS (SELECT l_partkey AS token, l_shipdate AS stamp, md5(l_orderkey || '-' || l_linenumber) AS digest FROM lineitem), w AS (SELECT token, CASE WHEN token % 9 = 0 THEN 'pending' ELSE 'loaded' END AS status, count(*) - (token % 7 = 0)::INT AS n, count(*) AS h FROM s GROUP BY 1),
 k AS (SELECT token, digest, count(*) AS h FROM s GROUP BY 1, 2)
 SELECT (SELECT count_if(status = 'pending')::BIGINT FROM w) AS open_windows, (SELECT count_if(status = 'loaded' AND n <> h)::BIGINT FROM w) AS invalid_windows, (SELECT count(*) FROM (SELECT token, stamp FROM s GROUP BY 1, 2 HAVING count(DISTINCT digest) > 1)) AS contradictions,
 (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT token FROM s)) AS missing_tokens, (SELECT count_if(token % 9 = 0)::BIGINT FROM k) AS strange_hashes, (SELECT sum(h - 1)::BIGINT FROM k) AS repeated, (SELECT count(*) FROM s) AS snapshots""")
def book_scan(spark, d):
    """Lines as snapshots of parts; every ninth part's window is pending, every seventh's says one less than it has."""
    s = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("token"), F.col("l_shipdate").alias("at"), F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))).alias("digest"))
    w = s.groupBy("token").agg(F.collect_list("digest").alias("hashes")).withColumn("snapshot_count", F.size("hashes") - (F.col("token") % 7 == 0).cast("int")).withColumn("status", F.when(F.col("token") % 9 == 0, "pending").otherwise("loaded"))
    return publication.book_scan_issues(w, s, _t(spark, d, "part").select(F.col("p_partkey").alias("token")), ["at"]).drop("aggregate_sha256")


@query("""WITH r AS (SELECT l_partkey AS part, year(l_shipdate) * 12 + month(l_shipdate) AS m, max(l_returnflag || l_linestatus) AS content FROM lineitem GROUP BY 1, 2), c AS (SELECT m, row_number() OVER (ORDER BY m) AS n FROM (SELECT DISTINCT m FROM r WHERE m % 5 <> 0)),
 s AS (SELECT part, content, n FROM r JOIN c USING (m)), g AS (SELECT *, coalesce(lag(n) OVER w <> n - 1 OR lag(content) OVER w <> content, true)::INT AS new FROM s WINDOW w AS (PARTITION BY part ORDER BY n)),
 v AS (SELECT *, sum(new) OVER (PARTITION BY part ORDER BY n) AS version FROM g), x AS (SELECT part, version, any_value(content) AS content, min(n) AS lo, max(n) AS hi, count(*) AS n_crawls FROM v GROUP BY 1, 2)
 SELECT part, content, a.m AS valid_from, b.m AS valid_to, n_crawls FROM x JOIN c a ON a.n = lo LEFT JOIN c b ON b.n = hi + 1""")
def graph_versions(spark, d):
    """Parts as nodes, months as crawls, of which every fifth failed."""
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    rows = _t(spark, d, "lineitem").groupBy(month.alias("crawl_id"), F.col("l_partkey").alias("part")).agg(F.max(F.concat("l_returnflag", "l_linestatus")).alias("content"))
    crawls = _t(spark, d, "lineitem").select(month.alias("crawl_id")).distinct().select("crawl_id", F.col("crawl_id").alias("observed_at"), F.when(F.col("crawl_id") % 5 == 0, "failed").otherwise("complete").alias("status"))
    return publication.graph_history(rows, crawls, ["part"], "content")


@query("""WITH e AS (SELECT o_orderkey AS k, 'c' || o_custkey AS s, 'n' || (o_orderkey % 30) AS t FROM orders), n AS (SELECT 'c' || c_custkey AS id, c_custkey % 50 = 0 AS bad FROM customer UNION ALL SELECT 'n' || n_nationkey, false FROM nation), i AS (
 SELECT 'dangling_edge' AS issue, count(*) AS rows FROM e WHERE s NOT IN (SELECT id FROM n) OR t NOT IN (SELECT id FROM n) UNION ALL SELECT 'lone_node', count(*) FROM n WHERE id NOT IN (SELECT s FROM e UNION ALL SELECT t FROM e)
 UNION ALL SELECT 'bad_hash', count(*) FROM e WHERE k % 100 = 0 UNION ALL SELECT 'bad_json', count(*) FROM n WHERE bad UNION ALL SELECT 'bad_count', abs(count(*) - 1000) FROM n) SELECT * FROM i WHERE rows > 0""")
def graph_checks(spark, d):
    """Customers and nations as nodes, orders as edges between them, some to nations that do not exist."""
    c, n = _t(spark, d, "customer"), _t(spark, d, "nation")
    node = lambda df, prefix, key, name: df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("node_id"), F.lit(prefix).alias("kind"), F.col(name).alias("content"), F.sha2(name, 256).alias("content_sha256"))
    broken = F.when(F.col("kind") == "n", "{}").when(F.substring("node_id", 2, 20).cast("long") % 50 == 0, "{").otherwise("{}")
    nodes = node(c, "c", "c_custkey", "c_name").unionByName(node(n, "n", "n_nationkey", "n_name")).withColumn("properties_json", broken)
    text = F.col("o_orderkey").cast("string")
    edges = _t(spark, d, "orders").select(text.alias("edge_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("source_id"), F.concat(F.lit("n"), (F.col("o_orderkey") % 30).cast("string")).alias("target_id"), text.alias("content"), F.sha2(F.when(F.col("o_orderkey") % 100 == 0, F.lit("")).otherwise(text), 256).alias("content_sha256"))
    return publication.graph_issues(nodes, edges, {"nodes": 1000})


SEGMENT = 500


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS carried, (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS errors, max(user_id) OVER w AS high FROM events
 WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def scan_of_one_key(spark, d):
    """Running values over all events as one key, in segments of 500 rows."""
    e = _t(spark, d, "events").withColumn("all", F.lit(1))
    found = {"carried": scans.last_seen(F.when(F.col("event_type") == "purchase", F.col("value"))), "errors": scans.Scan("sum", F.when(F.col("event_type") == "error", 1).otherwise(0)), "high": scans.Scan("max", F.col("user_id"))}
    return scans.scan(e, ["all"], ["ts", "event_id"], found, SEGMENT).select("event_id", *found)


@query("""WITH i AS (SELECT l_returnflag AS k, epoch_us(l_shipdate) // 1000000 AS lo, epoch_us(l_shipdate) // 1000000 + (l_quantity * 100)::BIGINT AS hi FROM lineitem), n AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM i),
 g AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS grp FROM n) SELECT k, min(lo) AS lo, max(hi) AS hi, count(*) AS members FROM g GROUP BY k, grp""")
def intervals_of_large_keys(spark, d):
    """Intervals of three keys that hold all lines, in segments of 500 rows."""
    lo = floor_epoch(F.col("l_shipdate"), 1)
    i = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("k"), lo.alias("lo"), (lo + (F.col("l_quantity") * 100).cast("long")).alias("hi"))
    return windows.merge_intervals(i, ["k"], "lo", "hi", SEGMENT)


BARS_SQL = OHLC_SQL.format(key="user_id, event_type", ts="ts", p="value", t="events", s=60)


@query(f"""WITH b AS ({BARS_SQL}), w AS (SELECT user_id, epoch_us(min(ts)) // 60000000 * 60 AS lo, (epoch_us(min(ts)) + 21600000000) // 60000000 * 60 AS hi FROM events GROUP BY 1), o AS (SELECT b.* FROM b JOIN w USING (user_id) WHERE event_type IN ('view', 'purchase') AND bucket BETWEEN lo AND hi),
 s AS (SELECT user_id, unnest(range(lo, hi + 60, 60)) AS m FROM w WHERE user_id IN (SELECT user_id FROM o)), j AS (SELECT s.*, y.open_price AS y_open, y.close_price AS y, n.close_price AS n FROM s LEFT JOIN o y ON y.user_id = s.user_id AND y.bucket = m AND y.event_type = 'view' LEFT JOIN o n ON n.user_id = s.user_id AND n.bucket = m AND n.event_type = 'purchase'),
 c AS (SELECT *, last_value(y IGNORE NULLS) OVER w AS yc, last_value(n IGNORE NULLS) OVER w AS nc FROM j WINDOW w AS (PARTITION BY user_id ORDER BY m ROWS UNBOUNDED PRECEDING))
 SELECT user_id::VARCHAR AS market_id, m AS odds_minute_epoch, y IS NOT NULL AS is_observed, coalesce(y_open, yc) AS open_price, yc AS close_price, n IS NOT NULL AS is_no_observed, nc AS no_close_price FROM c""")
def dense_market_minutes(spark, d):
    """Users as markets of two tokens, their views and purchases, over the six hours from their first event."""
    return _dense(spark, d).select("market_id", "odds_minute_epoch", "is_observed", "open_price", "close_price", "is_no_observed", "no_close_price")


def _dense(spark, d):
    e = _t(spark, d, "events")
    ohlc = bars.ohlc(e, ["user_id", "event_type"], "ts", "value", 60).select(F.col("user_id").cast("string").alias("market_id"), F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("clob_token_id"), F.col("bucket").alias("odds_minute_epoch"), *minutes.PRICES, *minutes.OBSERVED)
    user = F.col("user_id").cast("string")
    registry = e.groupBy("user_id").agg(F.min("ts").alias("window_start_at")).select(user.alias("market_id"), F.concat(user, F.lit("-view")).alias("yes_token_id"), F.concat(user, F.lit("-purchase")).alias("no_token_id"), "window_start_at", (F.col("window_start_at") + F.make_dt_interval(hours=F.lit(6))).alias("window_end_at"))
    return minutes.dense_minutes(minutes.observed_minutes(registry, ohlc))


@query(f"""WITH b AS ({BARS_SQL}), w AS (SELECT user_id, epoch_us(min(ts)) // 60000000 * 60 AS lo, (epoch_us(min(ts)) + 21600000000) // 60000000 * 60 AS hi FROM events GROUP BY 1), o AS (SELECT b.* FROM b JOIN w USING (user_id) WHERE event_type IN ('view', 'purchase') AND bucket BETWEEN lo AND hi)
 SELECT (361 * count(DISTINCT user_id))::BIGINT AS minutes, count(DISTINCT user_id) AS markets, count(DISTINCT user_id) - count(DISTINCT user_id) FILTER (event_type = 'view') AS unobserved, 0::BIGINT AS axis FROM o""")
def dense_minute_quality(spark, d):
    return minutes.minute_quality(_dense(spark, d)).select("minutes", "markets", "unobserved", "axis")


@query("""WITH f AS (SELECT l_suppkey AS p, CASE l_returnflag WHEN 'A' THEN 'yes' ELSE 'no' END AS side, epoch_us(l_shipdate) // 60000000 * 60 AS m, round(l_discount * 100)::BIGINT + 10 AS cents, l_quantity AS q, struct_pack(a := l_orderkey, b := l_linenumber, c := round(l_extendedprice * 100)::BIGINT) AS chain FROM lineitem
   WHERE l_returnflag <> 'N' AND l_orderkey % 5 <> 0 AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2000-01-01')
 SELECT p::VARCHAR AS proposition_id, side AS outcome_side, m AS minute_epoch, arg_min(cents, chain) / 100 AS open_price, arg_max(cents, chain) / 100 AS close_price, max(cents) / 100 AS high_price, count(*) AS fills, sum(q) AS share_volume, round(sum(q * cents) / sum(q) / 100, 9) AS vwap FROM f GROUP BY 1, 2, 3""")
def settlement_bars(spark, d):
    """Lines as fills of two tokens a supplier, of a published and of an older scan."""
    price = ((F.round(F.col("l_discount") * 100) + 10).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,18)")
    quantity = F.col("l_quantity").cast("decimal(20,6)")
    fills = _t(spark, d, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 == 0, "old").otherwise("new").alias("scan_id"), F.col("l_suppkey").cast("string").alias("proposition_id"), F.concat_ws("-", F.col("l_suppkey").cast("string"), "l_returnflag").alias("token_id"), F.col("l_shipdate").alias("block_timestamp"), F.col("l_orderkey").alias("block_number"),
        F.col("l_linenumber").cast("long").alias("transaction_index"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("log_index"), F.lit(0).alias("ordinal"), price.alias("price"), quantity.cast("decimal(38,6)").alias("share_volume"), (quantity * price.cast("decimal(10,6)")).cast("decimal(38,6)").alias("collateral_volume"), F.lit(False).alias("is_derived"),
    )
    day = lambda year: F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")
    sides = F.explode(F.array(F.struct(F.lit("A").alias("flag"), F.lit("yes").alias("side")), F.struct(F.lit("R").alias("flag"), F.lit("no").alias("side"))))
    tokens = _t(spark, d, "supplier").withColumn("s", sides).select(F.col("s_suppkey").cast("string").alias("proposition_id"), F.concat_ws("-", F.col("s_suppkey").cast("string"), "s.flag").alias("token_id"), F.col("s.side").alias("outcome_side"), day(1996).alias("window_lo"), day(2000).alias("window_hi"))
    runs = fills.select("scan_id").distinct().select("scan_id", F.lit("published").alias("status"), F.lit(True).alias("raw_published"), F.when(F.col("scan_id") == "new", day(2001)).otherwise(day(2000)).alias("published_at"), day(2000).alias("finished_at"))
    found = minutes.settlement_minutes(fills, tokens, runs)
    double = lambda c: F.col(c).cast("double").alias(c)
    return found.select("proposition_id", "outcome_side", "minute_epoch", double("open_price"), double("close_price"), double("high_price"), "fills", double("share_volume"), F.round(F.col("vwap").cast("double"), 9).alias("vwap"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderkey % 7 AS planned, o_orderkey % 8 AS processed, o_orderkey % 13 AS n, o_orderkey % 4 + o_orderkey % 3 AS answers, o_orderkey % 5 AS errors, o_orderkey % 10 AS tokens, o_orderkey % 11 - 1 AS covered,
 lag(o_orderkey % 5) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders)
 SELECT o_custkey, o_orderkey, 'negative' AS issue FROM r WHERE covered < 0 UNION ALL SELECT o_custkey, o_orderkey, 'planned' FROM r WHERE planned < processed UNION ALL SELECT o_custkey, o_orderkey, 'http' FROM r WHERE answers > 4
 UNION ALL SELECT o_custkey, o_orderkey, 'ratio' FROM r WHERE tokens > 0 AND n < tokens * 0.5 UNION ALL SELECT o_custkey, o_orderkey, 'coverage' FROM r WHERE tokens > 0 AND covered < tokens * 0.75 UNION ALL SELECT o_custkey, o_orderkey, 'regression' FROM r WHERE errors > before""")
def run_issues(spark, d):
    """Orders as runs of their customers' jobs."""
    k = F.col("o_orderkey")
    runs = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", (k % 7).alias("planned"), (k % 8).alias("processed"), (k % 13).alias("rows"), F.lit(4).alias("requests"), (k % 4).alias("http_ok"), (k % 3).alias("http_errors"), (k % 5).alias("errors"), (k % 10).alias("tokens"), (k % 11 - 1).alias("covered"))
    return contracts.run_contract(runs, "o_custkey", "o_orderkey", "o_orderdate", 0.5, 0.75)


@query("""WITH c AS (SELECT l_suppkey AS k, l_orderkey * 10 AS lo, l_orderkey * 10 + l_quantity::BIGINT AS hi FROM lineitem), r AS (SELECT s_suppkey AS k, 0 AS f, 600000 AS t FROM supplier),
 o AS (SELECT c.*, f, t, lag(hi) OVER w AS before, lead(lo) OVER w AS after FROM c FULL JOIN r USING (k) WINDOW w AS (PARTITION BY c.k ORDER BY lo, hi)), i AS (
 SELECT k, 'unknown' AS issue FROM o WHERE f IS NULL UNION ALL SELECT k, 'gap' FROM o WHERE lo > coalesce(before + 1, f) OR (after IS NULL AND hi < t) UNION ALL SELECT k, 'overlap' FROM o WHERE lo <= before UNION ALL SELECT k, 'outside' FROM o WHERE lo < f OR hi > t UNION ALL SELECT k, 'missing' FROM o WHERE lo IS NULL)
 SELECT k AS l_suppkey, issue, count(*) AS rows FROM i GROUP BY 1, 2""")
def range_issues(spark, d):
    """Lines as scanned chunks of their suppliers' ranges."""
    chunks = _t(spark, d, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 10).alias("from_block"), (F.col("l_orderkey") * 10 + F.col("l_quantity").cast("long")).alias("to_block"))
    ranges = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(0).alias("from_block"), F.lit(600_000).alias("to_block"))
    return contracts.range_contract(ranges, chunks, ["l_suppkey"])


@query("""WITH s AS (SELECT event_type AS source, max(ts) AS seen FROM events GROUP BY 1), x AS (SELECT DISTINCT event_type AS source FROM events UNION ALL SELECT 'none')
 SELECT source, CASE WHEN seen IS NULL THEN 'missing' WHEN seen > TIMESTAMP '2024-01-30 12:00:00' THEN 'future' WHEN epoch_us(TIMESTAMP '2024-01-30 12:00:00') // 1000000 - epoch_us(seen) // 1000000 > 3600 THEN 'stale' ELSE 'ready' END AS state FROM x LEFT JOIN s USING (source)""")
def source_states(spark, d):
    e = _t(spark, d, "events")
    sources = e.select(F.col("event_type").alias("source")).distinct().unionByName(spark.createDataFrame([("none",)], "source string")).withColumn("max_age_s", F.lit(3600))
    return contracts.readiness(sources, e.select(F.col("event_type").alias("source"), F.col("ts").alias("at")), F.lit(dt.datetime(2024, 1, 30, 12)).cast("timestamp_ntz")).select("source", "state")


@query("""WITH e AS (SELECT o_custkey AS event_id, o_orderkey AS market_id, o_orderpriority AS role, epoch_us(o_orderdate) // 60000000 * 60 AS lo, epoch_us(o_orderdate) // 60000000 * 60 + 60 * (o_orderkey % 9) AS hi FROM orders),
 t AS (SELECT DISTINCT l_orderkey AS market_id, l_linenumber - 1 AS i FROM lineitem), s AS (SELECT e.*, unnest(range(lo, hi + 60, 60)) AS m FROM e WHERE EXISTS (SELECT 1 FROM t WHERE t.market_id = e.market_id AND lo + 60 * i <= hi)),
 j AS (SELECT s.*, t.i IS NOT NULL AS seen, max(CASE WHEN t.i IS NOT NULL THEN m END) OVER (PARTITION BY s.market_id ORDER BY m ROWS UNBOUNDED PRECEDING) AS last FROM s LEFT JOIN t ON t.market_id = s.market_id AND lo + 60 * i = m),
 g AS (SELECT event_id, market_id, any_value(role) AS role, count(*) AS n, count_if(seen) AS seen, count_if(last IS NULL) AS bare, max((m - last) // 60) AS gap FROM j GROUP BY 1, 2),
 v AS (SELECT event_id, count(*) AS markets, count(DISTINCT role) AS roles, sum(n)::BIGINT AS expected, sum(seen)::BIGINT AS observed, sum(bare) AS bare, coalesce(max(gap), 0) AS longest_gap FROM g GROUP BY 1)
 SELECT event_id, markets, expected, observed, longest_gap, nullif(concat_ws(',', CASE WHEN markets <> 3 OR roles <> 3 THEN 'markets' END, CASE WHEN bare > 0 THEN 'prices' END, CASE WHEN observed * 100 < expected * 60 THEN 'coverage' END, CASE WHEN longest_gap > 3 THEN 'gap' END), '') AS reasons FROM v""")
def modeling_events(spark, d):
    """Customers as events, their orders as markets of up to nine minutes, lines as the minutes in which they were seen."""
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("event_id"), F.col("o_orderkey").alias("market_id"), F.col("o_orderpriority").alias("result_role"), F.concat(F.lit("y"), F.col("o_orderkey").cast("string")).alias("yes_token_id"), F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("no_token_id"), F.col("o_orderdate").alias("window_start_at"), (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 9).cast("int"))).alias("window_end_at"))
    at = F.col("o_orderdate") + F.make_dt_interval(mins=F.col("l_linenumber") - 1)
    ticks = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("market_id"), F.concat(F.lit("y"), F.col("o_orderkey").cast("string")).alias("clob_token_id"), at.alias("ts"), F.col("l_discount").alias("price"))
    ohlc = bars.ohlc(ticks, ["market_id", "clob_token_id"], "ts", "price", 60).withColumnRenamed("bucket", "odds_minute_epoch")
    return minutes.modeling_games(minutes.dense_minutes(minutes.observed_minutes(o, ohlc)), 60)


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def reference_tables(spark, d):
    """Nations and regions as a reference bundle: written, checked against its contract, taken over and read."""
    root = snapshots.shared_root(spark, "reference")
    bundles.write_bundle({"nation": (_t(spark, d, "nation"), ["n_nationkey"]), "region": (_t(spark, d, "region"), ["r_regionkey"])}, f"{root}/bundle")
    contract = {n: (", ".join(f"{c} {t}" for c, t in _t(spark, d, n).dtypes), [k]) for n, k in (("nation", "n_nationkey"), ("region", "r_regionkey"))}
    bundles.take_over(spark, f"{root}/bundle", root, contract)
    nation, region = (bundles.current(spark, root, n) for n in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE o_orderdate >= TIMESTAMP '1999-01-01' OR n <= 2""")
def pruned_runs(spark, d):
    """Orders as runs: those since 1999, and the last two of each customer and status."""
    cutoff = F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz")
    return ledger.prune_runs(_t(spark, d, "orders"), ["o_custkey"], "o_orderstatus", ["o_orderdate", "o_orderkey"], cutoff, 2).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS times, max(ts) >= TIMESTAMP '2024-01-20' AS is_open FROM events GROUP BY 1, 2""")
def alert_history(spark, d):
    """Events as alerts: those before 20 January as history, the later ones merged into it; equals all at once."""
    e, cut = _t(spark, d, "events"), F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz")
    key = ["user_id", "event_type"]
    none = e.limit(0).select(*key, F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"), F.lit(0).cast("long").alias("times"))
    return ledger.merge_alerts(ledger.merge_alerts(none, e.where(F.col("ts") < cut), key, "ts"), e.where(F.col("ts") >= cut), key, "ts")


def _ms(c):
    return floor_epoch(c, 1) * 1000 + (F.date_part(F.lit("SECONDS"), c) * 1000 % 1000).cast("long")


@query("""WITH s AS (SELECT event_id, user_id, epoch_ms(ts) AS ms, value - lag(value) OVER (PARTITION BY user_id ORDER BY epoch_ms(ts)) AS change FROM events WHERE event_type = 'view'), u AS (SELECT event_id, user_id, ms, change, NULL AS size FROM s UNION ALL SELECT NULL, user_id, epoch_ms(ts), NULL, value FROM events WHERE event_type = 'purchase'),
 w AS (SELECT event_id, sum(size) OVER w AS v, stddev_pop(change) OVER w AS d FROM u WINDOW w AS (PARTITION BY user_id ORDER BY ms RANGE BETWEEN 86399999 PRECEDING AND CURRENT ROW))
 SELECT event_id, round(coalesce(v, 0), 6) AS rolling_volume, round(d, 6) AS rolling_deviation FROM w WHERE event_id IS NOT NULL""")
def rolling_day(spark, d):
    """Views as states of a book, purchases as trades, over a day."""
    e = _t(spark, d, "events").withColumn("ms", _ms(F.col("ts")))
    found = books.rolling_metrics(e.where("event_type = 'view'").select("event_id", "user_id", "ms", "value"), e.where("event_type = 'purchase'").select("user_id", "ms", "value"), ["user_id"], "ms", "value", "value", 86_400_000)
    return found.select("event_id", F.round("rolling_volume", 6).alias("rolling_volume"), F.round("rolling_deviation", 6).alias("rolling_deviation"))


@query("""WITH b AS (SELECT user_id, ts, max(value) * 0.9 AS bid, max(value) * 1.1 AS ask FROM events WHERE event_type = 'view' GROUP BY 1, 2), t AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
 SELECT event_id, CASE WHEN value >= ask THEN 'buy' WHEN value <= bid THEN 'sell' ELSE 'unknown' END AS aggressor FROM t ASOF LEFT JOIN b ON t.user_id = b.user_id AND t.ts >= b.ts""")
def aggressor_sides(spark, d):
    """Purchases as trades against the books that views show."""
    e = _t(spark, d, "events")
    book = e.where("event_type = 'view'").select("user_id", "ts", (F.col("value") * 0.9).alias("best_bid"), (F.col("value") * 1.1).alias("best_ask"))
    return books.aggressor_side(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value"), book, ["user_id"], "ts", "value").select("event_id", "aggressor")


@query("""WITH w AS (SELECT DISTINCT l_suppkey AS k, l_shipdate AS lo, l_shipdate + INTERVAL 36 HOUR AS hi FROM lineitem), b AS (SELECT DISTINCT date_diff('day', DATE '1990-01-01', o_orderdate::DATE) AS n, o_orderdate AS seen FROM orders), b1 AS (SELECT seen, min(n) AS n FROM b GROUP BY 1),
 f AS (SELECT k, lo, hi, n AS f FROM w ASOF JOIN b1 ON w.lo <= b1.seen), r AS (SELECT k, f, n AS t FROM f ASOF JOIN b1 ON f.hi > b1.seen), g AS (SELECT *, CASE WHEN f <= 1 + max(t) OVER (PARTITION BY k ORDER BY f, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM r WHERE f <= t),
 m AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY f, t ROWS UNBOUNDED PRECEDING) AS grp FROM g) SELECT k, min(f) AS from_block, max(t) AS to_block FROM m GROUP BY k, grp""")
def supplier_block_ranges(spark, d):
    """Lines as windows of 36 hours, days with orders as blocks."""
    w = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("window_lo"), (F.col("l_shipdate") + F.make_dt_interval(hours=F.lit(36))).alias("window_hi")).distinct()
    blocks = _t(spark, d, "orders").select(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long").alias("block_number"), F.col("o_orderdate").alias("block_timestamp")).distinct()
    return settlement.block_ranges(w, blocks, ["k"])

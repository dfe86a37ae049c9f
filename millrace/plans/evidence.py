"""Queries of execution evidence, of the second venue's marts and of release summaries over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.columns import floor_epoch
from millrace.operators import catalog, evidence, ledger, venues, windows
from millrace.plans.gates import _ms
from millrace.plans.ledger import NOW
from millrace.plans.market import _t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("""WITH r AS (SELECT event_id, user_id % 20 AS token, CASE WHEN event_id % 97 = 0 THEN '' ELSE (event_id - CASE WHEN event_id % 40 = 39 THEN 1 ELSE 0 END)::VARCHAR END AS id, epoch_us(ts) // 1000 AS ms, event_id % 89 = 0 AS half, event_id % 83 = 0 AS other,
  ((event_id % 120)::DECIMAL(8,2) * 0.01)::DECIMAL(20,18) AS price, floor(value)::BIGINT::DECIMAL(28,10) AS amount FROM events),
 i AS (SELECT *, CASE WHEN id = '' THEN 'id' WHEN half THEN 'timestamp' WHEN ms NOT BETWEEN 1704153600000 AND 1706227200000 THEN 'window' WHEN other THEN 'outcome' WHEN price > 1 THEN 'price' WHEN amount <= 0 THEN 'amount' END AS issue FROM r),
 n AS (SELECT *, row_number() OVER (PARTITION BY token, id, issue IS NULL ORDER BY ms, price, amount) AS k FROM i), m AS (SELECT * REPLACE (CASE WHEN issue IS NULL AND k > 1 THEN 'repeated' ELSE issue END AS issue) FROM n)
 SELECT event_id, CASE WHEN half THEN NULL ELSE ms END AS at_ms, issue, CASE WHEN issue IS NULL THEN row_number() OVER (PARTITION BY token, issue IS NULL ORDER BY ms, id) - 1 END AS event_sequence,
 CASE WHEN issue IS NULL THEN sha256(concat_ws('|', token::VARCHAR, id, ms::VARCHAR, price::VARCHAR, amount::VARCHAR)) END AS identity_sha256 FROM m""")
def normalized_trades(spark, d):
    """Events as trades that a venue returned, some of them unsound or sent twice."""
    e, n = _t(spark, d, "events"), F.col("event_id") % 120
    ms = _ms(F.col("ts"))
    raw = e.select(
        "event_id", (F.col("user_id") % 20).alias("token_id"), F.when(F.col("event_id") % 97 == 0, " ").otherwise((F.col("event_id") - F.when(F.col("event_id") % 40 == 39, 1).otherwise(0)).cast("string")).alias("trade_id"),
        F.concat(ms.cast("string"), F.when(F.col("event_id") % 89 == 0, ".5").otherwise("")).alias("timestamp"), F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0")).alias("price"),
        F.floor("value").cast("string").alias("amount"), F.when(F.col("event_id") % 83 == 0, "another").alias("outcome_id"), F.lit(1704153600000).alias("window_lo_ms"), F.lit(1706227200000).alias("window_hi_ms"),
    )
    return evidence.normalize_trades(raw).select("event_id", "at_ms", "issue", "event_sequence", "identity_sha256")


TARGETS_SQL = """WITH o AS (SELECT 'y' || p_partkey AS token, p_partkey AS market, 'Yes' AS label FROM part UNION ALL SELECT 'n' || p_partkey, p_partkey, 'No' FROM part WHERE p_partkey % 17 <> 0),
 i AS (SELECT p_partkey AS k, 'y' || p_partkey AS s, 'y' || (p_partkey + 1) AS t FROM part WHERE p_partkey % 29 <> 0),
 g AS (SELECT l_partkey AS k, epoch(l_shipdate)::BIGINT + (l_linenumber % 2) * 60 + CASE WHEN l_orderkey % 31 = 0 THEN 7 ELSE 0 END AS e, (l_linenumber / 10.0)::DOUBLE AS p, ((l_suppkey % 5 + 1) / 10.0)::DOUBLE AS q FROM lineitem),
 j AS (SELECT g.k, g.e, i.k AS known, a.market AS m, n.token AS source_no, i.t AS target_yes, b.token AS bt, count(*) OVER (PARTITION BY g.k, g.e) AS times,
  1 - p - q - greatest(round(0.03::DOUBLE * p * (1 - p), 5), 0) - greatest(round(0.03::DOUBLE * q * (1 - q), 5), 0) AS edge
  FROM g LEFT JOIN i ON i.k = g.k LEFT JOIN o a ON a.token = i.s LEFT JOIN o n ON n.market = a.market AND n.label = 'No' LEFT JOIN o b ON b.token = i.t),
 x AS (SELECT *, sha256(k || chr(0) || e) AS target_id, (e + 60) * 1000 AS decision_ms, CASE WHEN known IS NULL THEN 'implication' WHEN m IS NULL OR bt IS NULL THEN 'endpoint' WHEN source_no IS NULL THEN 'label'
  WHEN e % 60 <> 0 THEN 'time' WHEN edge < 0.01::DOUBLE THEN 'edge' WHEN times > 1 THEN 'repeated' END AS issue FROM j)"""


def _targets(spark, d):
    """Parts as markets with two tokens; each implies the next one. Lines as signals."""
    p, l = _t(spark, d, "part").select("p_partkey"), _t(spark, d, "lineitem")
    k = F.col("p_partkey")
    name = lambda kind, c: F.concat(F.lit(kind), c.cast("string"))
    outcomes = p.select(name("y", k).alias("token_id"), k.alias("market_id"), F.lit("Yes").alias("label")).unionAll(p.where("p_partkey % 17 <> 0").select(name("n", k), k, F.lit("No")))
    implications = p.where("p_partkey % 29 <> 0").select(k.alias("implication_id"), name("y", k).alias("source_token"), name("y", k + 1).alias("target_token"))
    epoch = floor_epoch(F.col("l_shipdate"), 1) + (F.col("l_linenumber") % 2) * 60 + F.when(F.col("l_orderkey") % 31 == 0, 7).otherwise(0)
    signals = l.select(F.col("l_partkey").alias("implication_id"), epoch.alias("signal_epoch"), (F.col("l_linenumber") / 10.0).alias("source_price"), ((F.col("l_suppkey") % 5 + 1) / 10.0).alias("target_price"))
    return evidence.execution_targets(signals, implications, outcomes)


@query(TARGETS_SQL + " SELECT k AS implication_id, e AS signal_epoch, target_id, decision_ms, round(edge, 9) AS edge, source_no, target_yes, issue FROM x")
def execution_targets(spark, d):
    return _targets(spark, d).select("implication_id", "signal_epoch", "target_id", "decision_ms", F.round("edge", 9).alias("edge"), "source_no", "target_yes", "issue")


@query(TARGETS_SQL + """, l AS (SELECT target_id, 'source_no' AS role, source_no AS token_id, decision_ms FROM x WHERE issue IS NULL UNION ALL SELECT target_id, 'target_yes', target_yes, decision_ms FROM x WHERE issue IS NULL),
 r AS (SELECT *, max(decision_ms) OVER (PARTITION BY token_id ORDER BY decision_ms, target_id, role ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l),
 w AS (SELECT *, sum(CASE WHEN decision_ms - before <= 2 * 86400000 THEN 0 ELSE 1 END) OVER (PARTITION BY token_id ORDER BY decision_ms, target_id, role ROWS UNBOUNDED PRECEDING) AS grp FROM r),
 z AS (SELECT target_id, role, token_id, min(decision_ms) OVER (PARTITION BY token_id, grp) - 86400000 AS window_lo_ms, max(decision_ms) OVER (PARTITION BY token_id, grp) + 86400000 AS window_hi_ms FROM w)
 SELECT *, sha256(concat_ws('|', token_id, window_lo_ms::VARCHAR, window_hi_ms::VARCHAR)) AS window_id FROM z""")
def execution_legs(spark, d):
    """Windows of a day around each decision."""
    return evidence.execution_legs(_targets(spark, d), 86_400).select("target_id", "role", "token_id", "window_lo_ms", "window_hi_ms", "window_id")


@query("""SELECT o_orderkey AS window_id, coalesce(s, 0) AS snapshot_count, coalesce(t, 0) AS trade_count, coalesce(s, 0) = 0 AS empty_book, coalesce(t, 0) = 0 AS empty_trades, CASE WHEN o_orderstatus <> 'P' THEN 'complete' ELSE 'incomplete' END AS status FROM orders
 LEFT JOIN (SELECT l_orderkey AS k, nullif(count(*) FILTER (WHERE l_returnflag <> 'N'), 0) AS s, nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) AS t FROM lineitem GROUP BY 1) ON k = o_orderkey""")
def evidence_coverage(spark, d):
    """Orders as windows, returned lines as books, others as trades."""
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem").withColumn("window_id", F.col("l_orderkey"))
    found = evidence.evidence_coverage(o.withColumn("window_id", F.col("o_orderkey")), l.where("l_returnflag <> 'N'"), l.where("l_returnflag = 'N'"), F.col("o_orderstatus") != "P")
    return found.select("window_id", "snapshot_count", "trade_count", "empty_book", "empty_trades", "status")


VENUE_SQL = """WITH m AS (SELECT p_partkey AS k, p_brand AS team, p_size % 6 AS stage, p_partkey % 2 = 1 AS turned, CASE p_partkey % 7 WHEN 0 THEN 'resolved' WHEN 1 THEN 'closed' WHEN 2 THEN 'inactive' WHEN 3 THEN 'odd' ELSE 'live' END AS status,
  p_partkey % 5 <> 0 AS alive, CASE WHEN p_partkey % 11 = 0 THEN 'Paused' ELSE 'Active' END AS source, p_retailprice AS volume FROM part),
 c AS (SELECT l_partkey AS k, epoch(l_shipdate)::BIGINT AS h, min(l_discount) AS lo, max(l_discount) AS hi, max(l_tax) AS cl, min(l_tax) AS op FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
 b AS (SELECT m.*, h, CASE WHEN turned THEN 1 - op ELSE op END AS op, CASE WHEN turned THEN 1 - lo ELSE hi END AS hi, CASE WHEN turned THEN 1 - hi ELSE lo END AS lo, CASE WHEN turned THEN 1 - cl ELSE cl END AS cl FROM c JOIN m USING (k)),
 n AS (SELECT m.*, p, h, round((967766400 - h) / 3600.0, 4) AS age FROM m LEFT JOIN (SELECT k, arg_max(cl, h) AS p, max(h) AS h FROM b GROUP BY 1) USING (k)),
 s AS (SELECT *, CASE WHEN status = 'resolved' THEN 'historical_resolved' WHEN status = 'closed' THEN 'historical_closed' WHEN status = 'inactive' THEN 'inactive' WHEN status = 'live' AND p IS NULL THEN 'missing_live' WHEN status = 'live' AND age <= 9600 THEN 'fresh_live' WHEN status = 'live' THEN 'stale_live' END AS ps FROM n)"""


def _venue(spark, d):
    """Parts as markets of their brand, the stage by size; every second one is on elimination. Accepted lines give prices by day."""
    p, k = _t(spark, d, "part"), F.col("p_partkey")
    status = F.when(k % 7 == 0, "resolved").when(k % 7 == 1, "closed").when(k % 7 == 2, "inactive").when(k % 7 == 3, "odd").otherwise("live")
    markets = p.select(k.alias("market_id"), F.col("p_brand").alias("team_name"), (F.col("p_size") % 6).alias("stage"), (k % 2 == 1).alias("turned"), status.alias("market_status"), (k % 5 != 0).alias("is_still_alive"), F.when(k % 11 == 0, "Paused").otherwise("Active").alias("source_status"), F.col("p_retailprice").alias("volume"))
    lines = _t(spark, d, "lineitem").where("l_returnflag = 'A'").withColumn("bucket", floor_epoch(F.col("l_shipdate"), 1))
    candles = lines.groupBy(F.col("l_partkey").alias("market_id"), "bucket").agg(F.min("l_tax").alias("open_price"), F.max("l_discount").alias("high_price"), F.min("l_discount").alias("low_price"), F.max("l_tax").alias("close_price"))
    hourly = venues.classified_hourly(markets, candles, F.col("turned"))
    return markets, hourly


def _current(spark, d):
    markets, hourly = _venue(spark, d)
    return venues.classified_current(markets, hourly, F.lit(967766400), 9600)


@query(VENUE_SQL + " SELECT k AS market_id, stage, h AS bucket, op AS open_price, hi AS high_price, lo AS low_price, cl AS close_price FROM b")
def stage_market_prices(spark, d):
    return _venue(spark, d)[1].select("market_id", "stage", "bucket", "open_price", "high_price", "low_price", "close_price")


@query(VENUE_SQL + " SELECT k AS market_id, p AS current_price, h AS current_hour, age AS current_age_hours, ps AS current_price_status, coalesce(alive AND ps = 'fresh_live', false) AS is_actionable FROM s")
def stage_markets_current(spark, d):
    return _current(spark, d).select("market_id", "current_price", "current_hour", "current_age_hours", "current_price_status", "is_actionable")


@query(VENUE_SQL + """, q AS (SELECT k, count(*) AS n, min(h) AS lo, max(h) AS hi FROM b GROUP BY 1)
 SELECT stage, turned, status AS market_status, count(*) AS markets, count(n) AS markets_with_prices, count(*) - count(n) AS markets_without_prices, sum(coalesce(n, 0))::BIGINT AS hourly_rows, count(*) * 100 AS expected_rows, min(coalesce(n, 0)) AS least_rows, max(coalesce(n, 0)) AS most_rows,
 min(q.lo) AS first_hour, max(q.hi) AS last_hour, min(volume) AS least_volume, max(volume) AS most_volume, least(round(sum(coalesce(n, 0))::DOUBLE / (count(*) * 100), 6), 1.0::DOUBLE) AS completeness FROM m LEFT JOIN q USING (k) GROUP BY 1, 2, 3""")
def stage_coverage(spark, d):
    return venues.stage_coverage(*_venue(spark, d), ["stage", "turned", "market_status"], 100, "volume")


@query(VENUE_SQL + """, t AS (SELECT DISTINCT p_brand AS team, CASE WHEN length(p_brand) % 2 = 0 THEN 'active' ELSE 'out' END AS ts FROM part UNION ALL SELECT n_name, 'active' FROM nation), l AS (SELECT lower(team) AS team, count(*) AS n FROM s WHERE status = 'live' GROUP BY 1)
 SELECT CASE WHEN status = 'live' THEN 'live' WHEN status IN ('closed', 'resolved') THEN 'historical' ELSE 'inactive' END || '_missing_hourly_odds:' || k AS issue_key, 'warn' AS severity, team AS team_name, 1 AS issue_count FROM s WHERE p IS NULL AND (status <> 'live' OR alive)
 UNION ALL SELECT 'live_stale_hourly_odds:' || k, 'warn', team, 1 FROM s WHERE ps = 'stale_live' AND alive UNION ALL SELECT 'invalid_market_status:' || k, 'error', team, 1 FROM s WHERE status = 'odd'
 UNION ALL SELECT 'invalid_current_price_status:' || k, 'error', team, 1 FROM s WHERE ps IS NULL UNION ALL SELECT 'live_contract_conflict:' || k, 'error', team, 1 FROM s WHERE status = 'live' AND source <> 'Active'
 UNION ALL SELECT 'active_team_missing_live_stage_odds:' || t.team, 'warn', t.team, 1 FROM t LEFT JOIN l ON lower(t.team) = l.team WHERE ts = 'active' AND n IS NULL
 UNION ALL SELECT 'live_stage_odds_for_eliminated_team:' || t.team, 'warn', t.team, n FROM t JOIN l ON lower(t.team) = l.team WHERE ts <> 'active'""")
def venue_issues(spark, d):
    """Brands and nations as teams; brands of names of odd length are out."""
    brands = _t(spark, d, "part").select(F.col("p_brand").alias("team_name")).distinct().withColumn("tournament_status", F.when(F.length("team_name") % 2 == 0, "active").otherwise("out"))
    teams = brands.unionAll(_t(spark, d, "nation").select("n_name", F.lit("active")))
    return venues.venue_issues(_current(spark, d), teams)


@query("""WITH p AS (SELECT n_nationkey AS g, n_name, TIMESTAMP '1996-01-01' + to_days(30 * n_nationkey::INT) AS seen FROM nation), s AS (SELECT l_suppkey AS team, l_shipdate AS seen, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2),
 b AS (SELECT team, price FROM s WHERE seen = (SELECT max(seen) FROM s WHERE seen <= TIMESTAMP '1996-01-01')), o AS (SELECT team, price AS opening_price, row_number() OVER (ORDER BY price DESC, team) AS r FROM b QUALIFY r <= 5), e AS (SELECT p.*, o.* FROM p, o),
 x AS (SELECT e.*, s.price AS odds, s.seen AS odds_at FROM (SELECT * FROM e WHERE g = 0) e ASOF LEFT JOIN s ON e.team = s.team AND e.seen >= s.seen UNION ALL SELECT e.*, s.price, s.seen FROM (SELECT * FROM e WHERE g > 0) e ASOF LEFT JOIN s ON e.team = s.team AND e.seen < s.seen)
 SELECT g AS game_sequence, n_name, team, r AS opening_rank, opening_price, odds AS odds_to_win, odds_at FROM x""")
def odds_to_win(spark, d):
    """Nations as games of every thirtieth day, suppliers as teams, the dearest line of a day as their price."""
    l = _t(spark, d, "lineitem")
    series = l.groupBy(F.col("l_suppkey").alias("team"), F.col("l_shipdate").alias("at")).agg(F.max("l_extendedprice").alias("price"))
    start = F.lit("1996-01-01").cast(l.schema["l_shipdate"].dataType)
    points = _t(spark, d, "nation").select(F.col("n_nationkey").alias("game_sequence"), "n_name", (start + F.make_dt_interval(days=30 * F.col("n_nationkey").cast("int"))).alias("at"))
    return venues.odds_to_win(points, series, 5).select("game_sequence", "n_name", "team", "opening_rank", "opening_price", "odds_to_win", "odds_at")


@query("""WITH m AS (SELECT o_orderpriority AS p, o_custkey AS k, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS c, min(epoch(o_orderdate)::BIGINT) AS lo, max(epoch(o_orderdate)::BIGINT) AS hi FROM orders GROUP BY 1, 2)
 SELECT p AS o_orderpriority, sum(n)::BIGINT AS rows, count(*) AS markets, sum(c)::BIGINT AS complete_rows, min(lo) AS first_minute, max(hi) AS last_minute, min(n) AS least_rows, max(n) AS most_rows, count(*) FILTER (WHERE c = 0) AS markets_without_complete, round(sum(c)::DOUBLE / sum(n)::DOUBLE, 6) AS complete_share FROM m GROUP BY 1""")
def minute_summaries(spark, d):
    """Orders as minute rows of customers."""
    o = _t(spark, d, "orders").withColumns({"bucket": floor_epoch(F.col("o_orderdate"), 1), "status": F.when(F.col("o_orderstatus") == "F", "complete").otherwise("interior_incomplete")})
    return venues.minute_summary(o, ["o_orderpriority"], "o_custkey", "bucket", "status")


@query("""SELECT l_returnflag, count(*) AS rows, count(DISTINCT l_suppkey) AS markets, count(*) FILTER (WHERE l_linenumber > 1) AS filled_minutes, sum(l_linenumber - 1)::BIGINT AS fills, sum(l_linenumber // 2)::BIGINT AS derived_fills, sum(l_quantity::BIGINT)::BIGINT AS share_volume,
 sum(l_quantity::BIGINT * l_linenumber)::BIGINT AS collateral_volume, round(sum(l_quantity::BIGINT * l_linenumber)::DOUBLE / sum(l_quantity::BIGINT)::DOUBLE, 6) AS vwap FROM lineitem GROUP BY 1""")
def settlement_summaries(spark, d):
    """Lines as settlement minutes of suppliers."""
    l, n, q = _t(spark, d, "lineitem"), F.col("l_linenumber").cast("long"), F.col("l_quantity").cast("long")
    return venues.settlement_summary(l.select("l_returnflag", "l_suppkey", (n - 1).alias("fills"), F.floor(n / 2).alias("derived_fills"), q.alias("share_volume"), (q * n).alias("collateral_volume")), ["l_returnflag"], "l_suppkey")


@query("""SELECT o_orderpriority AS fetch_run_id, count(*) AS audited, count(*) FILTER (WHERE o_orderstatus = 'F') AS success, count(*) FILTER (WHERE o_orderstatus = 'O') AS empty, count(*) FILTER (WHERE o_orderstatus = 'P') AS hard, count(*) FILTER (WHERE o_totalprice > 100000) AS published,
 count(DISTINCT o_custkey) AS markets, count(DISTINCT o_orderdate) AS tokens FROM orders GROUP BY 1""")
def audit_counts(spark, d):
    """Orders as audited fetches of customers and days."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "empty").otherwise("error")
    o = _t(spark, d, "orders").select(F.col("o_orderpriority").alias("fetch_run_id"), F.col("o_custkey").alias("market_id"), F.col("o_orderdate").alias("token_id"), status.alias("fetch_status"), (F.col("o_totalprice") > 100000).alias("raw_published"))
    return venues.audit_counts(o)


@query("""WITH k AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber <> 1) AS f FROM lineitem GROUP BY l_partkey, l_shipdate), r AS (SELECT 'fidelity' AS issue, sum(f)::BIGINT AS rows FROM k UNION ALL SELECT 'duplicate', count(*) FILTER (WHERE n > 1) FROM k) SELECT * FROM r WHERE rows > 0""")
def raw_issues(spark, d):
    return venues.raw_issues(_t(spark, d, "lineitem"), ["l_partkey", "l_shipdate"], "l_linenumber")


@query("""WITH r AS (SELECT o_orderkey AS k, o_custkey + 1 AS m, epoch(o_orderdate)::BIGINT + o_custkey * 60 <= 883612800 - 3600 AS due, o_orderstatus = 'P' AS gone FROM orders), n AS (SELECT l_orderkey AS k, count(*) AS d FROM lineitem GROUP BY 1), j AS (SELECT r.*, coalesce(d, 0) AS d FROM r LEFT JOIN n USING (k))
 SELECT count(*) FILTER (WHERE due) AS due_markets, count(*) FILTER (WHERE NOT due) AS not_due_markets, count(*) FILTER (WHERE gone) AS unavailable_markets, count(*) FILTER (WHERE due AND NOT gone) AS publishable_due_markets, sum(m)::BIGINT AS expected_minutes,
 coalesce(sum(m) FILTER (WHERE due), 0)::BIGINT AS expected_due_minutes, coalesce(sum(m) FILTER (WHERE due AND NOT gone), 0)::BIGINT AS expected_recoverable_minutes, coalesce(sum(d) FILTER (WHERE due), 0)::BIGINT AS due_dense_minutes, coalesce(sum(d) FILTER (WHERE due AND NOT gone), 0)::BIGINT AS recoverable_dense_minutes FROM j""")
def match_quality(spark, d):
    """Orders as matches of as many minutes as their customer's number, lines as their dense minutes."""
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("market_id"), F.col("o_orderdate").alias("window_lo"), (F.col("o_orderdate") + F.make_dt_interval(mins=F.col("o_custkey").cast("int"))).alias("window_hi"), (F.col("o_orderstatus") == "P").alias("is_unavailable"))
    return venues.match_quality(o, _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("market_id")), F.lit(883612800))


@query("""WITH b AS (SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'bid' ELSE 'ask' END AS side, round(l_discount * 100)::BIGINT AS cents, l_quantity::BIGINT AS q FROM lineitem),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, side ORDER BY CASE WHEN side = 'bid' THEN -cents ELSE cents END, l_orderkey, l_linenumber, q) AS level_rank FROM b)
 SELECT l_partkey, side, level_rank, (cents * q * 10000)::BIGINT AS notional, (sum(q) OVER w)::BIGINT AS cumulative_size, (sum(cents * q * 10000) OVER w)::BIGINT AS cumulative_notional FROM r WINDOW w AS (PARTITION BY l_partkey, side ORDER BY level_rank ROWS UNBOUNDED PRECEDING)""")
def book_notionals(spark, d):
    """Lines as levels, a discount as price; notionals in millionths."""
    side = F.when(F.col("l_returnflag") == "R", "bid").otherwise("ask").alias("side")
    book = _t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", side, F.round(F.col("l_discount"), 2).alias("price"), F.col("l_quantity").alias("size"))
    ranked = windows.rank_levels(book, ["l_partkey"], "side", "price", ["l_orderkey", "l_linenumber", "size"])
    deep = windows.cumulative_notional(ranked, ["l_partkey"], "side", "level_rank", "price", "size")
    millionths = lambda c: (F.col(c) * 1_000_000).cast("long").alias(c)
    return deep.select("l_partkey", "side", "level_rank", millionths("notional"), F.col("cumulative_size").cast("long").alias("cumulative_size"), millionths("cumulative_notional"))


@query(f"""WITH t AS (SELECT o_custkey, min(epoch_us(o_orderdate) // 1000000) AS c, max(epoch_us(o_orderdate) // 1000000) FILTER (WHERE o_orderstatus = 'F') AS l, count(*) % 2 = 0 AS closed, bool_and(o_totalprice > 20000) AS full_, count(*) % 11 = 0 AS skip, count(*) % 13 <> 0 AS valid, count(*) % 4 AS budget FROM orders GROUP BY 1),
 p AS (SELECT *, CASE WHEN l IS NULL THEN c ELSE greatest(c, l - 3600) END AS s FROM t),
 f AS (SELECT 'forced' AS run, o_custkey, s, budget, CASE WHEN NOT valid THEN 'invalid_token' WHEN closed AND full_ THEN 'closed_done' WHEN s >= {NOW} THEN 'already_current' END AS reason FROM p
  UNION ALL SELECT 'rebuilt', o_custkey, c, budget, CASE WHEN NOT valid THEN 'invalid_token' WHEN c >= {NOW} THEN 'already_current' END FROM p
  UNION ALL SELECT 'routine', o_custkey, s, budget, CASE WHEN NOT valid THEN 'invalid_token' WHEN skip THEN 'persisted_skip' WHEN closed AND full_ THEN 'closed_done' WHEN budget > 0 THEN 'empty_cache_skip' WHEN {NOW} - l < 86400 * 200 THEN 'recent_skip' WHEN s >= {NOW} THEN 'already_current' END FROM p)
 SELECT run, o_custkey, CASE WHEN reason IS NULL THEN s END AS start_ts, CASE WHEN reason IS NULL THEN {NOW}::BIGINT END AS end_ts, reason, nullif(CASE WHEN reason = 'empty_cache_skip' THEN budget - 1 ELSE budget END, 0) AS skip_budget_left FROM f""")
def token_plans_by_run(spark, d):
    """Customers as tokens: planned by a routine run, by a forced one and by one that rebuilds history."""
    o = _t(spark, d, "orders").withColumn("_t", floor_epoch(F.col("o_orderdate"), 1))
    n = F.count("*")
    tokens = o.groupBy("o_custkey").agg(
        F.min("_t").alias("created_ts"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("_t"))).alias("latest_ts"), (n % 2 == 0).alias("closed"), F.bool_and(F.col("o_totalprice") > 20000).alias("fully_checked"),
        (n % 11 == 0).alias("skipped"), (n % 13 != 0).alias("is_valid"), (n % 4).alias("skip_budget"),
    )
    runs = {"routine": {}, "forced": {"force": True}, "rebuilt": {"rebuild": True}}
    parts = [ledger.plan_tokens(tokens, "o_custkey", NOW, 3600, 86_400 * 200, **how).withColumn("run", F.lit(name)) for name, how in runs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""WITH p AS (SELECT p_partkey, p_brand AS h, p_type AS a, p_size % 3 AS s, CASE WHEN p_partkey % 4 = 0 THEN 'moneyline' ELSE 'other' END AS kind, CASE p_partkey % 5 WHEN 0 THEN 'Draw' WHEN 1 THEN upper(p_brand) WHEN 2 THEN p_type WHEN 3 THEN '' ELSE p_name END AS label FROM part),
 q AS (SELECT *, CASE WHEN kind = 'moneyline' THEN CASE WHEN label = 'Draw' THEN 'draw' WHEN label = upper(h) THEN 'home_win' WHEN label = a THEN 'away_win' END END AS l FROM p)
 SELECT p_partkey, coalesce(l, CASE WHEN s = 0 THEN 'draw' WHEN s = 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'home_win' ELSE 'away_win' END END) AS role FROM q""")
def market_roles(spark, d):
    """Brands against types of parts, by labels and questions."""
    p, k, s = _t(spark, d, "part"), F.col("p_partkey"), F.col("p_size") % 3
    h, a = F.col("p_brand"), F.col("p_type")
    label = F.when(k % 5 == 0, "Draw").when(k % 5 == 1, F.upper(h)).when(k % 5 == 2, a).when(k % 5 == 3, "").otherwise(F.col("p_name"))
    beat = F.when(k % 2 == 0, F.concat(F.lit("will "), h, F.lit(" beat "), a)).otherwise(F.concat(F.lit("Will "), a, F.lit(" Beat "), h, F.lit("?")))
    question = F.when(s == 0, F.concat(F.lit("Will "), a, F.lit(" vs. "), h, F.lit(" end in a draw?"))).when(s == 1, beat).otherwise(F.concat(F.lit("Will "), h, F.lit(" score?")))
    role = catalog.market_role_of(F.when(k % 4 == 0, " Moneyline").otherwise("other"), label, question, h, a)
    return p.select("p_partkey", role.alias("role"))


@query("""WITH w AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0), t AS (SELECT DISTINCT o_custkey AS k FROM orders),
 m AS (SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'end_date' END, CASE WHEN c_mktsegment = 'BUILDING' AND w.k IS NULL THEN 'event_slug' END, CASE WHEN c_nationkey = 7 THEN 'slug' END, CASE WHEN t.k IS NULL THEN 'tokens' END) AS missing FROM customer LEFT JOIN w ON w.k = c_custkey LEFT JOIN t ON t.k = c_custkey)
 SELECT * FROM m WHERE missing <> ''""")
def missing_metadata(spark, d):
    """Customers as markets, their orders as tokens; the retry of every third one is still to come."""
    c, now = _t(spark, d, "customer"), F.lit(100)
    markets = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, "2026-01-01").alias("end_date"), F.when(F.col("c_mktsegment") != "BUILDING", "e").otherwise("").alias("event_slug"), F.when(F.col("c_nationkey") != 7, "s").alias("slug"))
    unresolved = c.select("c_custkey", F.lit("event_slug").alias("field_name"), F.when(F.col("c_custkey") % 3 == 0, 101).otherwise(100).alias("next_retry_at"))
    return catalog.missing_metadata(markets, _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), unresolved, "c_custkey", now)


@query("""WITH h AS (SELECT l_returnflag, sha256(concat_ws(chr(31), '=' || l_orderkey, '=' || l_linenumber, '=' || l_partkey)) AS h FROM lineitem), s AS (SELECT l_returnflag, count(*) AS n_rows, sum(('0x' || h[1:15])::BIGINT) AS a, sum(('0x' || h[16:30])::BIGINT) AS b, sum(('0x' || h[31:45])::BIGINT) AS c, sum(('0x' || h[46:60])::BIGINT) AS d FROM h GROUP BY 1)
 SELECT l_returnflag, n_rows, sha256(concat_ws('|', n_rows, a, b, c, d)) AS digest FROM s""")
def leaf_digests(spark, d):
    return catalog.multiset_digest(_t(spark, d, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"])


@query("""WITH w AS (SELECT *, l_discount < 0.09 AS sound, CASE l_linenumber WHEN 1 THEN 'home_win' WHEN 2 THEN 'draw' WHEN 3 THEN 'away_win' ELSE 'home_advances' END AS role FROM lineitem),
 g AS (SELECT l_orderkey, count(*) FILTER (WHERE sound) AS n_markets, count(DISTINCT l_linestatus) FILTER (WHERE sound) AS ids, coalesce(bool_or(sound AND l_orderkey < 700), false) AS grouped, count(*) FILTER (WHERE sound AND role = 'home_advances') AS f, count(*) FILTER (WHERE sound AND role = 'home_win') AS h,
  count(*) FILTER (WHERE sound AND role = 'draw') AS d, count(*) FILTER (WHERE sound AND role = 'away_win') AS a FROM w GROUP BY 1)
 SELECT l_orderkey, n_markets, CASE WHEN n_markets = 0 THEN 'absent' WHEN ids > 1 THEN 'identity' WHEN NOT CASE WHEN grouped THEN h = 1 AND d = 1 AND a = 1 AND n_markets = 3 ELSE n_markets = 1 AND f = 1 END THEN 'roles' END AS issue FROM g""")
def portrait_targets(spark, d):
    """Orders as matches, lines as their markets."""
    n = F.col("l_linenumber")
    role = F.when(n == 1, "home_win").when(n == 2, "draw").when(n == 3, "away_win").otherwise("home_advances")
    w = _t(spark, d, "lineitem").withColumns({"role": role, "fixture_mapping_count": F.when(F.col("l_discount") < 0.09, 1).otherwise(2), "primary_mapping_count": F.lit(1)})
    return catalog.portrait_targets(w, "l_orderkey", "role", ["l_linestatus"], F.col("l_orderkey") < 700, ["home_win", "draw", "away_win"], ["home_advances"])

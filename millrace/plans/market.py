"""Market queries over the driver tables, each with the SQL that gives the same rows.

events stands for ticks (key user_id, price value, source event_type), lineitem for fills and book levels, orders for
registries and intervals. Every query reads its tables whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import bars, joins, merge, quality, rules, windows

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


OHLC_SQL = """SELECT {key}, (epoch_us({ts}) // ({s} * 1000000::BIGINT)) * {s} AS bucket,
 arg_min({p}, struct_pack(t := {ts}, p := {p})) AS open_price, max({p}) AS high_price, min({p}) AS low_price, arg_max({p}, struct_pack(t := {ts}, p := {p})) AS close_price,
 round(avg({p}), 8) AS avg_price, count(*) AS observed_points, min({ts}) AS first_observed_at, max({ts}) AS last_observed_at
 FROM {t} WHERE {ts} IS NOT NULL AND {p} IS NOT NULL GROUP BY ALL"""


def _hour_sql(key="user_id", s=3600):
    return OHLC_SQL.format(key=key, ts="ts", p="value", t="events", s=s)


@query(_hour_sql())
def bars_hourly(spark, d):
    return bars.ohlc(_t(spark, d, "events"), ["user_id"], "ts", "value", 3600)


@query(_hour_sql(s=60))
def bars_minute(spark, d):
    return bars.ohlc(_t(spark, d, "events"), ["user_id"], "ts", "value", 60)


@query(_hour_sql("user_id, event_type", 86400))
def bars_daily_by_source(spark, d):
    return bars.ohlc(_t(spark, d, "events"), ["user_id", "event_type"], "ts", "value", 86400)


@query(f"""WITH h AS ({_hour_sql()}) SELECT user_id, (bucket // 86400) * 86400 AS coarse_bucket, arg_min(open_price, bucket) AS open_price, max(high_price) AS high_price,
 min(low_price) AS low_price, arg_max(close_price, bucket) AS close_price, sum(observed_points)::BIGINT AS observed_points FROM h GROUP BY ALL""")
def bars_rollup_daily(spark, d):
    return bars.rollup(bars_hourly(spark, d), ["user_id"], 86400)


@query(f"""WITH h AS ({_hour_sql()}), s AS (SELECT user_id, unnest(generate_series(min(bucket), max(bucket), 3600)) AS bucket FROM h GROUP BY 1),
 j AS (SELECT s.user_id, s.bucket, h.open_price, h.high_price, h.low_price, h.observed_points,
 last_value(h.close_price IGNORE NULLS) OVER (PARTITION BY s.user_id ORDER BY s.bucket) AS close_price FROM s LEFT JOIN h USING (user_id, bucket))
 SELECT user_id, bucket, coalesce(open_price, close_price) AS open_price, coalesce(high_price, close_price) AS high_price, coalesce(low_price, close_price) AS low_price, close_price,
 observed_points IS NOT NULL AS is_observed, coalesce(observed_points, 0) AS observed_points FROM j""")
def bars_dense_hourly(spark, d):
    return bars.dense(bars_hourly(spark, d), ["user_id"], 3600)


@query(_hour_sql())
def bars_incremental_hourly(spark, d):
    """Target built from the ticks before the last quarter of the span; the dirty hours are rebuilt. Equals the full build."""
    events = _t(spark, d, "events")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    cut = lo + (hi - lo) * 3 / 4
    target = bars.ohlc(events.where(F.col("ts") < F.lit(cut)), ["user_id"], "ts", "value", 3600)
    dirty = events.where(F.col("ts") >= F.lit(cut)).select("user_id", C.floor_epoch(F.col("ts"), 3600).alias("bucket"))
    return bars.dirty_rebuild(target, events, dirty, ["user_id"], "ts", "value", 3600)


@query("""SELECT l_partkey, arg_min(l_discount, struct_pack(a := l_orderkey, b := l_linenumber, c := l_discount)) AS open_price, max(l_discount) AS high_price, min(l_discount) AS low_price,
 arg_max(l_discount, struct_pack(a := l_orderkey, b := l_linenumber, c := l_discount)) AS close_price, sum(l_quantity::DECIMAL(18,6))::DOUBLE AS share_volume, sum(l_extendedprice::DECIMAL(18,6))::DOUBLE AS collateral_volume, count(*) AS fills FROM lineitem GROUP BY 1""")
def fill_bars(spark, d):
    out = bars.fill_bars(_t(spark, d, "lineitem"), ["l_partkey"], ["l_orderkey", "l_linenumber", "l_discount"], "l_discount", "l_quantity", "l_extendedprice")
    return out.withColumn("share_volume", F.col("share_volume").cast("double")).withColumn("collateral_volume", F.col("collateral_volume").cast("double"))


@query("SELECT user_id, arg_max(value, struct_pack(t := ts, v := value)) AS latest_value, max(ts) AS latest_at FROM events WHERE value IS NOT NULL GROUP BY 1")
def latest_values(spark, d):
    return bars.latest_value(_t(spark, d, "events"), ["user_id"], "value", "ts")


@query("SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_order(spark, d):
    return windows.latest(_t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events")
def carry_forward(spark, d):
    e = _t(spark, d, "events").withColumn("carried", F.when(F.col("event_type") == "purchase", F.col("value")))
    return windows.locf(e, ["user_id"], ["ts", "event_id"], ["carried"]).select("event_id", "user_id", "carried")


@query(f"""WITH h AS ({_hour_sql()}), s AS (SELECT user_id, unnest(generate_series(min(bucket), max(bucket), 3600)) AS bucket FROM h GROUP BY 1),
 j AS (SELECT s.user_id, s.bucket, h.bucket IS NOT NULL AS seen FROM s LEFT JOIN h USING (user_id, bucket)),
 r AS (SELECT *, sum(seen::INT) OVER (PARTITION BY user_id ORDER BY bucket) AS run FROM j)
 SELECT user_id, max(n) AS longest_gap FROM (SELECT user_id, run, count(*) AS n FROM r WHERE NOT seen GROUP BY ALL) GROUP BY 1""")
def longest_gap(spark, d):
    return windows.max_gap(bars_dense_hourly(spark, d), ["user_id"], ["bucket"], F.col("is_observed"))


@query("SELECT event_id, (epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT) AS gap_seconds FROM events")
def observation_gaps(spark, d):
    return windows.with_gap(_t(spark, d, "events"), ["user_id"], "ts", ["event_id"]).select("event_id", "gap_seconds")


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS event_sequence FROM events")
def event_sequence(spark, d):
    return windows.sequence_by(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "event_sequence")


BOOK_SQL = "SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'bid' ELSE 'ask' END AS side, l_discount AS price, l_quantity AS size FROM lineitem"


def _book(spark, d):
    side = F.when(F.col("l_returnflag") == "R", "bid").otherwise("ask").alias("side")
    return _t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", side, F.col("l_discount").alias("price"), F.col("l_quantity").alias("size"))


@query(f"""WITH b AS ({BOOK_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END NULLS LAST, l_orderkey, l_linenumber, size) AS level_rank FROM b)
 SELECT *, sum(size) OVER (PARTITION BY l_partkey, side ORDER BY level_rank ROWS UNBOUNDED PRECEDING) AS cumulative_size FROM r""")
def book_levels(spark, d):
    ranked = windows.rank_levels(_book(spark, d), ["l_partkey"], "side", "price", ["l_orderkey", "l_linenumber", "size"])
    return windows.cumulative_depth(ranked, ["l_partkey"], "side", "level_rank", "size")


@query(f"""WITH b AS ({BOOK_SQL}), q AS (SELECT *, max(CASE WHEN side = 'bid' THEN price END) OVER (PARTITION BY l_partkey) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) OVER (PARTITION BY l_partkey) AS best_ask FROM b)
 SELECT DISTINCT l_partkey, best_bid, best_ask, best_ask - best_bid AS spread, (best_bid + best_ask) / 2 AS midpoint FROM q""")
def best_quotes(spark, d):
    return windows.best_quotes(_book(spark, d), ["l_partkey"], "side", "price").select("l_partkey", "best_bid", "best_ask", "spread", "midpoint").distinct()


ITV_SQL = "SELECT l_suppkey, l_shipdate AS lo, l_shipdate + to_days(l_linenumber::INT) AS hi FROM lineitem"
MERGED_SQL = f"""i AS ({ITV_SQL}), m AS (SELECT *, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
 g AS (SELECT *, sum(CASE WHEN lo <= before THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS grp FROM m),
 r AS (SELECT l_suppkey, min(lo) AS lo, max(hi) AS hi, count(*) AS members FROM g GROUP BY l_suppkey, grp)"""


def _merged(spark, d):
    i = _t(spark, d, "lineitem").select("l_suppkey", F.col("l_shipdate").alias("lo"), F.expr("l_shipdate + make_dt_interval(l_linenumber)").alias("hi"))
    return windows.merge_intervals(i, ["l_suppkey"], "lo", "hi")


@query(f"WITH {MERGED_SQL} SELECT * FROM r")
def merged_intervals(spark, d):
    return _merged(spark, d)


@query(f"WITH {MERGED_SQL} SELECT * FROM (SELECT l_suppkey, hi AS gap_lo, lead(lo) OVER (PARTITION BY l_suppkey ORDER BY lo) AS gap_hi FROM r) WHERE gap_hi > gap_lo")
def interval_gaps(spark, d):
    return windows.interval_gaps(_merged(spark, d), ["l_suppkey"])


@query("SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / nullif((SELECT stddev_pop(c_acctbal) FROM customer), 0), 6) AS zscore FROM customer")
def balance_zscore(spark, d):
    return windows.zscore(_t(spark, d, "customer"), "c_acctbal").select("c_custkey", F.round("zscore", 6).alias("zscore"))


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY epoch(date_trunc('second', ts))::BIGINT RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW), 6) AS rolling_sum FROM events")
def rolling_hour(spark, d):
    return windows.rolling_sum(_t(spark, d, "events"), ["user_id"], "ts", "value", 3600).select("event_id", F.round("rolling_sum", 6).alias("rolling_sum"))


ASOF_SQL = """WITH q AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
 SELECT p.event_id, q.v AS asof_value, q.ts AS asof_at FROM p ASOF LEFT JOIN q ON p.user_id = q.user_id AND p.ts {op} q.ts"""


def _asof(spark, d, strict):
    e = _t(spark, d, "events")
    left, right = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'").select("user_id", "ts", "value")
    return joins.asof_join(left, right, ["user_id"], "ts", "ts", "value", strict).select("event_id", "asof_value", "asof_at")


@query(ASOF_SQL.format(op=">="))
def asof_backward(spark, d):
    return _asof(spark, d, False)


@query(ASOF_SQL.format(op=">"))
def asof_strict(spark, d):
    return _asof(spark, d, True)


@query("SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name IS NOT NULL")
def fact_dimension(spark, d):
    o, c, n = _t(spark, d, "orders"), _t(spark, d, "customer"), _t(spark, d, "nation")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).where("n_name IS NOT NULL").select("c_custkey", "o_orderkey")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(spark, d):
    return _t(spark, d, "customer").join(_t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def in_registry(spark, d):
    return _t(spark, d, "customer").join(_t(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS open_n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS filled_n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
 SELECT k, coalesce(open_n, 0) AS open_n, coalesce(filled_n, 0) AS filled_n FROM a FULL JOIN b USING (k)""")
def outer_merge(spark, d):
    o = _t(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    n = lambda s, name: o.where(F.col("o_orderstatus") == s).groupBy("k").agg(F.count("*").alias(name))
    return joins.outer_merge(n("O", "open_n"), n("F", "filled_n"), ["k"]).na.fill(0)


@query("""WITH w AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_shipdate AS lo, l_shipdate + INTERVAL 2 DAY AS hi FROM lineitem), p AS (SELECT o_orderkey, o_custkey % 10 + 1 AS k, o_orderdate AS ts FROM orders)
 SELECT o_orderkey, count(*) AS windows FROM p JOIN w ON p.k = w.k AND ts BETWEEN lo AND hi GROUP BY 1""")
def points_in_windows(spark, d):
    w = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("lo"), F.expr("l_shipdate + INTERVAL 2 DAY").alias("hi"))
    p = _t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 10 + 1).alias("k"), F.col("o_orderdate").alias("ts"))
    return joins.point_in_window(p, w, ["k"], "ts", "lo", "hi").groupBy("o_orderkey").agg(F.count("*").alias("windows"))


@query("SELECT o_custkey, count(DISTINCT (o_orderstatus, o_orderpriority)) AS versions FROM orders GROUP BY 1 HAVING versions > 1")
def divergent_keys(spark, d):
    return joins.divergent_keys(_t(spark, d, "orders"), ["o_custkey"], ["o_orderstatus", "o_orderpriority"])


def _halves(spark, d):
    """All orders before 1999 as the target, all from 1997 on as the batch: together every order, and both hold those of 1997 and 1998."""
    o = _t(spark, d, "orders")
    return o.where("o_orderdate < TIMESTAMP_NTZ '1999-01-01'"), o.where("o_orderdate >= TIMESTAMP_NTZ '1997-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders")
def merge_replace(spark, d):
    return merge.merge_replace(*_halves(spark, d), ["o_orderkey"], [F.desc("o_totalprice")])


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders")
def merge_append(spark, d):
    return merge.merge_append(*_halves(spark, d), ["o_orderkey"], [F.desc("o_totalprice")])


@query("""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), b AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
 SELECT o_orderkey, greatest(t.o_totalprice, b.o_totalprice) AS o_totalprice, least(t.o_orderdate, b.o_orderdate) AS o_orderdate, coalesce(t.o_orderstatus, b.o_orderstatus) AS o_orderstatus FROM t FULL JOIN b USING (o_orderkey)""")
def merge_registry(spark, d):
    return merge.merge_rules(*_halves(spark, d), ["o_orderkey"], {"o_totalprice": "greatest", "o_orderdate": "least", "o_orderstatus": "keep"})


@query("""WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
 SELECT o_custkey, o_orderstatus, sum(w)::BIGINT AS excess FROM (SELECT *, 1 AS w FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL HAVING sum(w) <> 0""")
def table_diff(spark, d):
    a, b = _halves(spark, d)
    return merge.table_diff(a.select("o_custkey", "o_orderstatus"), b.select("o_custkey", "o_orderstatus"))


@query("""SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS open_quantity, max(l_tax) FILTER (WHERE l_discount > 0.05) AS top_tax,
 bool_and(l_quantity > 0) AS all_positive, bool_or(l_tax > 0.07) AS any_high_tax, count(DISTINCT (l_returnflag, l_linestatus)) AS states FROM lineitem GROUP BY 1""")
def filtered_aggregates(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"), bars.filtered("sum", F.col("l_linestatus") == "O", "l_quantity").alias("open_quantity"), bars.filtered("max", F.col("l_discount") > 0.05, "l_tax").alias("top_tax"),
        F.bool_and(F.col("l_quantity") > 0).alias("all_positive"), F.bool_or(F.col("l_tax") > 0.07).alias("any_high_tax"), F.count_distinct(F.struct("l_returnflag", "l_linestatus")).alias("states"),
    )


@query("SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95, round(median(value), 6) AS p50 FROM events GROUP BY 1")
def percentiles(spark, d):
    found = rules.exact_percentiles(_t(spark, d, "events"), "event_type", "value", [0.5, 0.95])
    at = lambda share, name: F.round(F.max(F.when(F.col("share") == share, F.col("percentile"))), 6).alias(name)
    return found.groupBy("event_type").agg(at(0.95, "p95"), at(0.5, "p50"))


@query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_price, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS filled_price,
 max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS pending_price FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 3""")
def pivot_roles(spark, d):
    top = lambda s, n: bars.filtered("max", F.col("o_orderstatus") == s, "o_totalprice").alias(n)
    return _t(spark, d, "orders").groupBy("o_custkey").agg(top("O", "open_price"), top("F", "filled_price"), top("P", "pending_price"), F.count_distinct("o_orderstatus").alias("n")).where("n = 3").drop("n")


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, sha256(string_agg(n_name, '|' ORDER BY n_nationkey)) AS ordered_hash FROM nation GROUP BY 1")
def ordered_strings(spark, d):
    by_key = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    return _t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"), F.sha2(F.array_join(by_key, "|"), 256).alias("ordered_hash"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_valid(props) AS is_json FROM events")
def json_fields(spark, d):
    p = F.col("props")
    return _t(spark, d, "events").select("event_id", C.json_field(p, "$.k", "bigint").alias("k"), F.coalesce(F.call_function("try_parse_json", p).isNotNull(), F.lit(False)).alias("is_json"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name_key, md5(concat_ws('|', p_name, p_brand, p_size::VARCHAR)) AS revision, nullif(concat_ws(',', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END), '') AS issues FROM part")
def name_keys(spark, d):
    issues = C.issue_list(("large", F.col("p_size") > 40), ("dear", F.col("p_retailprice") > 1000))
    return _t(spark, d, "part").select("p_partkey", C.name_key(F.col("p_name")).alias("name_key"), C.revision(F.col("p_name"), F.col("p_brand"), F.col("p_size")).alias("revision"), issues.alias("issues"))


@query("SELECT l_orderkey, l_linenumber, date_diff('hour', o_orderdate, l_shipdate) AS hours, date_diff('day', o_orderdate, l_shipdate) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def boundary_diffs(spark, d):
    j = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    diff = lambda s: C.date_diff_boundary(F.col("o_orderdate"), F.col("l_shipdate"), s)
    return j.select("l_orderkey", "l_linenumber", diff(3600).alias("hours"), diff(86400).alias("days"))


@query("SELECT l_orderkey, l_linenumber, l_discount + l_tax AS pair_sum, round(1 - l_discount - l_tax - greatest(round(0.02 * l_discount * (1 - l_discount), 5), 0) - greatest(round(0.02 * l_tax * (1 - l_tax), 5), 0), 9) AS edge FROM lineitem")
def pair_edges(spark, d):
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") + F.col("l_tax")).alias("pair_sum"), F.round(C.signal_edge(F.col("l_discount"), F.col("l_tax"), 0.02), 9).alias("edge"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def grain_duplicates(spark, d):
    return quality.check_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT (SELECT count(*) FROM orders) AS rows, 'o_custkey' AS column_name, count(*) FILTER (WHERE o_custkey IS NULL) AS nulls, count(DISTINCT o_custkey) AS distinct_values, min(o_custkey)::VARCHAR AS min_text, max(o_custkey)::VARCHAR AS max_text FROM orders
 UNION ALL SELECT (SELECT count(*) FROM orders), 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL), count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders""")
def column_profile(spark, d):
    return quality.profile(_t(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query("SELECT *, nullif(concat_ws(',', CASE WHEN negative_price > 0 THEN 'negative_price' END, CASE WHEN high_discount > 0 THEN 'high_discount' END), '') AS blocking_keys FROM (SELECT count(*) FILTER (WHERE l_extendedprice < 0) AS negative_price, count(*) FILTER (WHERE l_discount > 0.09) AS high_discount FROM lineitem)")
def quality_summary(spark, d):
    return quality.quality_row(_t(spark, d, "lineitem"), {"negative_price": F.col("l_extendedprice") < 0, "high_discount": F.col("l_discount") > 0.09})


@query("SELECT c_custkey FROM customer WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)")
def missing_parents(spark, d):
    return quality.orphans(_t(spark, d, "customer"), _t(spark, d, "nation").where("n_nationkey < 20"), "c_nationkey", "n_nationkey").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, unnest(['quantity', 'price']) AS side, unnest([l_quantity, l_extendedprice]) AS amount FROM lineitem")
def unpivot_sides(spark, d):
    side = F.explode(F.array(F.struct(F.lit("quantity").alias("side"), F.col("l_quantity").alias("amount")), F.struct(F.lit("price").alias("side"), F.col("l_extendedprice").alias("amount"))))
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", side.alias("s")).select("l_orderkey", "l_linenumber", "s.*")


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def distinct_union(spark, d):
    return _t(spark, d, "orders").select(F.col("o_custkey").alias("k")).union(_t(spark, d, "customer").select("c_custkey")).distinct()


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
def top_orders(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(10)

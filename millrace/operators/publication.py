"""What may be published: replays that must repeat, audits that must reconcile, scans and crawls that must be complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _same(a: str, b: str, keys: list[str]):
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def replay_differences(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, columns): rows of an append-only batch whose key is in target, or twice in batch, with other values, and the columns that differ. Nulls
    equal nulls, in keys too; an identical replay has no rows."""
    values = [c for c in target.columns if c not in keys]
    both = target.select(*keys, *values).unionByName(batch.select(*keys, *values))
    versions = both.groupBy(*keys).agg(*(F.count_distinct(F.struct(c)).alias(f"_{i}") for i, c in enumerate(values)))
    differs = F.array_compact(F.array(*(F.when(F.col(f"_{i}") > 1, F.lit(c)) for i, c in enumerate(values))))
    return versions.select(*keys, F.array_join(differs, ",").alias("columns")).where("columns != ''")


def append_replay(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that batch adds to target, one a key. The plan itself stops the write: it raises, naming a key, where a key comes again with
    other values, so no action is needed before."""
    values = [c for c in target.columns if c not in keys]
    fresh = batch.select(*keys, *values).groupBy(*keys).agg(F.min(F.struct(*values)).alias("_low"), F.max(F.struct(*values)).alias("_high"))
    known = target.select(*keys, F.struct(*values).alias("_old"))
    both = fresh.alias("n").join(known.alias("o"), _same("n", "o", keys), "left").select(*(F.col(f"n.{k}").alias(k) for k in keys), "_low", "_high", "_old")
    bad = ~F.col("_low").eqNullSafe(F.col("_high")) | (F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_low")))
    where = F.concat(F.lit("divergent replay of "), F.to_json(F.struct(*keys)))
    # the check is part of the condition that chooses rows, so no optimizer can prune it away
    chosen = F.when(bad, F.raise_error(where).cast("boolean")).otherwise(F.col("_old").isNull())
    return both.where(chosen).select(*keys, "_low.*").select(target.columns)


def reconciled_run(audit: DataFrame, held: DataFrame, run: str, token: str, status: str, rows: str, digest: str, finished: str) -> DataFrame:
    """(run): the last finished run whose successes are exactly the tokens of held with as many rows each (held: token, rows), none of them
    without a digest, and that has no error or cancelled fetch; no row if there is none."""
    ok = F.col(status) == "success"
    each = audit.groupBy(run, token).agg(F.count_if(ok).alias("_ok"), F.count_if(F.col(status).isin("error", "cancelled")).alias("_bad"), F.sum(F.when(ok, F.col(rows))).alias("_rows"), F.count_if(ok & F.col(digest).isNull()).alias("_bare"), F.max(finished).alias("_at"))
    total = held.agg(F.count("*").alias("_all"))
    met = each.join(held.select(token, F.col("rows").alias("_held")), token, "left")
    right = (F.col("_ok") == 1) & (F.col("_rows") == F.col("_held"))
    runs = met.groupBy(run).agg(F.sum("_bad").alias("_bad"), F.sum("_bare").alias("_bare"), F.count_if(F.col("_ok") > 0).alias("_n"), F.count_if(right).alias("_right"), F.max("_at").alias("_at"))
    good = runs.crossJoin(F.broadcast(total)).where("_bad = 0 AND _bare = 0 AND _n = _right AND _right = _all")
    return good.orderBy(F.desc("_at"), F.desc(run)).limit(1).select(run)


def publish_audit(audit: DataFrame, chosen: DataFrame, run: str, status: str) -> DataFrame:
    """audit with raw_published: true for the successes of the chosen run (reconciled_run) alone. An empty chosen raises once it is read."""
    checked = chosen.agg(F.count("*").alias("_n"), F.max(run).alias("_run")).where(F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.lit("no run reconciles")).cast("boolean")))
    return audit.drop("raw_published").crossJoin(F.broadcast(checked)).withColumn("raw_published", (F.col(run) == F.col("_run")) & (F.col(status) == "success")).drop("_n", "_run")


def book_scan_issues(windows: DataFrame, snapshots: DataFrame, tokens: DataFrame, order: list[str]) -> DataFrame:
    """One row of counts: what keeps an order-book scan from being published, and aggregate_sha256, a digest of its content that no order changes.

    windows: token, status (pending, failed, loaded, empty, split), snapshot_count, hashes (array of text). snapshots: token, digest and the order columns. tokens: token.
    open_windows are not finished; invalid_windows hold other numbers of hashes than their status says; contradictions are places in the order with
    several digests; missing_tokens have no snapshot; strange_hashes are in windows or snapshots alone; repeated are copies of a snapshot.
    """
    n = F.coalesce(F.size("hashes"), F.lit(0))
    loaded = F.col("status") == "loaded"
    valid = F.when(loaded, (F.col("snapshot_count") > 0) & (n == F.col("snapshot_count"))).when(F.col("status").isin("empty", "split"), (F.col("snapshot_count") == 0) & (n == 0)).otherwise(True)
    w = windows.agg(F.count_if(F.col("status").isin("pending", "failed")).alias("open_windows"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("invalid_windows"))
    places = snapshots.groupBy("token", *order).agg(F.count_distinct("digest").alias("_d")).agg(F.count_if(F.col("_d") > 1).alias("contradictions"))
    missing = tokens.select("token").distinct().join(snapshots.select("token"), "token", "left_anti").agg(F.count("*").alias("missing_tokens"))
    said = windows.where(loaded).select("token", F.explode("hashes").alias("digest")).distinct().withColumn("_s", F.lit(1))
    held = snapshots.groupBy("token", "digest").agg(F.count("*").alias("_h"))
    both = said.join(held, ["token", "digest"], "full").agg(
        F.count_if(F.col("_s").isNull() | F.col("_h").isNull()).alias("strange_hashes"), F.coalesce(F.sum(F.col("_h") - 1), F.lit(0)).alias("repeated"), F.coalesce(F.sum("_h"), F.lit(0)).alias("snapshots"),
        F.sha2(F.concat_ws(":", *(F.sum(F.xxhash64(F.lit(seed), "token", "digest").cast("decimal(38,0)")) for seed in (0, 1))), 256).alias("aggregate_sha256"),
    )
    return w.crossJoin(places).crossJoin(missing).crossJoin(both)


def crawl_readiness(pages: DataFrame, issues: DataFrame, passes: list[str], crawl: str = "crawl_id", name: str = "pass_name", done: str = "is_complete") -> DataFrame:
    """(crawl, pages, reasons) of every crawl: reasons is null if all passes and no others ended with exactly one complete page and no issue is known, else
    the comma-joined names of those of missing_pass, strange_pass, incomplete and issues that hold."""
    each = pages.groupBy(crawl, name).agg(F.count("*").alias("_pages"), F.count_if(F.col(done)).alias("_done"))
    runs = each.groupBy(crawl).agg(F.sum("_pages").alias("pages"), F.count_if(F.col(name).isin(*passes)).alias("_known"), F.count_if(~F.coalesce(F.col(name).isin(*passes), F.lit(False))).alias("_strange"), F.count_if(F.col("_done") != 1).alias("_open"))
    bad = issues.groupBy(crawl).agg(F.count("*").alias("_bad"))
    reasons = [("missing_pass", F.col("_known") < len(passes)), ("strange_pass", F.col("_strange") > 0), ("incomplete", F.col("_open") > 0), ("issues", F.coalesce(F.col("_bad"), F.lit(0)) > 0)]
    return runs.join(bad, crawl, "left").select(crawl, "pages", F.nullif(F.concat_ws(",", *(F.when(c, F.lit(n)) for n, c in reasons)), F.lit("")).alias("reasons"))


def graph_history(rows: DataFrame, crawls: DataFrame, key: list[str], content: str) -> DataFrame:
    """Versions of nodes or edges over complete crawls: key, content, valid_from, valid_to (null: still so) and n_crawls that saw it so.

    rows: crawl_id, key, content (a digest or text), one row a key and crawl. crawls: crawl_id, observed_at, status; only complete ones count. A
    version ends at the first complete crawl that shows the key with other content, or not at all.
    """
    done = crawls.where("status = 'complete'").select("crawl_id", "observed_at")
    # crawls are few (a row a day or so): they are numbered in one task
    numbered = done.withColumn("_n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("observed_at", "crawl_id"))).select("crawl_id", "observed_at", "_n")
    after = numbered.select((F.col("_n") - 1).alias("_last"), F.col("observed_at").alias("valid_to"))
    seen = rows.select("crawl_id", *key, content).join(F.broadcast(numbered), "crawl_id")
    w = Window.partitionBy(*key).orderBy("_n")
    new = F.coalesce((F.lag("_n").over(w) != F.col("_n") - 1) | ~F.lag(content).over(w).eqNullSafe(F.col(content)), F.lit(True))
    marked = seen.withColumn("_new", new.cast("int")).withColumn("_version", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    versions = marked.groupBy(*key, "_version").agg(F.first(content).alias(content), F.min("observed_at").alias("valid_from"), F.max("_n").alias("_last"), F.count("*").alias("n_crawls"))
    return versions.join(F.broadcast(after), "_last", "left").select(*key, content, "valid_from", "valid_to", "n_crawls")


def graph_issues(nodes: DataFrame, edges: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """(issue, rows) of a graph release, only issues that it has. nodes: node_id, kind, content, content_sha256, properties_json. edges: edge_id, source_id, target_id,
    content, content_sha256. Issues: bad_id (null or blank), repeated_id, dangling_edge (an end that is no node), lone_node (a node without an edge), bad_hash, bad_json, and
    bad_count (a table with other than the expected rows)."""
    hashed = lambda df: df.where(~F.coalesce(F.col("content_sha256") == F.sha2("content", 256), F.lit(False)))
    blank = lambda df, *cs: df.where(~F.coalesce(F.forall(F.array(*cs), lambda c: c.isNotNull() & (F.trim(c) != "")), F.lit(False)))
    twice = lambda df, c: df.groupBy(c).count().where(f"count > 1 AND {c} IS NOT NULL")
    ends = edges.select("edge_id", F.explode(F.array("source_id", "target_id")).alias("node_id"))
    ids = nodes.select("node_id").distinct()
    parts = {
        "bad_id": [blank(nodes, "node_id"), blank(edges, "edge_id", "source_id", "target_id")], "repeated_id": [twice(nodes, "node_id"), twice(edges, "edge_id")], "dangling_edge": [ends.where("node_id IS NOT NULL").join(ids, "node_id", "left_anti").select("edge_id").distinct()],
        "lone_node": [nodes.join(ends.select("node_id").distinct(), "node_id", "left_anti")], "bad_hash": [hashed(nodes), hashed(edges)], "bad_json": [nodes.where(F.col("properties_json").isNotNull() & F.try_parse_json("properties_json").isNull())],
    }
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("issue"), "rows") for name, frames in parts.items() for df in frames]
    for name, want in (expected or {}).items():
        counted.append({"nodes": nodes, "edges": edges}[name].agg(F.count("*").alias("n")).select(F.lit("bad_count").alias("issue"), F.abs(F.col("n") - want).alias("rows")))
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out.groupBy("issue").agg(F.sum("rows").alias("rows")).where("rows > 0")

"""Replay, audit, scan and crawl checks, and the history of a graph."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.operators import publication as P


def test_replay(spark):
    target = spark.createDataFrame([("a", 1, "x", None), ("b", 1, "y", 2.0), (None, 3, "n", 0.0)], "k string, n int, v string, w double")
    same = target.union(spark.createDataFrame([("c", 1, "new", None), ("c", 1, "new", None)], target.schema))
    assert P.replay_differences(target, same, ["k", "n"]).count() == 0
    assert [tuple(r) for r in P.append_replay(target, same, ["k", "n"]).collect()] == [("c", 1, "new", None)]
    other = spark.createDataFrame([("b", 1, "y", 3.0), (None, 3, "m", None)], target.schema)
    assert {(r.k, r.columns) for r in P.replay_differences(target, other, ["k", "n"]).collect()} == {("b", "w"), (None, "v,w")}
    for batch in (other.where("k = 'b'"), spark.createDataFrame([("z", 1, "p", 1.0), ("z", 1, "q", 1.0)], target.schema)):
        with pytest.raises(Exception, match=r'divergent replay of \{"k":"[bz]","n":1\}'):
            P.append_replay(target, batch, ["k", "n"]).count()
    assert P.append_replay(target.limit(0), target, ["k", "n"]).count() == 3


def test_audit(spark):
    rows = [("r1", "a", "success", 5, "h", 1), ("r1", "b", "success", 7, "h", 1), ("r2", "a", "success", 5, "h", 2), ("r2", "b", "success", 7, "h", 2), ("r2", "c", "empty", 0, None, 2), ("r3", "a", "success", 5, "h", 3), ("r3", "b", "error", 0, None, 3), ("r4", "a", "success", 5, "h", 4), ("r4", "b", "success", 8, "h", 4), ("r5", "a", "success", 12, "h", 5), ("r6", "a", "success", 5, None, 6), ("r6", "b", "success", 7, "h", 6)]
    audit = spark.createDataFrame(rows, "run string, token string, status string, n long, sha string, at int")
    held = spark.createDataFrame([("a", 5), ("b", 7)], "token string, rows long")
    chosen = P.reconciled_run(audit, held, "run", "token", "status", "n", "sha", "at")
    assert [r.run for r in chosen.collect()] == ["r2"]
    assert {(r.run, r.token) for r in P.publish_audit(audit, chosen, "run", "status").where("raw_published").collect()} == {("r2", "a"), ("r2", "b")}
    none = P.reconciled_run(audit, held.limit(1), "run", "token", "status", "n", "sha", "at")
    with pytest.raises(Exception, match="no run reconciles"):
        P.publish_audit(audit, none, "run", "status").count()


def test_book_scan(spark):
    windows = lambda *rows: spark.createDataFrame(rows, "token string, status string, snapshot_count int, hashes array<string>")
    held = spark.createDataFrame([("a", 1, "h1"), ("a", 2, "h2")], "token string, at int, digest string")
    tokens = spark.createDataFrame([("a",)], "token string")
    good = P.book_scan_issues(windows(("a", "loaded", 2, ["h1", "h2"]), ("a", "empty", 0, [])), held, tokens, ["at"]).first()
    assert tuple(good)[:7] == (0, 0, 0, 0, 0, 0, 2)
    assert good.aggregate_sha256 == P.book_scan_issues(windows(("a", "loaded", 2, ["h2", "h1"])), held.orderBy(F.desc("at")), tokens, ["at"]).first().aggregate_sha256
    twice = held.union(spark.createDataFrame([("a", 1, "h9"), ("a", 2, "h2")], held.schema))
    bad = P.book_scan_issues(windows(("a", "loaded", 3, ["h1"]), ("a", "pending", 0, []), ("b", "empty", 0, ["x"]), ("b", "loaded", 1, ["h7"])), twice, tokens.union(spark.createDataFrame([("b",)], "token string")), ["at"]).first()
    assert tuple(bad)[:7] == (1, 2, 1, 1, 3, 1, 4)


def test_crawls(spark):
    names = ["p", "q"]
    rows = [("ok", "p", True), ("ok", "q", False), ("ok", "q", True), ("half", "p", True), ("open", "p", True), ("open", "q", False), ("odd", "p", True), ("odd", "q", True), ("odd", "z", True), ("sick", "p", True), ("sick", "q", True)]
    got = P.crawl_readiness(spark.createDataFrame(rows, "crawl_id string, pass_name string, is_complete boolean"), spark.createDataFrame([("sick",)], "crawl_id string"), names)
    assert {r.crawl_id: r.reasons for r in got.collect()} == {"ok": None, "half": "missing_pass", "open": "incomplete", "odd": "strange_pass", "sick": "issues"}


def test_graph_history(spark):
    at = lambda d: dt.datetime(2026, 6, d)
    crawls = spark.createDataFrame([("c1", at(1), "complete"), ("cx", at(2), "failed"), ("c2", at(3), "complete"), ("c3", at(4), "complete"), ("c4", at(5), "complete")], "crawl_id string, observed_at timestamp_ntz, status string")
    rows = [("c1", "n", "a"), ("c2", "n", "a"), ("c3", "n", "b"), ("c4", "n", "a"), ("cx", "n", "z"), ("c1", "m", "k"), ("c3", "m", "k"), ("c2", "o", None), ("c3", "o", None), ("cx", "p", "q")]
    got = P.graph_history(spark.createDataFrame(rows, "crawl_id string, id string, content string"), crawls, ["id"], "content").collect()
    assert {(r.id, r.content, r.valid_from.day, r.valid_to.day if r.valid_to else None, r.n_crawls) for r in got} == {
        ("n", "a", 1, 4, 2), ("n", "b", 4, 5, 1), ("n", "a", 5, None, 1), ("m", "k", 1, 3, 1), ("m", "k", 4, 5, 1), ("o", None, 3, 5, 2),
    }


def test_graph_issues(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    nodes = [("a", "k", "x", sha("x"), "{}"), ("b", "k", "y", sha("y"), None)]
    edges = [("e", "a", "b", "z", sha("z"))]
    frames = lambda n, e: (spark.createDataFrame(n, "node_id string, kind string, content string, content_sha256 string, properties_json string"), spark.createDataFrame(e, "edge_id string, source_id string, target_id string, content string, content_sha256 string"))
    assert P.graph_issues(*frames(nodes, edges), {"nodes": 2, "edges": 1}).count() == 0
    worse = frames([*nodes, nodes[0], (" ", "k", "x", sha("q"), "{"), ("lone", "k", "x", None, "{}")], [*edges, ("f", "a", "gone", "z", sha("z")), (None, "a", None, "z", sha("z"))])
    assert {r.issue: r.rows for r in P.graph_issues(*worse, {"nodes": 2}).collect()} == {"bad_id": 2, "repeated_id": 1, "dangling_edge": 1, "lone_node": 2, "bad_hash": 2, "bad_json": 1, "bad_count": 3}

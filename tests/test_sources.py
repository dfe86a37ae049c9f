import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import books, joins, ledger, rules
from millrace.sources import snapshots


def ticks(spark, *rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, 1, 0, m), p) for k, m, p in rows], "k string, ts timestamp_ntz, p double")


def test_snapshot_versions(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = lambda version=None: sorted((r.k, r.ts.minute, r.p) for r in snapshots.scan_snapshot(spark, root, version).collect())
    snapshots.write_snapshot(ticks(spark, ("a", 1, 0.1), ("a", 1, 0.2), ("b", 2, 0.3)), root, "k", "ts", ["p"])
    with pytest.raises(ValueError, match="nothing is published"):
        snapshots.published(spark, root)
    snapshots.publish_snapshot(spark, root, 0, "k")
    assert rows() == [("a", 1, 0.2), ("b", 2, 0.3)]
    assert snapshots.update_snapshot(spark, root, 0, ticks(spark, ("a", 3, 0.4), ("c", 1, 0.5)), "k", "ts", ["p"]) == 1
    assert rows() == [("a", 1, 0.2), ("b", 2, 0.3)]
    snapshots.publish_snapshot(spark, root, 1, "k")
    assert rows() == [("a", 3, 0.4), ("b", 2, 0.3), ("c", 1, 0.5)]
    kept = spark.read.parquet(f"{root}/manifests/1").where("version = 0").count()
    assert kept == 1 and rows(0) == [("a", 1, 0.2), ("b", 2, 0.3)]
    assert snapshots.rollback(spark, root, "k") == 0 and rows() == [("a", 1, 0.2), ("b", 2, 0.3)]


def test_rollback_goes_back_each_time(spark, tmp_path):
    root = str(tmp_path / "s")
    base = snapshots.write_snapshot(ticks(spark, ("a", 1, 0.0)), root, "k", "ts", ["p"])
    versions = [base] + [snapshots.update_snapshot(spark, root, base, ticks(spark, ("a", i, i / 10)), "k", "ts", ["p"]) for i in (1, 2)]
    assert versions == [0, 1, 2]
    for v in versions:
        snapshots.publish_snapshot(spark, root, v, "k")
    assert [snapshots.rollback(spark, root, "k") for _ in range(2)] == [1, 0] and snapshots.published(spark, root) == 0
    with pytest.raises(ValueError, match="no version was published before"):
        snapshots.rollback(spark, root, "k")


def test_of_two_writers_one_wins(spark, tmp_path):
    root = str(tmp_path / "s")
    for i in range(2):
        snapshots.write_snapshot(ticks(spark, ("a", 1, i / 10)), root, "k", "ts", ["p"])
    seen = snapshots.publish_snapshot(spark, root, 0, "k")
    assert snapshots.publish_snapshot(spark, root, 1, "k", expected=seen) == seen + 1
    with pytest.raises(snapshots.Conflict):
        snapshots.publish_snapshot(spark, root, 0, "k", expected=seen)
    assert snapshots.published(spark, root) == 1


def test_retention_keeps_what_is_referred_to(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(ticks(spark, ("a", 1, 0.1), ("b", 1, 0.2), ("c", 1, 0.3)), root, "k", "ts", ["p"])
    for v in range(1, 4):
        snapshots.update_snapshot(spark, root, v - 1, ticks(spark, ("a", v, v / 10)), "k", "ts", ["p"])
        snapshots.publish_snapshot(spark, root, v, "k")
    before = {v: sorted(map(str, snapshots.scan_snapshot(spark, root, v).collect())) for v in (2, 3)}
    assert snapshots.retain(spark, root) == [2, 3]
    assert {v: sorted(map(str, snapshots.scan_snapshot(spark, root, v).collect())) for v in (2, 3)} == before
    left = {(v, p.name) for v in range(4) for p in (tmp_path / "s" / "data" / f"_version={v}").glob("bucket=*")}
    assert len(left) == 4 and not any(v == 1 for v, _ in left)  # b and c of the first, a of the last two
    assert snapshots.validate_snapshot(spark, root, 3, "k").isEmpty() and snapshots.rollback(spark, root, "k") == 2


def test_validation_sees_other_content(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = ticks(spark, ("a", 1, 0.1), ("b", 1, 0.2)).withColumn("v", F.lit(7))
    snapshots.write_snapshot(rows, root, "k", "ts", ["p"])
    assert snapshots.scan_snapshot(spark, root, 0).columns == ["k", "ts", "p", "v", "bucket"]
    assert snapshots.update_snapshot(spark, root, 0, rows.limit(0), "k", "ts", ["p"]) == 1 and snapshots.scan_snapshot(spark, root, 1).count() == 2
    bucket = next((tmp_path / "s" / "data" / "_version=0").glob("bucket=*"))
    held = snapshots.scan_snapshot(spark, root, 0).where(f"bucket = {bucket.name[7:]}").drop("bucket")
    held = spark.createDataFrame(held.collect(), held.schema)
    for change, issue in ((held.withColumn("p", F.col("p") + 1), {"content"}), (held.withColumn("k", F.lit("other")), {"content", "bucket"}), (held.union(held), {"counts", "content"})):
        rows_now = spark.createDataFrame(change.collect(), change.schema)
        rows_now.write.mode("overwrite").parquet(str(bucket))
        assert {r.issue for r in snapshots.validate_snapshot(spark, root, 0, "k").collect()} == issue
        with pytest.raises(ValueError, match="differs"):
            snapshots.publish_snapshot(spark, root, 0, "k")
    with pytest.raises(ValueError, match="rename"):
        snapshots.write_snapshot(rows.withColumn("bucket", F.lit(1)), root, "k", "ts", ["p"])


def test_empty_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write_snapshot(ticks(spark), root, "k", "ts", ["p"])
    snapshots.publish_snapshot(spark, root, 0, "k")
    assert snapshots.scan_snapshot(spark, root).count() == 0
    snapshots.update_snapshot(spark, root, 0, ticks(spark, ("a", 1, 0.5)), "k", "ts", ["p"])
    assert snapshots.scan_snapshot(spark, root, 1).count() == 1


def test_csv_contract(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("k,n\na,1\n,\n")
    bad.write_text("k,n\na,x\n")
    assert [tuple(r) for r in snapshots.read_csv_contract(spark, str(good), "k STRING, n INT").collect()] == [("a", 1), (None, None)]
    with pytest.raises(Exception, match="MALFORMED|BAD_RECORD|FAILED_READ|malformed"):
        snapshots.read_csv_contract(spark, str(bad), "k STRING, n INT").collect()


def test_release_csv_refuses(spark, tmp_path):
    with pytest.raises(ValueError, match="forbidden"):
        snapshots.release_csv(spark.createDataFrame([("=1+1",)], "t string"), str(tmp_path / "c"), rules.forbidden_text(F.col("t")))


def test_repeated_rows_match_on_their_own(spark):
    at = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([("x", "y", at), ("x", "y", at)], "h string, w string, t timestamp_ntz")
    b = spark.createDataFrame([("y", "x", at)], "bh string, bw string, bt timestamp_ntz")
    assert [r.match_count for r in joins.pair_match(a, b, ("h", "w"), ("bh", "bw"), "t", "bt", 60).collect()] == [1, 1]


def test_next_state_errors_keep_contiguous_progress(spark):
    columns = "k string, start_ts long, end_ts long, checked_ts long, rows_fetched long, had_error boolean, is_closed boolean, empty_run_streak long, max_seen_ts long, contiguous_ts long, checked_until_ts long"
    rows = [("err", 0, 90, 100, 5, True, True, 3, 80, 40, 50), ("none", 0, 90, 100, 0, True, False, 3, 0, 0, 0), ("empty", 0, 90, 100, 0, False, False, 2, 0, 0, 0), ("done", 0, 90, 100, 4, False, True, 2, 70, 70, 70)]
    got = {r.k: tuple(r)[1:] for r in ledger.next_state(spark.createDataFrame(rows, columns), "k", 10, 5, 15, 7).collect()}
    assert got == {"err": (40, 107, 0, False), "none": (None, 107, 0, False), "empty": (90, 115, 3, False), "done": (70, None, 0, True)}


def test_book_is_cleared_by_a_reset(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [("a", 1, t(0), False, 0.1, 5.0), ("a", 2, t(1), False, 0.2, 5.0), ("a", 3, t(2), True, 0.3, 1.0), ("a", 4, t(3), False, 0.3, 0.0)]
    lives = books.level_intervals(spark.createDataFrame(rows, "k string, i int, t timestamp_ntz, r boolean, p double, n double"), "k", ["i"], "t", F.col("r"), "p", "n")
    at = lambda m: [(r.levels, r.total_size) for r in books.book_at(lives, "k", [t(m)]).collect()]
    assert (at(0), at(1), at(2), at(3)) == ([(1, 5.0)], [(2, 10.0)], [(1, 1.0)], [])


def test_words_of_64_bits(spark):
    word = lambda n: f"{n:064x}"
    rows = spark.createDataFrame([(word(7) + word(2**64 - 1),), (word(2**64) + "ff",)], "d string")
    assert [tuple(r) for r in rows.select(books.data_word(F.col("d"), 0), books.data_word(F.col("d"), 1)).collect()] == [(7, 2**64 - 1), (None, None)]


def test_percentiles_of_ties_and_nulls(spark):
    rows = [("a", 1.0)] * 5 + [("a", 9.0), ("b", 2.0), ("b", None), ("c", None)]
    got = {(r.k, r.share): r.percentile for r in rules.exact_percentiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", [0.5, 0.9]).collect()}
    assert got == {("a", 0.5): 1.0, ("a", 0.9): 5.0, ("b", 0.5): 2.0, ("b", 0.9): 2.0}


def test_wall_clock_to_utc(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12),), (dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")
    assert [r[0].hour for r in rows.select(C.to_utc(F.col("t"), "America/New_York")).collect()] == [16, 17]

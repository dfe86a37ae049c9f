"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Plain DataFrame functions throughout. A window's hash is folded from its words' hashes; a hit on the hash set is
verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import row_key, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII other than digits and letters parts words.
PARTING = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum())
#: Bytes of windows that are broadcast as the hash set; a larger set is joined by shuffle.
BROADCAST_BYTES = 256 << 20


def words_of(text: Column) -> Column:
    """Runs of digits, a-z and anything beyond ASCII, A-Z lower-cased; null and empty texts have none."""
    plain = F.translate(F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit(" ")), UPPER + PARTING, LOWER + " " * len(PARTING))
    return F.array_remove(F.split(plain, " "), "")


def _with_window_hashes(df: DataFrame, n: int) -> DataFrame:
    """df with a column hashes<n>: from the words' hashes in hashes1, one hash for each run of n words.

    It is the XOR of the words' hashes, each rotated by its place. Runs of 1, 2, 4, 8 words are doubled up, so a window
    costs a few steps and not n; none of them can overflow. Each run length is a column, so none is worked out twice.
    """

    def side_by_side(df: DataFrame, n_left: int, n_right: int) -> DataFrame:
        name, turn = f"hashes{n_left + n_right}", 7 * n_right % 64
        if name in df.columns:
            return df
        size = F.greatest(F.size(f"hashes{n_right}") - n_left, F.lit(0))
        join = lambda x, y: F.shiftleft(x, turn).bitwiseXOR(F.shiftrightunsigned(x, 64 - turn) if turn else x).bitwiseXOR(y)
        return df.withColumn(name, F.zip_with(F.slice(f"hashes{n_left}", 1, size), F.slice(f"hashes{n_right}", n_left + 1, size), join))

    run, done = 1, 0
    while run <= n:
        if n & run:
            df, done = (side_by_side(df, run, done) if done else df), run + done
        if 2 * run <= n:
            df = side_by_side(df, run, run)
        run *= 2
    return df


def benchmark_windows(items: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """(hash, len, words, items): each distinct window with the items that hold it."""
    split = items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    split = split.withColumn("len", F.least(F.size("w"), F.lit(n))).withColumn("hashes1", F.transform("w", lambda x: F.xxhash64(x)))
    hashes = F.lit(None).cast("array<bigint>")
    for k in range(1, n + 1):
        split = _with_window_hashes(split, k)
        hashes = F.when(F.col("len") == k, F.col(f"hashes{k}")).otherwise(hashes)
    each = split.withColumn("hashes", hashes).select("item", "w", "len", F.posexplode_outer("hashes").alias("p", "hash"))
    each = each.withColumn("words", F.slice("w", F.col("p") + 1, F.col("len")))
    return each.groupBy("hash", "words", "len").agg(F.collect_set("item").alias("items"))


def _covered(spots: Column) -> Column:
    """Words that sorted [from, to) spots cover together."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("end"))
    step = lambda acc, s: F.struct((acc["sum"] + F.greatest(F.lit(0), s["to"] - F.greatest(s["from"], acc["end"]))).cast("long").alias("sum"), F.greatest(acc["end"], s["to"]).alias("end"))
    return F.aggregate(F.array_sort(spots), start, step, lambda acc: acc["sum"])


def hits(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text_col: str, n: int, key: list[str]) -> DataFrame:
    """(key, from, to, items): the places in docs' words where a benchmark window occurs."""
    grams = benchmark_windows(items, item_col, item_text_col, n)
    size = F.sum(F.octet_length(F.concat_ws(" ", "words")) + 16 * F.col("len") + F.octet_length(F.concat_ws(",", "items")) + 16 * F.size("items") + 64)
    n_bytes, lengths = grams.agg(size, F.collect_set("len")).first()
    if not lengths:
        return docs.select(*key, F.lit(0).alias("from"), F.lit(0).alias("to"), F.array(F.lit("")).alias("items")).where("false")
    split = docs.select(*key, words_of(F.col(text_col)).alias("w"))
    split = split.withColumn("hashes1", F.transform("w", lambda x: F.xxhash64(x)))
    # the windows of each length stand one after the other in one array; before[len] is where a length's windows start
    arrays, before, at = [], F.lit(0), F.lit(0)
    for size in sorted(lengths):
        split = _with_window_hashes(split, size)
        arrays.append(F.col(f"hashes{size}"))
        before = F.when(F.col("len") == size, at).otherwise(before)
        at = at + F.greatest(F.size("w") - size + 1, F.lit(0))
    split = split.withColumn("hashes", F.concat(*arrays))
    # an inner generator would have Spark repeat all of the above in a filter on the array's size, hence the outer one;
    # it takes a plain column and the look-up follows it, so one compiled stage scans and drops windows without copying the words
    if n_bytes <= BROADCAST_BYTES:
        found = split.select(*key, "w", F.posexplode_outer("hashes").alias("p", "hash")).join(F.broadcast(grams), "hash")
    else:
        # windows travel as numbers; the words of texts with a hit come back once, whatever its number of windows
        scanned = split.select(*key, F.posexplode_outer("hashes").alias("p", "hash")).join(grams.select("hash").distinct(), "hash")
        spots = scanned.groupBy(*key).agg(F.collect_set(F.struct("p", "hash")).alias("spots"))
        texts = docs.select(*key, words_of(F.col(text_col)).alias("w")).dropDuplicates(key).join(spots, key)
        found = texts.select(*key, "w", F.explode("spots").alias("s")).select(*key, "w", "s.p", "s.hash").join(grams, "hash")
    found = found.withColumn("from", F.col("p") - before)
    found = found.where((F.col("from") >= 0) & (F.slice("w", F.greatest("from", F.lit(0)) + 1, F.col("len")) == F.col("words")))
    return found.select(*key, "from", (F.col("from") + F.col("len")).alias("to"), "items")


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 10) -> DataFrame:
    """docs with n_words, n_hit (words inside an occurrence of a benchmark window), spots (their merged word ranges may
    overlap), hit_items (sorted item ids as strings) and contaminated.

    An item of fewer than n words, but not none, is one window. Null and empty texts have no words and no hits, as have
    null and empty items. Repeated rows are scored alike. Columns of docs with the names of results or _key are replaced.
    """
    results = ["n_words", "n_hit", "spots", "hit_items", "contaminated"]
    keyed = docs.drop(*results).withColumn("_key", row_key(text_col))
    found = hits(keyed, items, text_col, item_col, item_text_col, n, ["_key"])
    merged = found.groupBy("_key").agg(F.collect_set(F.struct("from", "to")).alias("spots"), F.collect_set("items").alias("sets"))
    merged = merged.select("_key", F.array_sort("spots").alias("spots"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("hit_items"))
    out = keyed.withColumn("n_words", F.size(words_of(F.col(text_col))).cast("long")).join(merged, "_key", "left")
    out = out.withColumn("spots", F.coalesce("spots", F.expr("cast(array() as array<struct<from: int, to: int>>)"))).withColumn("hit_items", F.coalesce("hit_items", F.expr("cast(array() as array<string>)")))
    return out.withColumn("n_hit", _covered(F.col("spots"))).withColumn("contaminated", F.col("n_hit") > 0).drop("_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", n: int = 10, **names) -> DataFrame:
    """docs without the rows that hold a benchmark window."""
    return contamination(docs, items, text_col, n=n, **names).where("NOT contaminated").select(*docs.columns)


def op9_query(spark, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    out = contamination(docs, items)
    return out.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM g),
o AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), h AS (
  SELECT o.doc_id, o.i, o.n, g.item_id FROM o JOIN g ON o.gram = g.gram AND o.n = g.n
), k AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""

"""Removal of long repeated byte strings by deep-shallow suffix sorting.

A string of `length` bytes has an anchor: of its grams of `gram` bytes, the first with the least hash. Equal strings
have equal anchors at equal places, so only suffixes at anchors (a content-defined sample) need sorting; the
others follow from them, as in induced suffix sorting. Spark groups anchors by their gram's hash; a gram
that occurs once proves that its strings do not repeat, and its anchor is dropped before any text is moved.

In each group the suffixes that start at the anchors are sorted, and so are the reversed prefixes that end there:
multikey quicksort on eight-byte symbols to a shallow depth, then a blind trie for each group that is still equal.
Two strings are equal if and only if, at the same anchor offset, they agree to the right in the one order
and to the left in the other; common-prefix lengths of neighbours tell that for all strings at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import hot_keys, lean, mix, powers, prefix_sums, release, row_blocks, row_key, salted_join, saved, shared_folder, sorted_groups, stored, table, text_buffer

KEY = "struct<a: long, b: long>"
GRAM = 64
SHALLOW = 128
#: Bytes that anchors are found in at once; a position in them fills CHUNK_BITS bits.
CHUNK_BITS = 20
#: Anchors whose suffixes are sorted at once.
SORT_ROWS = 4096


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    tiles = padded.reshape(-1, w)
    left = np.minimum.accumulate(tiles, axis=1).ravel()
    right = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def _anchors(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """Anchor hash, row, and within the row the anchor's place and the first and last start of its strings."""
    if len(data) < length:
        return None
    sums = prefix_sums(data)
    hashes = mix((sums[gram:] - sums[:-gram]) * powers(len(data) + 1)[1][: len(data) - gram + 1])
    place = np.arange(len(hashes), dtype=np.uint64)
    mask = np.uint64((1 << CHUNK_BITS) - 1)
    at = (_sliding_min((hashes & ~mask) | place, length - gram + 1) & mask).astype(np.int64)
    row = np.searchsorted(offs, np.arange(len(at)), side="right") - 1
    good = np.arange(len(at)) + length <= offs[row + 1]
    start = np.flatnonzero(good)
    if not len(start):
        return None
    at, row = at[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    base = offs[row[first]]
    return hashes[at[first]], row[first], at[first] - base, start[first] - base, start[last] - base


def _anchor_table(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    limit = 1 << CHUNK_BITS

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(1))
            for a, b in row_blocks(offs, limit):
                whole = data[offs[a] : offs[b]]
                step = limit - length + 1
                for c in range(0, max(1, len(whole) - length + 1), step) if len(whole) > limit else [0]:
                    piece = whole[c : c + limit]
                    got = _anchors(piece, offs[a : b + 1] - offs[a] if len(whole) <= limit else np.array([0, len(piece)]), length, GRAM)
                    if got:
                        h, row, p, lo, hi = got
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(pa.array(a + row)), *(pa.array((x + c).astype(np.int32)) for x in (p, lo, hi))], ["key", "_key", "p", "lo", "hi"])

    return docs.select("_key", text_col).mapInArrow(lean(run), f"key long, _key {KEY}, p int, lo int, hi int")


def _regions(texts: DataFrame, length: int) -> DataFrame:
    """Each anchor's surroundings: the bytes of all its strings, place = the anchor's place in them, starts = how many strings."""

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for row, (text, spots) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for s in spots:
                    out.append((s["key"], row, s["lo"], s["p"] - s["lo"], s["hi"] - s["lo"] + 1, text[s["lo"] : s["hi"] + length]))
                    size += s["hi"] + length - s["lo"]
                if size > 4_000_000:
                    yield _region_batch(out, batch.column(0))
                    out, size = [], 0
            if out:
                yield _region_batch(out, batch.column(0))

    found = texts.select("_key", F.encode("text", "UTF-8").alias("text"), "spots").mapInArrow(lean(run), f"key long, _key {KEY}, lo int, place int, starts int, bytes binary")
    return found.withColumn("region", F.xxhash64("key", "place", "starts", "bytes"))


def _region_batch(rows: list[tuple], keys: pa.Array) -> pa.RecordBatch:
    key, row, *rest = zip(*rows, strict=True)
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), keys.take(pa.array(row)), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))], ["key", "_key", "lo", "place", "starts", "bytes"])


def _quick_to_depth(words: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Multikey quicksort on eight-byte symbols, all groups at once: an order, and the ranges still equal at depth."""
    order = np.argsort(group, kind="stable")
    n = len(order)
    starts = np.flatnonzero(np.concatenate(([True], np.diff(group[order]) != 0)))
    spans = np.stack([starts, np.append(starts[1:], n), np.zeros(len(starts), np.int64)], axis=1)
    deep = []
    while len(spans):
        spans = spans[spans[:, 1] - spans[:, 0] > 1]
        at_depth = spans[:, 2] >= depth
        deep += [tuple(x) for x in spans[at_depth][:, :2].tolist()]
        spans = spans[~at_depth]
        if not len(spans):
            break
        sizes = spans[:, 1] - spans[:, 0]
        which = np.repeat(np.arange(len(spans)), sizes)
        pos = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + spans[which, 0]
        symbol = words[order[pos], spans[which, 2]]
        pivot = words[order[(spans[:, 0] + spans[:, 1]) // 2], spans[:, 2]][which]
        side = (symbol > pivot).astype(np.int64) - (symbol < pivot) + 1
        order[pos] = order[pos][np.argsort(which * 3 + side, kind="stable")]
        count = np.bincount(which * 3 + side, minlength=3 * len(spans)).reshape(-1, 3)
        ends = spans[:, :1] + np.cumsum(count, axis=1)
        begins = ends - count
        spans = np.concatenate([np.stack([begins[:, s], ends[:, s], spans[:, 2] + (s == 1)], axis=1) for s in range(3)])
    return order, deep


def _blind_trie_order(rows: np.ndarray, matrix: np.ndarray) -> list[int]:
    """The rows in order of their strings: a blind trie keeps only branching depths and symbols; one comparison places a string."""
    root: list | int = int(rows[0])
    twins: dict[int, list[int]] = {}
    for new in rows[1:].tolist():
        text, node, path = matrix[new], root, []
        while isinstance(node, list):
            path.append(node)
            node = node[1].get(int(text[node[0]]))
            if node is None:
                node = next(iter(path[-1][1].values()))
        same = text == matrix[node if not isinstance(node, list) else _leaf(node)]
        if same.all():
            twins.setdefault(_leaf(node), []).append(new)
            continue
        common = int(same.argmin())
        above = [x for x in path if x[0] < common]
        below = path[len(above)] if len(above) < len(path) else node
        if len(above) < len(path) and below[0] == common:
            below[1][int(text[common])] = new
            continue
        branch = [common, {int(matrix[_leaf(below)][common]): below, int(text[common]): new}]
        if above:
            above[-1][1][int(text[above[-1][0]])] = branch
        else:
            root = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            out += [node, *twins.get(node, ())]
    return out


def _leaf(node) -> int:
    while isinstance(node, list):
        node = next(iter(node[1].values()))
    return node


def suffix_order(strings: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow order of strings (cut to width) within their groups: each string's rank, and by rank the common prefix
    with the one before (0 where a group starts). A string's end differs from every byte."""
    n, deep_width = len(strings), -(-width // 8) * 8
    matrix = np.zeros((n, deep_width), np.int16)
    lengths = np.minimum([len(s) for s in strings], width)
    flat = np.frombuffer(b"".join(s[:width] for s in strings), np.uint8)
    row = np.repeat(np.arange(n), lengths)
    matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat.astype(np.int16) + 1
    shallow = min(SHALLOW, deep_width)
    # UTF-8 has no bytes 254 and 255, so the symbols fit one byte each here
    words = np.ascontiguousarray(np.minimum(matrix[:, :shallow], 255).astype(np.uint8)).view(">u8").astype(np.uint64)
    order, deep = _quick_to_depth(words, group, words.shape[1])
    for a, b in deep:
        order[a:b] = _blind_trie_order(order[a:b], matrix)
    lcp = np.zeros(n, np.int64)
    if n > 1:
        here, before = order[1:], order[:-1]
        same = matrix[here] == matrix[before]
        full = same.all(axis=1)
        lcp[1:] = np.where(full, deep_width, same.argmin(axis=1))
        lcp[1:] = np.minimum(lcp[1:], np.minimum(lengths[here], lengths[before]))
        lcp[1:][group[here] != group[before]] = 0
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return rank, lcp


def repeated_starts(group: np.ndarray, place: np.ndarray, starts: np.ndarray, regions: list[bytes], length: int) -> list[np.ndarray]:
    """For each region, which of its strings also start in another region of its group at the same anchor offset."""
    right_rank, right_lcp = suffix_order([r[p:] for r, p in zip(regions, place, strict=True)], group, length)
    left_rank, left_lcp = suffix_order([r[p - 1 :: -1] if p else b"" for r, p in zip(regions, place, strict=True)], group, length)
    new_group = np.concatenate(([True], np.diff(np.sort(group)) != 0))
    marks = [np.zeros(s, bool) for s in starts]
    for offset in range(int(place.max()) + 1):
        here = np.flatnonzero((place >= offset) & (place - offset < starts))
        if len(here) < 2:
            continue
        right = np.cumsum((right_lcp < length - offset) | new_group)[right_rank[here]]
        left = np.cumsum((left_lcp < offset) | new_group)[left_rank[here]]
        pair = right * (len(group) + 1) + left
        order = np.argsort(pair, kind="stable")
        equal = pair[order][1:] == pair[order][:-1]
        twice = np.zeros(len(here), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        for i in here[twice]:
            marks[i][place[i] - offset] = True
    return marks


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], marks.view(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def units(rows: DataFrame, block_rows: int = 2048) -> DataFrame:
    """Rows dealt to the units of work of their key: block numbers lo <= hi, and own = the row's block."""
    n = F.ceil(F.col("group_rows") / F.lit(block_rows)).cast("int")
    out = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), n).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "group_rows")


def _repeats(dealt: DataFrame, length: int) -> DataFrame:
    """(key, id, from, to): runs of repeated string starts in each region."""
    keys = ["key", "lo", "hi"]

    def solve(tables):
        group = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
        whole = pa.concat_tables(tables)
        grams, ids, place, starts = (whole.column(c).to_numpy() for c in ("key", "id", "place", "starts"))
        marks = repeated_starts(group, place.astype(np.int64), starts.astype(np.int64), whole.column("bytes").to_pylist(), length)
        out = [(g, i, a, b) for g, i, m in zip(grams.tolist(), ids.tolist(), marks, strict=True) for a, b in _runs(m)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["key", "id", "from", "to"])

    def run(batches):
        held, n = [], 0
        for unit in sorted_groups(batches, keys):
            if unit.num_rows > 1:
                held.append(unit)
                n += unit.num_rows
            if n >= SORT_ROWS:
                yield from solve(held)
                held, n = [], 0
        if held:
            yield from solve(held)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run), "key long, id long, `from` int, `to` int")


def _cut(texts: DataFrame) -> DataFrame:
    """(_key, spans): texts with their repeated spans cut out."""

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                merged: list[list[int]] = []
                for s in sorted((x["a"], x["b"]) for x in spans):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                kept, at = [], 0
                for a, b in merged:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                kept = b"".join(kept)
                out.append((sum(b - a for a, b in merged), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], ["_key", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.mapInArrow(lean(run), f"_key {KEY}, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 400, keep_text: bool = True) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and kept (binary): text_col without repeated strings.

    A byte goes if a string of `length` bytes covers it that starts anywhere else too, in the same text or another, overlaps
    included. Null and empty texts keep nothing and have zero counts; texts shorter than length stay whole. Repeated
    rows are copies of each other. kept is bytes, as a cut may split a character; keep_text=False leaves it out.
    Columns of docs with the names of results are replaced; others pass through, whatever their names. An empty table gives an
    empty table.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]
    columns = [c for c in docs.columns if c not in results]
    others = [c for c in columns if c != text_col]
    spread = [F.col(f"`{name}`") for name, kind in docs.dtypes if name in others and "map<" not in kind and "variant" not in kind]
    # the caller's columns travel in one, so that no name can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_all") if others else F.lit(0).alias("_all"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(*spread, F.lit(0)).alias("_spread"))
    own_name, text_col = text_col, "text"
    keyed = whole.withColumn("_key", row_key(text_col))
    found = stored(_anchor_table(keyed, text_col, length))
    often = saved(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = salted_join(found, often.select("key"), ["key"], hot_keys(often, ["key"], "n", found.count()), "left_semi", "_key", "p")
    spots = shared.groupBy("_key").agg(F.collect_set(F.struct("key", "p", "lo", "hi")).alias("spots"))
    texts = keyed.where(F.octet_length(text_col) >= length).groupBy("_key").agg(F.first(text_col).alias("text"), F.count("*").alias("copies"))
    place = shared_folder(docs.sparkSession, "suffixes")
    texts.join(spots, "_key").write.option("compression", "zstd").parquet(place)
    some = docs.sparkSession.read.parquet(place)
    release(docs.sparkSession)
    regions = _regions(some, length)
    distinct = regions.groupBy("key", "place", "starts", "bytes").agg(F.count("*").alias("n"))
    distinct = distinct.withColumn("id", F.xxhash64("key", "place", "starts", "bytes"))
    distinct = stored(distinct)
    release(docs.sparkSession)
    numbers = saved(distinct.groupBy("key").agg(F.count("*").alias("group_rows")).where("group_rows > 1"))
    grouped = salted_join(distinct.select("key", "id", "place", "starts", "bytes"), numbers, ["key"], hot_keys(numbers, ["key"], "group_rows", distinct.count()), "inner", "id")
    copied = distinct.where("n > 1")
    runs = saved(_repeats(units(grouped), length).union(copied.select("key", "id", F.lit(0).alias("from"), (F.col("starts") - 1).alias("to"))))
    runs = runs.groupBy("key", "id").agg(F.collect_set(F.struct("from", "to")).alias("runs"))
    at = regions.select("key", F.col("region").alias("id"), "_key", "lo")
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    spans = salted_join(at, runs, ["key", "id"], hot_keys(copied, ["key", "id"], "n", total), "inner", "_key", "lo").select("_key", "lo", F.explode("runs").alias("r"))
    spans = spans.groupBy("_key").agg(F.collect_set(F.struct((F.col("lo") + F.col("r.from")).alias("a"), (F.col("lo") + F.col("r.to") + length).alias("b"))).alias("spans"))
    everything = F.array(F.struct(F.lit(0).alias("a"), F.octet_length("text").alias("b")))
    marked = some.select("_key", "text", "copies").join(spans, "_key", "left").select("_key", F.encode("text", "UTF-8").alias("text"), F.when(F.col("copies") > 1, everything).otherwise(F.col("spans")).alias("spans")).where("spans IS NOT NULL")
    cut = _cut(marked)
    cut = saved(cut if keep_text else cut.drop("kept"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = keyed.withColumn("n_bytes", F.octet_length(text).cast("long")).withColumn("own_sha", F.sha2(text, 256))
    rows = saved(keyed.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1"))
    out = salted_join(base, cut, ["_key"], hot_keys(rows, ["_key"], "n", keyed.count()), "left", "_spread").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long"))).withColumn("n_spans", F.coalesce("n_spans", F.lit(0).cast("long"))).withColumn("kept_sha256", F.coalesce("kept_sha256", "own_sha"))
    if keep_text:
        out = out.withColumn("kept", F.coalesce("kept", F.encode(text, "UTF-8")))
    back = [F.col("text").alias(c) if c == own_name else F.col("_all").getField(c).alias(c) for c in columns]
    return out.select(*back, *results)


def op3_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, keep_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeats"))

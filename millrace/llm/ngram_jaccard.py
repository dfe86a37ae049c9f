"""Exact n-gram Jaccard join with signature trees.

Documents with equal shingle sets are one class. Two classes with Jaccard similarity >= t share one of the
first n - ceil(t*n) + 1 shingles of their sets under any fixed order (the prefix rule). The order is rarest first by count
sketches of words and shingles over all texts; with any sketch the same documents link. Spark groups classes by these shingles.
Within a group, signature trees find the candidates: a leaf holds rows that are nearest to one pivot row, every node the OR (and
AND) of its rows' token bitmaps and their size range; the dual traversal of two trees drops a pair of nodes whose largest
possible overlap is below what the threshold needs; the rows of leaves that are left are held against each other by the
same bound and by parity bitmaps, whose difference is never more than the sets'. Candidates are verified on the whole sets.
"""

from __future__ import annotations

import struct
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.linking import Matcher, entries_for, linked, shared_keys, verified, with_keys
from millrace.llm.shared import above_median, binaries, cell_levels, lean, mix, release, row_blocks, row_key, saved, stored, table, text_buffer, word_hashes

#: Bits of a class's token bitmap, and of its parity bitmap: a power of two of at least the set's size, from, to.
BITS = (128, 16384)
LEAF, FANOUT = 16, 8
#: 64-bit words of bitmaps that are compared at once.
COMPARED = 1 << 18
#: A shingle in 56 bits: how frequent it is, then its hash; and the bits of the hash that are left in a key.
RANK_BITS, HASH_BITS, KEY_HASH_BITS = 6, 50, 41
#: Rows of a block of texts: a row number and a shingle fill 64 bits, which sort as one number.
ROWS = 256


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, first word and word after the last of each run of k words, or of a whole row of fewer; and the hashes of all words."""
    words, row = word_hashes(data, offs)
    count = np.bincount(row, minlength=len(offs) - 1)
    n = max(0, len(words) - k + 1)
    acc = np.zeros(n, np.uint64)
    for i in range(k if n else 0):
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n])
    first = np.flatnonzero(row[:n] == row[len(row) - n :])
    acc, rows, end = acc[first], row[first], first + k
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        at = (np.cumsum(count) - count)[short]
        h = np.full(len(short), 0x5851F42D4C957F2D, np.uint64)
        for i in range(k - 1):
            has = count[short] > i
            h[has] = mix(h[has] * np.uint64(0xD6E8FEB86659FD93) + words[at[has] + i])
        acc, rows, first, end = (np.concatenate(x) for x in ((acc, h), (rows, short), (first, at), (end, at + count[short])))
    return acc, rows, first, end, words


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of at most ROWS rows, in order of (row, shingle), and how many each row has.

    levels: of words' and of shingles' cells, which put rare shingles first. Without them the order is that of the hashes.
    """
    acc, rows, first, end, words = shingles(data, offs, k)
    token = acc >> np.uint64(64 - HASH_BITS)
    if levels is not None and len(acc):
        total = np.concatenate(([0], np.cumsum(above_median(levels[0], words))))
        common = 3 * (total[end] - total[first]) // (2 * k)
        token |= np.minimum(common + 3 * above_median(levels[1], acc), (1 << RANK_BITS) - 1).astype(np.uint64) << np.uint64(HASH_BITS)
    held = np.sort(token | (rows.astype(np.uint64) << np.uint64(RANK_BITS + HASH_BITS)))
    held = held[np.concatenate(([True], held[1:] != held[:-1]))] if len(held) else held
    row = (held >> np.uint64(RANK_BITS + HASH_BITS)).astype(np.int64)
    return held & np.uint64((1 << (RANK_BITS + HASH_BITS)) - 1), np.bincount(row, minlength=len(offs) - 1)


def _sizes(count: np.ndarray) -> np.ndarray:
    return np.clip(np.left_shift(1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)), *BITS)


def bitmaps(token: np.ndarray, count: np.ndarray) -> list[bytes]:
    """Of each row the token bitmap (which bits some token falls to), then the parity bitmap (which bits an odd number falls to)."""
    row, bits = np.repeat(np.arange(len(count)), count), np.where(count > 0, _sizes(count), 0)
    start = np.concatenate(([0], np.cumsum(bits)))
    times = np.bincount(start[row] + (token & (bits[row] - 1).astype(np.uint64)).astype(np.int64), minlength=start[-1])
    some, odd = (np.packbits(x).tobytes() for x in (times > 0, times & 1))
    return [some[a // 8 : b // 8] + odd[a // 8 : b // 8] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]


def sketch(docs: DataFrame, k: int, share: Fraction, levels: np.ndarray) -> DataFrame:
    """Per row: n (set size), class (128 bits of hash of the set), entries (prefix shingles, each with the size's step) and sig (bitmap)."""
    up, down = share.numerator, share.denominator

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(1))
            for a, b in row_blocks(offs, rows=ROWS):
                token, count = shingle_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], k, levels)
                at = np.concatenate(([0], np.cumsum(count)))
                held = np.flatnonzero(count)
                cls = np.zeros((2, b - a), np.uint64)
                if len(held):
                    cls[0, held] = mix(np.add.reduceat(mix(token), at[held]) + count[held].astype(np.uint64))
                    cls[1, held] = mix(np.add.reduceat(mix(token ^ np.uint64(0xA24BAED4963EE407)), at[held]))
                row = np.repeat(np.arange(b - a), count)
                want = np.where(count > 0, count - -(-up * count // down) + 1, 0)
                keep = np.arange(len(token)) - at[row] < want[row]
                entries = entries_for(token[keep] >> np.uint64(HASH_BITS - KEY_HASH_BITS), count[row[keep]], float(share))
                cuts = np.concatenate(([0], np.cumsum(want))).tolist()
                packed = [entries[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                both = pa.StructArray.from_arrays([pa.array(c.view(np.int64)) for c in cls], ["a", "b"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(count, pa.int64()), both, binaries(packed), binaries(bitmaps(token, count))], ["_key", "n", "class", "entries", "sig"])

    return docs.mapInArrow(lean(run), "_key struct<a: long, b: long>, n long, class struct<a: long, b: long>, entries binary, sig binary")


def _bound(na, nb, miss_a, miss_b, up: int, down: int) -> np.ndarray:
    """Whether the largest possible overlap of sets of these sizes, of which so many items are missing in the other, is enough."""
    return (up + down) * np.minimum(na - miss_a, nb - miss_b) >= up * (na + nb)


class _Side:
    """Rows of one side in order of their bitmaps, folded to one width, and the tree above them."""

    def __init__(self, sets: "_Sets", rows: np.ndarray, words: int):
        bits = sets.folded(rows, words)
        pivots = bits[:: 2 * LEAF]
        near, far = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for at in _parts(np.arange(len(rows)), len(pivots) * words):
            apart = np.bitwise_count(bits[at][:, None, :] ^ pivots[None, :, :]).sum(2, dtype=np.int64)
            near[at], far[at] = apart.argmin(1), apart.min(1)
        order = np.lexsort((sets.n[rows], far, near))
        self.order, self.bits, near = rows[order], bits[order], near[order]
        self.n = sets.n[self.order]
        index = np.arange(len(rows))
        begin = np.maximum.accumulate(np.where(np.concatenate(([True], near[1:] != near[:-1])), index, 0))
        starts = np.flatnonzero((index - begin) % LEAF == 0)
        self.levels = [self._level(starts, np.append(starts[1:], len(rows)), self.bits, self.bits, self.n, self.n, starts)]
        while len(self.levels[-1]["lo"]) > 1:
            b = self.levels[-1]
            at = np.arange(0, len(b["lo"]), FANOUT)
            self.levels.append(self._level(b["start"][at], b["end"][np.minimum(at + FANOUT, len(b["lo"])) - 1], b["any"], b["all"], b["lo"], b["hi"], at))

    def _level(self, start, end, any_bits, all_bits, lo, hi, at):
        return {"start": start, "end": end, "any": np.bitwise_or.reduceat(any_bits, at), "all": np.bitwise_and.reduceat(all_bits, at), "lo": np.minimum.reduceat(lo, at), "hi": np.maximum.reduceat(hi, at)}


def _may_overlap(a: dict, i: np.ndarray, b: dict, j: np.ndarray, up: int, down: int) -> np.ndarray:
    """Whether some pair of the nodes i and j can reach the threshold."""
    keep = np.zeros(len(i), bool)
    for at in _parts(np.arange(len(i)), a["any"].shape[1]):
        x, y = i[at], j[at]
        least_a, least_b = np.maximum(a["lo"][x], -(-up * b["lo"][y] // down)), np.maximum(b["lo"][y], -(-up * a["lo"][x] // down))
        miss_a = np.bitwise_count(a["all"][x] & ~b["any"][y]).sum(1, dtype=np.int64)
        miss_b = np.bitwise_count(b["all"][y] & ~a["any"][x]).sum(1, dtype=np.int64)
        most = np.minimum(a["hi"][x] - miss_a, b["hi"][y] - miss_b)
        keep[at] = (up * a["lo"][x] <= down * b["hi"][y]) & (up * b["lo"][y] <= down * a["hi"][x]) & ((up + down) * most >= up * (least_a + least_b))
    return keep


def node_pairs(a: _Side, b: _Side, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of leaves that the dual traversal leaves."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        keep = _may_overlap(a.levels[la], i, b.levels[lb], j, up, down)
        i, j = i[keep], j[keep]
        if not len(i) or la == lb == 0:
            return i, j
        if la >= lb:
            i, j, la = *_children(i, j, len(a.levels[la - 1]["lo"])), la - 1
        if lb > la:
            j, i, lb = *_children(j, i, len(b.levels[lb - 1]["lo"])), lb - 1
        if a is b and la == lb:
            i, j = i[i <= j], j[i <= j]


def signature_tree_pairs(sets: "_Sets", left: np.ndarray, right: np.ndarray | None, share: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs by dual traversal; bounds only, so no true pair is dropped."""
    up, down = share.numerator, share.denominator
    words = int(min(sets.words[left].min(), sets.words[left if right is None else right].min()))
    a = _Side(sets, left, words)
    b = a if right is None else _Side(sets, right, words)
    i, j = node_pairs(a, b, up, down)
    found = [(np.zeros(0, np.int64),) * 2]
    square = np.arange(LEAF)
    for part in _parts(np.arange(len(i)), LEAF * LEAF * words):
        ra = (a.levels[0]["start"][i[part]][:, None] + square)[:, :, None] + np.zeros(LEAF, np.int64)
        rb = (b.levels[0]["start"][j[part]][:, None] + square)[:, None, :] + np.zeros((LEAF, 1), np.int64)
        good = (ra < a.levels[0]["end"][i[part]][:, None, None]) & (rb < b.levels[0]["end"][j[part]][:, None, None])
        if a is b:
            good &= ra < rb
        ra, rb = ra[good], rb[good]
        # the bitmaps here have the width of the narrowest of the unit, at which large sets look alike; allow() takes the widest
        good = (up * a.n[ra] <= down * b.n[rb]) & (up * b.n[rb] <= down * a.n[ra])
        ra, rb = ra[good], rb[good]
        x, y = a.bits[ra], b.bits[rb]
        good = _bound(a.n[ra], b.n[rb], np.bitwise_count(x & ~y).sum(1, dtype=np.int64), np.bitwise_count(y & ~x).sum(1, dtype=np.int64), up, down)
        ia, ib = a.order[ra[good]], b.order[rb[good]]
        good = sets.allow(ia, ib, share)
        found.append((ia[good], ib[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Sets:
    """Set sizes and bitmaps of a table's rows. Bitmaps of different widths compare after the wider one is folded."""

    def __init__(self, rows: pa.Table):
        self.n = rows.column("n").to_numpy()
        column = rows.column("sig").combine_chunks().cast(pa.large_binary())
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        _, offsets, data = column.buffers()
        self.start = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // 8
        self.data = np.frombuffer(data, np.uint64)
        self.words = np.diff(self.start) // 2

    def folded(self, rows: np.ndarray, words: int, parity: bool = False) -> np.ndarray:
        out = np.empty((len(rows), words), np.uint64)
        for width in np.unique(self.words[rows]):
            at = np.flatnonzero(self.words[rows] == width)
            cells = (self.start[rows[at]] + (width if parity else 0))[:, None] + np.arange(width)[None, :]
            out[at] = (np.bitwise_xor if parity else np.bitwise_or).reduce(self.data[cells].reshape(len(at), -1, words), axis=1)
        return out

    def allow(self, ia: np.ndarray, ib: np.ndarray, share: Fraction) -> np.ndarray:
        """Which pairs can reach the threshold by their sizes and parity bitmaps, each at the width of the narrower one."""
        up, down = share.numerator, share.denominator
        keep = (up * self.n[ia] <= down * self.n[ib]) & (up * self.n[ib] <= down * self.n[ia])
        width = np.minimum(self.words[ia], self.words[ib])
        for w in np.unique(width[keep]):
            for at in _parts(np.flatnonzero(keep & (width == w)), int(self.words.max(initial=0))):
                odd = np.bitwise_count(self.folded(ia[at], int(w), parity=True) ^ self.folded(ib[at], int(w), parity=True)).sum(1, dtype=np.int64)
                keep[at] = odd * (up + down) <= (down - up) * (self.n[ia[at]] + self.n[ib[at]])
        return keep


class SignatureTrees(Matcher):
    columns = ["n", "sig"]

    def __init__(self, share: Fraction):
        self.share = share

    def prepare(self, rows: pa.Table) -> _Sets:
        return _Sets(rows)

    def leaf(self, sets: _Sets, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        return sets.allow(ia, ib, self.share)

    def tree(self, sets: _Sets, left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        return signature_tree_pairs(sets, left, right, self.share)


def _parts(rows: np.ndarray, words: int) -> list[np.ndarray]:
    return np.array_split(rows, max(1, -(-len(rows) * words // COMPARED)))


def _children(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    kids = (i[:, None] * FANOUT + np.arange(FANOUT)[None, :]).ravel()
    return kids[kids < n], np.repeat(j, FANOUT)[kids < n]


def _packed_texts(docs: DataFrame) -> DataFrame:
    """From (id, unit, text) to the same with items, the text compressed: half the size of its shingles or less."""

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            raw = data.tobytes()
            items = binaries([struct.pack("<q", b - a) + pa.compress(raw[a:b], codec="zstd", asbytes=True) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items], ["id", "unit", "items"])

    return docs.mapInArrow(lean(run), "id long, unit long, items binary")


def jaccard_classes(docs: DataFrame, text_col: str = "text", k: int = 3, threshold: str | float = "0.9", id_col: str | None = None) -> DataFrame:
    """docs with n_shingles and group_key: rows that links of Jaccard >= threshold join, directly or not, have the same one.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of fewer than k words is one
    shingle. Null, empty and blank texts have n_shingles 0 and a null group_key: they link with nothing.
    Repeated rows stay and share a group. Other columns of docs pass through unless they are named _key,
    n_shingles or group_key. An empty table gives an empty table.
    """
    share = Fraction(Decimal(str(threshold)))
    up, down = share.numerator, share.denominator
    keyed = docs.drop("n_shingles", "group_key").withColumn("_key", row_key(text_col, *([id_col] if id_col else [])))

    def tokens(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        acc, _, _, _, words = shingles(data, offs, k)
        return [words, acc]

    levels = cell_levels(docs, text_col, tokens, 2)
    sketched = stored(sketch(keyed.select("_key", text_col), k, share, levels))
    one = F.first(F.struct("n", "sig", "entries", "_key")).alias("x")
    classes = sketched.where("n > 0").groupBy("class").agg(one).select("class", "x.*", (F.monotonically_increasing_id() + 1).alias("id"))
    classes = saved(classes)
    release(docs.sparkSession)

    def entries_of(batch: pa.RecordBatch):
        packed = batch.column(1).to_pylist()
        yield np.frombuffer(b"".join(packed), np.uint64), np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in packed])

    n_entries = (classes.agg(F.sum(F.octet_length("entries"))).first()[0] or 0) // 8
    rows = shared_keys(classes.select("id", "entries"), entries_of, n_entries, float(share))

    def fetch(needed: DataFrame) -> DataFrame:
        at = needed.join(classes.select("id", "_key"), "id")
        # rows that were repeated give the same text, one is enough
        texts = with_keys(keyed.select("_key", text_col), at, "_key").select("id", "unit", text_col)
        return _packed_texts(texts).dropDuplicates(["id", "unit"])

    def decode(item: bytes) -> np.ndarray:
        data = np.frombuffer(pa.decompress(item[8:], struct.unpack("<q", item[:8])[0], codec="zstd", asbytes=True), np.uint8)
        return shingle_sets(data, np.array([0, len(data)]), k)[0]

    def accept(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return down * both >= up * (len(x) + len(y) - both)

    roots = linked(rows, classes, SignatureTrees(share), lambda pairs: verified(pairs, fetch, decode, accept))
    groups = classes.select("class", "id").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("class", F.coalesce("root", "id").alias("group_key"))
    of_text = sketched.select("_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class")).distinct().join(groups, "class", "left")
    return keyed.join(of_text.drop("class"), "_key").drop("_key")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", k: int = 5, threshold: str | float = "0.8") -> DataFrame:
    """docs with one row of each group, that of the smallest id (nulls last); rows without shingles all stay.

    Of rows that repeat an id and a text one stays, its other columns as in any of them. Columns of docs pass through.
    """
    columns = docs.columns
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("_row", row_key("id", "text"))
    grouped = saved(jaccard_classes(narrow, "text", k, threshold, "id").select("id", "_row", "group_key"))
    best = grouped.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row")).alias("best"), F.count("*").alias("n"))
    chosen = best.select(F.col("best._row").alias("_row"), F.lit(True).alias("_one")).union(grouped.where("group_key IS NULL").select("_row", F.lit(False)).distinct())
    times = grouped.groupBy("_row").agg((F.count("*") > 1).alias("_repeated"))
    chosen = chosen.join(times, "_row").select("_row", (F.col("_one") & F.col("_repeated")).alias("_repeated"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_all"), row_key(id_col, text_col).alias("_row")).join(chosen, "_row")
    # a partial aggregate: each task sends one of the repeated rows it has
    single = whole.where("_repeated").groupBy("_row").agg(F.first("_all").alias("_all"))
    return whole.where("NOT _repeated").select("_all").unionByName(single.select("_all")).select("_all.*")


def op10_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = jaccard_classes(docs, k=3, threshold="0.9", id_col="doc_id").select("doc_id", "n_shingles", "group_key")
    least = grouped.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "group_key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

"""Links between classes that share a blocking key, without writing out all pairs of a group.

Blocking. Each task sends the entries (key, size) of its classes in sorted runs, dealt by key; where they meet, a class keeps the
keys that another class of a fitting size has too. A key that is frequent in a task's run is known to be shared: its rows skip
that step, and only a few entries without a class go on in their place. So no task gathers all rows of a hot key.

Linking. Groups of a key are cut into blocks of bounded size; a unit of work holds two blocks at most. Each round gives
candidate pairs by the operator's filter (which may err only towards too many), verifies them and merges components.
First, each class takes part only in its block of the groups of two of its keys: near copies share most keys, so this
joins most of them at once, in work linear in the rows. Then all groups that still hold two components take part; in large
ones the rows of the largest component lie in blocks, once each, and only the other rows meet every block. Each unit emits a
forest of its candidate pairs between components; a unit that has more is dense. Last, the dense units emit all pairs
that still lie between two components, each pair in the least unit in which it meets. So each candidate pair is verified or lies within a component: no link between
components is lost, and a group of n mutual near copies costs about n verifications, not n*n/2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import binaries, complete_groups, lean, mix, release, saved, sorted_groups, stored

#: Rows of a block; a unit of work holds two blocks at most.
BLOCK_ROWS = 2048
#: Rows up to which all pairs of a unit are filtered at once.
LEAF_ROWS = 32
#: Items (words, shingles) of the pairs that are verified together.
VERIFY_ITEMS = 500_000
#: Items of decoded contents that a task keeps.
DECODED_ITEMS = 2_000_000
#: Rows to fetch contents for that are broadcast to the scan of the table; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Entries of a task's run, and of the runs that meet in a bucket on average.
RUN_ENTRIES, BUCKET_ENTRIES = 1 << 19, 1 << 19
#: Rows of a key in a run from which on the key is known to be shared.
FREQUENT = 64
#: An entry in 64 bits: key, size, and where in the class the key stands.
KEY_BITS, SIZE_BITS, PLACE_BITS = 47, 8, 9
LOW_BITS = np.uint64(SIZE_BITS + PLACE_BITS)
#: Neighbours of an entry among those of its key that its place is held against; in larger groups places don't count.
NEIGHBOURS = 8


STEPS_APART = 3
#: Units that a row names, so that another unit can tell that a pair meets in one of them.
NAMED = 16


def size_steps(sizes: np.ndarray, least_ratio: float) -> np.ndarray:
    """A number of SIZE_BITS bits that grows with the size. Sizes of least_ratio or more to each other differ by STEPS_APART at most."""
    steps = np.floor(np.log(np.maximum(sizes, 1)) / (-np.log(least_ratio) / 2)).astype(np.int64)
    return np.clip(steps, 0, (1 << SIZE_BITS) - 1)


def entries_for(key: np.ndarray, sizes: np.ndarray, least_ratio: float, place: np.ndarray | None = None) -> np.ndarray:
    """Entries of keys of classes of these sizes; places from PLACE_BITS bits on count as the last of them."""
    low = size_steps(sizes, least_ratio).astype(np.uint64) << np.uint64(PLACE_BITS)
    if place is not None:
        low |= np.minimum(place, (1 << PLACE_BITS) - 1).astype(np.uint64)
    return (key << LOW_BITS) | low


def _met(entries: np.ndarray, ids: np.ndarray, least_ratio: float) -> np.ndarray:
    """Which of the sorted entries have another class's of the same key whose size fits, and whose place is no further off than items
    can be added or taken away. Id 0 is any class."""
    key, size = entries >> LOW_BITS, ((entries >> np.uint64(PLACE_BITS)) & np.uint64((1 << SIZE_BITS) - 1)).astype(np.int64)
    place = (entries & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    index = np.arange(len(key))
    begin = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), index, 0))
    crowded = np.zeros(len(key), bool)
    crowded[NEIGHBOURS:] = key[NEIGHBOURS:] == key[:-NEIGHBOURS]
    crowded = np.isin(begin, np.unique(begin[crowded])) if crowded.any() else crowded
    reach = np.exp((np.arange(1 << SIZE_BITS) + 1) * (-np.log(least_ratio) / 2)) * (1 - least_ratio) + 1e-6
    keep = np.zeros(len(key), bool)
    for k in range(1, NEIGHBOURS):
        near = (key[k:] == key[:-k]) & (size[k:] - size[:-k] <= STEPS_APART)
        near &= crowded[k:] | ((np.abs(place[k:] - place[:-k]) <= reach[size[k:]]) & ((ids[k:] != ids[:-k]) | (ids[k:] == 0)))
        keep[k:] |= near
        keep[:-k] |= near
    return keep


def _once(entries: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry of each key and class: in a group, more of them say nothing new and would fill blocks with one class."""
    key = entries >> LOW_BITS
    order = np.lexsort((ids, key))
    key, of = key[order], ids[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    return entries[order][first], of[first]


def _runs(parts: Iterator[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """From (entries, ids) to rows of a bucket's sorted entries and their ids. Frequent keys: bucket -1, all their rows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def run():
        entries, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(entries)
        entries, ids = entries[order], ids[order]
        key = entries >> LOW_BITS
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(start, len(key)))
        hot = np.repeat(count >= FREQUENT, count)
        if hot.any():
            yield -1, *_once(entries[hot], ids[hot])
            # in their place: each size once or twice, without a class
            some, times = np.unique(entries[hot], return_counts=True)
            some = np.repeat(some, np.minimum(times, 2))
            entries, ids = np.concatenate([entries[~hot], some]), np.concatenate([ids[~hot], np.zeros(len(some), np.int64)])
        bucket = (mix(entries >> LOW_BITS) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        entries, ids, bucket = entries[order], ids[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            if a < b:
                yield int(bucket[a]), entries[a:b], ids[a:b]

    def batch():
        rows = list(run())
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(binaries([r[i].tobytes() for r in rows]) for i in (1, 2))], ["bucket", "entries", "ids"])

    for entries, ids in parts:
        held.append((entries, ids))
        n += len(entries)
        if n >= RUN_ENTRIES:
            yield batch()
            held, n = [], 0
    if n:
        yield batch()


def shared_keys(source: DataFrame, entries_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], n_entries: int, least_ratio: float) -> DataFrame:
    """(key, id, group_rows) of each class's keys that a class of a fitting size shares. group_rows: about how many rows the
    key has, the same number in all of them.

    entries_of: from a batch of source to (entries_for keys, ids). least_ratio: of the sizes of two classes that may link.
    Ids are not 0 (0 stands for no class). n_entries: about how many entries there are, from which the number of buckets follows.
    """
    spark = source.sparkSession
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_entries // BUCKET_ENTRIES))

    def send(batches):
        yield from _runs((part for batch in batches for part in entries_of(batch)), buckets)

    def meet(batches):
        def known(batches):
            for batch in batches:
                hot = np.flatnonzero(batch.column(0).to_numpy() < 0)
                if len(hot):
                    direct.append([np.frombuffer(b"".join(batch.column(i).take(pa.array(hot)).to_pylist()), t) for i, t in ((1, np.uint64), (2, np.int64))])
                yield batch.slice(int(hot[-1]) + 1) if len(hot) else batch

        def flush():
            for entries, ids in direct:
                yield pa.RecordBatch.from_arrays([pa.array((entries >> LOW_BITS).view(np.int64)), pa.array(ids), pa.array(np.zeros(len(ids), np.int64))], names)
            direct.clear()

        names, direct = ["key", "id", "group_rows"], []
        for unit in sorted_groups(known(batches), ["bucket"]):
            yield from flush()
            entries, ids = (np.frombuffer(b"".join(unit.column(c).to_pylist()), t) for c, t in (("entries", np.uint64), ("ids", np.int64)))
            order = np.argsort(entries)
            entries, ids = entries[order], ids[order]
            keep = _met(entries, ids, least_ratio)
            entries, ids = _once(entries[keep], ids[keep])
            key = entries >> LOW_BITS
            if len(key):
                start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                count = np.diff(np.append(start, len(key)))
                real = (ids != 0) & np.repeat(count > 1, count)
                yield pa.RecordBatch.from_arrays([pa.array(key[real].view(np.int64)), pa.array(ids[real]), pa.array(np.repeat(count, count)[real])], names)
        yield from flush()

    runs = source.mapInArrow(lean(send), "bucket int, entries binary, ids binary")
    # the rows of frequent keys are spread over all tasks
    spread = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("ids"), F.lit(buckets)).cast("int")).otherwise(F.col("bucket"))
    met = stored(runs.repartition(spread).sortWithinPartitions("bucket").mapInArrow(lean(meet), "key long, id long, group_rows long"))
    release(spark)
    hot = met.where("group_rows = 0").select("key").distinct()
    if hot.isEmpty():
        return met
    counts = with_keys(met, hot, "key", how="left_semi").groupBy("key").agg(F.count("*").alias("_rows"))
    return with_keys(met, counts, "key", how="left").select("key", "id", F.coalesce("_rows", "group_rows").alias("group_rows"))


class Matcher:
    """An operator's filter for candidate pairs."""

    columns: list[str]

    def prepare(self, rows: pa.Table):
        """What leaf() and tree() need of the rows."""
        raise NotImplementedError

    def leaf(self, state, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        """Which of the pairs of row numbers stay."""
        raise NotImplementedError

    def tree(self, state, left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs between two sets of row numbers, or within one."""
        raise NotImplementedError


def _blocks(rows: F.Column) -> F.Column:
    return F.ceil(rows / F.lit(BLOCK_ROWS)).cast("int")


#: Turns the order of keys around in part.
TURN = 0x2AAAAAAAAAAA


def own_blocks(rows: DataFrame) -> DataFrame:
    """(key, id, lo, hi, own) of the least key of each id, and of its least one in another order, each in its block of the key's group."""
    least = rows.groupBy("id").agg(F.min("key").alias("p"), F.min(F.col("key").bitwiseXOR(F.lit(TURN))).bitwiseXOR(F.lit(TURN)).alias("q"))
    some = least.select("id", F.explode(F.array_distinct(F.array("p", "q"))).alias("key"))
    large = rows.where(F.col("group_rows") > BLOCK_ROWS).groupBy("key").agg(_blocks(F.max("group_rows")).alias("_blocks"))
    own = F.pmod(F.xxhash64("id", "key"), F.coalesce("_blocks", F.lit(1))).cast("int")
    return with_keys(some, large, "key", how="left").select("key", "id", own.alias("lo"), own.alias("hi"), own.alias("own"))


def all_blocks(rows: DataFrame) -> DataFrame:
    """Rows of (key, id, root, group_rows) in the units that together hold all pairs of different roots: lo, hi and the row's own block.

    A group of BLOCK_ROWS or fewer is one unit. In a larger one the rows of its most frequent root are in blocks from 0 on, the others
    in blocks below 0; pairs of two blocks from 0 on are left out.
    """
    large = rows.where(F.col("group_rows") > BLOCK_ROWS).groupBy("key", "root").agg(F.count("*").alias("n"))
    large = large.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    large = large.select("key", F.col("main.root").alias("_main"), _blocks(F.col("main.n")).alias("_blocks"), _blocks(F.col("n") - F.col("main.n")).alias("_others"))
    placed = with_keys(rows, large, "key", how="left")
    others = F.transform(F.sequence(F.lit(1), F.col("_others")), lambda i: -i)
    of_hash = lambda n: F.pmod(F.xxhash64("id", F.lit(7)), n).cast("int")
    main = F.col("root") == F.col("_main")
    placed = placed.withColumn("own", F.when(F.col("_main").isNull(), 0).when(main, of_hash(F.col("_blocks"))).otherwise(-1 - of_hash(F.col("_others"))))
    meets = F.when(F.col("_main").isNull(), F.array(F.lit(0))).when(main, others).otherwise(F.concat(others, F.sequence(F.lit(0), F.col("_blocks") - 1)))
    placed = placed.select("key", "id", "own", F.explode(meets).alias("other"))
    return placed.select("key", "id", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own")


def _forest(label: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs among rows that are grouped by label already."""
    label, out = label.copy(), []
    order = np.argsort(ib, kind="stable")
    ia, ib = ia[order], ib[order]
    cuts = np.flatnonzero(np.diff(ib)) + 1
    for near, at in zip(np.split(ia, cuts), ib[np.concatenate(([0], cuts))] if len(ib) else [], strict=True):
        found, first = np.unique(label[near], return_index=True)
        for x, i in zip(found, first, strict=True):
            if x != label[at]:
                out.append((near[i], at))
                label[label == x] = label[at]
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def _unit_pairs(rows: pa.Table, starts: np.ndarray, matcher: Matcher):
    """Candidate pairs of each unit: unit number, row numbers."""
    state, sizes = matcher.prepare(rows), np.diff(starts)
    own, lo, hi = (rows.column(c).to_numpy() for c in ("own", "lo", "hi"))
    apart = lo[starts[:-1]] != hi[starts[:-1]]
    found = []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF_ROWS)]):
        these = np.flatnonzero((sizes == size) & ~apart)
        i, j = np.triu_indices(size, 1)
        for part in np.array_split(these, max(1, len(these) * len(i) // 100_000)):
            ia, ib = ((starts[part][:, None] + k[None, :]).ravel() for k in (i, j))
            keep = matcher.leaf(state, ia, ib)
            found.append((np.repeat(part, len(i))[keep], ia[keep], ib[keep]))
    for u in np.flatnonzero((sizes > LEAF_ROWS) | (apart & (sizes > 1))):
        inside = np.arange(starts[u], starts[u + 1])
        if apart[u]:
            left, right = inside[own[inside] == lo[inside]], inside[own[inside] == hi[inside]]
            ia, ib = matcher.tree(state, left, right) if len(left) and len(right) else (inside[:0], inside[:0])
        else:
            ia, ib = matcher.tree(state, inside, None)
        found.append((np.full(len(ia), u), np.minimum(ia, ib), np.maximum(ia, ib)))
    unit, ia, ib = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
    order = np.argsort(unit, kind="stable")
    return unit[order], ia[order], ib[order]


def _named(rows: DataFrame) -> DataFrame:
    """rows of units with tag, which names the row's unit and side, and tags, the least NAMED of the id's."""
    side = F.when(F.col("lo") == F.col("hi"), 0).when(F.col("own") == F.col("lo"), 1).otherwise(2)
    tagged = saved(rows.withColumn("tag", F.xxhash64("key", "lo", "hi").bitwiseAND(F.lit(-4)).bitwiseOR(side.cast("long"))))
    tags = tagged.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("tag")), 1, NAMED).alias("tags"))
    return tagged.join(tags, "id")


def _met_before(rows: pa.Table, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Which pairs meet in a unit of a lesser tag that both rows name. In the least of all units in which a pair meets, it has not."""
    lists = rows.column("tags").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    count = lists.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(count)), count)
    tags = np.zeros((len(count), int(count.max(initial=1))), np.int64)
    known = np.zeros(tags.shape, bool)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    tags[row, place], known[row, place] = lists.flatten().to_numpy(), True
    unit, out = rows.column("tag").to_numpy() >> 2, np.zeros(len(ia), bool)
    for at in np.array_split(np.arange(len(ia)), max(1, len(ia) // 8192)):
        a = tags[ia[at]]
        lesser = known[ia[at]] & (a >> 2 < unit[ia[at]][:, None])
        apart = a[:, :, None] ^ tags[ib[at]][:, None, :]
        # the same unit: rows of its two sides meet, or any two where it has no sides
        meets = ((apart == 3) | ((apart == 0) & (a & 3 == 0)[:, :, None])) & known[ib[at]][:, None, :]
        out[at] = (meets & lesser[:, :, None]).any((1, 2))
    return out


def candidates(dealt: DataFrame, matcher: Matcher, whole: bool = False) -> DataFrame:
    """Rows (a, b, key, lo, hi, part) with a < b of pairs whose components (column root) differ: a forest of each unit, and (null, null,
    key, lo, hi, null) for a unit that has more pairs; whole: all of them, a pair that meets in many units but once as far as their rows
    name these. Pairs of a part have about VERIFY_ITEMS items."""
    keys = ["key", "lo", "hi"]

    def run(batches):
        for rows, starts in complete_groups(batches, keys):
            ids, root, n = (rows.column(c).to_numpy() for c in ("id", "root", "n"))
            unit, ia, ib = _unit_pairs(rows, starts, matcher)
            keep = root[ia] != root[ib]
            unit, ia, ib = unit[keep], ia[keep], ib[keep]
            if whole:
                keep = ~_met_before(rows, ia, ib)
                unit, ia, ib = unit[keep], ia[keep], ib[keep]
            dense = np.zeros(0, np.int64)
            if not whole:
                count = np.bincount(unit, minlength=len(starts) - 1)
                single = count[unit] == 1
                parts, many = [(unit[single], ia[single], ib[single])], []
                for u in np.flatnonzero(count > 1):
                    x, y = np.searchsorted(unit, [u, u + 1])
                    label = np.unique(root[starts[u] : starts[u + 1]], return_inverse=True)[1]
                    p, q = _forest(label, ia[x:y] - starts[u], ib[x:y] - starts[u])
                    parts.append((np.full(len(p), u), p + starts[u], q + starts[u]))
                    if len(p) < y - x:
                        many.append(u)
                dense = np.array(many, np.int64)
                unit, ia, ib = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((ib, ia, unit))
            unit, ia, ib = unit[order], ia[order], ib[order]
            part = np.cumsum(n[ia] + n[ib]) // VERIFY_ITEMS
            at, none = starts[unit], [None] * len(dense)
            columns = [pa.array([*f(ids[ia], ids[ib]).tolist(), *none], pa.int64()) for f in (np.minimum, np.maximum)]
            columns += [pa.array(np.concatenate([rows.column(k).to_numpy()[at], rows.column(k).to_numpy()[starts[dense]]]), t) for k, t in zip(keys, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([*part.tolist(), *none], pa.int64())], ["a", "b", *keys, "part"])

    need = [*keys, "own", "id", "root", *matcher.columns, *(["tag", "tags"] if whole else [])]
    found = dealt.select(need).repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(lean(run), "a long, b long, key long, lo int, hi int, part long")
    return saved(found)


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return with_keys(rows, roots.select(F.col("node").alias("id"), "root"), "id", how="left").withColumn("root", F.coalesce("root", "id"))


def _mixed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of groups that hold two components at least."""
    found = rows.groupBy(*keys).agg(F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x <> _y").select(*keys)
    return with_keys(rows, found, keys, how="left_semi")


def linked(rows: DataFrame, payload: DataFrame, matcher: Matcher, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, root) of every class that a verified link joins to another.

    rows: from shared_keys(). payload: (id, the matcher's columns). verify: keeps the true links of (a, b, unit).
    """
    details = payload.select("id", *matcher.columns)
    spark = rows.sparkSession

    release(spark)

    def merge(roots: DataFrame | None, found: DataFrame) -> DataFrame:
        release(spark)
        unit = F.xxhash64("key", "lo", "hi", "part")
        pairs = found.where("a IS NOT NULL").groupBy("a", "b").agg(F.min(unit).alias("unit"))
        links = verify(pairs)
        known = [] if roots is None else [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
        out = components(links.union(known[0]) if known else links)
        release(spark)
        return out

    roots = merge(None, candidates(own_blocks(rows).withColumn("root", F.col("id")).join(details, "id"), matcher))
    left = stored(all_blocks(stored(_mixed(_rooted(rows, roots), ["key"]))))
    release(spark)
    found = candidates(_rooted(left, roots).join(details, "id"), matcher)
    roots = merge(roots, found)
    dense = found.where("a IS NULL").select("key", "lo", "hi")
    if dense.isEmpty():
        return roots
    again = _mixed(_rooted(with_keys(left, dense, ["key", "lo", "hi"], how="left_semi"), roots), ["key", "lo", "hi"])
    return merge(roots, candidates(_named(again).join(details, "id"), matcher, whole=True))


def with_keys(df: DataFrame, needed: DataFrame, on: str | list[str], weight: F.Column | None = None, how: str = "inner") -> DataFrame:
    """df joined to the rows of needed: broadcast if their number (or the sum of weight, for rows that hold lists) allows, else by shuffle."""
    needed = saved(needed)
    rows = needed.count() if weight is None else needed.agg(F.sum(weight + 1)).first()[0] or 0
    return df.join(F.broadcast(needed) if rows <= BROADCAST_ROWS else needed, on, how)


class _Decoded:
    """The contents of a unit, decoded when asked for; the latest ones stay, up to DECODED_ITEMS."""

    def __init__(self, items: dict[int, bytes], decode: Callable[[bytes], np.ndarray]):
        self.items, self.decode, self.held, self.size = items, decode, {}, 0

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.held:
            while self.held and self.size > DECODED_ITEMS:
                self.size -= len(self.held.pop(next(iter(self.held))))
            self.held[i] = self.decode(self.items[i])
            self.size += len(self.held[i])
        return self.held[i]


def verified(pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame], decode: Callable[[bytes], np.ndarray], accept: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs (a, b, unit) whose contents accept() takes. Contents travel once for each unit, not once a pair.

    fetch: from (id, unit) to the same with items (binary), which decode() reads.
    """
    pairs = saved(pairs)
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id"), "unit").distinct()
    contents = fetch(needed).select("unit", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), "items")

    def run(batches):
        for unit in sorted_groups(batches, ["unit"]):
            a, b = unit.column("a").to_pylist(), unit.column("b").to_pylist()
            held = _Decoded({i: item for i, j, item in zip(a, b, unit.column("items").to_pylist(), strict=True) if j is None}, decode)
            asked = sorted((i, j) for i, j in zip(a, b, strict=True) if j is not None)
            good = [(i, j) for i, j in asked if accept(held[i], held[j])]
            if good:
                yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    both = contents.unionByName(pairs.withColumn("items", F.lit(None).cast("binary")))
    return saved(both.repartition("unit").sortWithinPartitions("unit").mapInArrow(lean(run), "a long, b long"))

"""Fuzzy line de-duplication: a join of normalised lines on their rarest pairs of words, and edit similarity.

Lines of equal normalised words are one class; one line of each goes on. An edit changes two pairs of neighbouring words at
most, so two lines within the edit rule have most of their pairs in common, and in any order of all pairs the first of both
share one: these are the join keys, rarest first by count sketches of words and pairs, and no link is lost. SimHash blocks
cannot do that: at an edit distance of a fifth half of 64 bits' blocks differ, so near lines rarely meet. The
parities of counts of words, more of them for longer lines, drop most other candidates. What is left is verified by the edit distance of the word
sequences, and of each connected group the first occurrence stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.linking import Matcher, entries_for, linked, shared_keys, verified, with_keys
from millrace.llm.shared import CELLS, CELL_KIND, above_median, binaries, cell_rows, count_cells, lean, levels_of, mix, release, row_blocks, row_key, saved, stored, table, text_buffer, word_spans

#: Words that a line needs for a link to one of other words.
LEAST_WORDS = 4
#: A pair of words in 47 bits: how frequent it is, then its hash. With a line's number in a block they fill 64 bits.
RANK_BITS, HASH_BITS, LINE_BITS = 5, 42, 17
#: The fewest 64-bit words of a line's parities, and how many of them are compared at once.
PARITY_WORDS, COMPARED = 2, 1 << 18

#: A-Z to a-z, digits to 0, other ASCII to a blank.
NORMAL = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 0x30 if chr(c).isdigit() else 0x20 for c in range(256))
_KEY_OF_ROW = "struct<a: long, b: long>"


def _line_words(data: np.ndarray, offs: np.ndarray):
    """Row, number in the row, 128-bit hash (two arrays), number of words and first word of each line that has words; and all words."""
    marks = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], marks + 1]))
    begin = begin[begin < len(data)]
    words, starts, _ = word_spans(data.tobytes().translate(NORMAL), offs)
    if not len(words):
        none = np.zeros(0, np.int64)
        return none, none, (none.view(np.uint64),) * 2, none, none, words
    line = np.searchsorted(begin, starts, side="right") - 1
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    count = np.diff(np.append(first, len(words)))
    placed = words + (np.arange(len(words)) - np.repeat(first, count)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    both = tuple(mix(np.add.reduceat(mix(placed ^ salt), first) + count.astype(np.uint64)) for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D)))
    starts = begin[line[first]]
    row = np.searchsorted(offs, starts, side="right") - 1
    number = np.searchsorted(marks, starts, side="left") - np.searchsorted(marks, offs[row], side="left")
    return row, number, both, count, first, words


def _pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word's index of each pair of neighbouring words of a line."""
    inside = np.ones(max(0, len(words) - 1), bool)
    inside[first[1:] - 1] = False
    at = np.flatnonzero(inside)
    return mix(words[at] * np.uint64(0xD6E8FEB86659FD93) + words[at + 1]), at


def keys_needed(count: np.ndarray) -> np.ndarray:
    """How many of its rarest pairs a line of so many words needs, so that it shares one with each line within the edit rule.

    The other line may be longer by k words; then at most (count + k) // 5 edits, of which k insertions, change
    2 * ((count + k) // 5) - k of this line's pairs. That is most for k = 0, or 1 where count + 1 is a multiple of 5.
    """
    return np.where(count >= LEAST_WORDS, 2 * (count // 5) + (count % 5 == 4) + 1, 0)


def rare_pairs(words: np.ndarray, first: np.ndarray, count: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the rarest pairs of each line, the line of each key, and where in the line it stands.

    A pair that repeats in a line has a key for each place. Of the pairs that an alignment of two lines keeps, the first in this order
    is among the first of both lines, and its places are no more apart than there are edits."""
    hashes, at = _pairs(words, first)
    line = np.repeat(np.arange(len(count)), count)[at]
    of_word = above_median(levels[0], words)
    rank = np.minimum((of_word[at] + of_word[at + 1]) // 2 + 3 * above_median(levels[1], hashes), (1 << RANK_BITS) - 1)
    key = (rank.astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS))
    bits = np.uint64(RANK_BITS + HASH_BITS)
    place = at - first[line]
    order = np.argsort((line.astype(np.uint64) << bits) | key, kind="stable") if len(count) < 1 << LINE_BITS else np.lexsort((key, line))
    key, line, place = key[order], line[order], place[order]
    start = np.cumsum(count - 1) - (count - 1)
    keep = np.arange(len(key)) - start[line] < keys_needed(count)[line]
    return key[keep], line[keep], place[keep]


def widths(count: np.ndarray) -> np.ndarray:
    """64-bit words of the parities of lines of so many words: a power of two. Fewer than 5 bits for 4 words are half odd whatever the
    line says, and then lines of 150 words that have nothing in common would pass for near ones."""
    return np.maximum(PARITY_WORDS, np.left_shift(1, np.ceil(np.log2(np.maximum(5 * count, 1) / 256)).astype(np.int64).clip(0)))


def parities(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[bytes]:
    """Bits of each line: whether an odd number of its words fall to the bit. A wider row folds to a narrower one by exclusive or."""
    wide = widths(count)
    start = np.concatenate(([0], np.cumsum(64 * wide)))
    h = mix(words + np.uint64(0x632BE59BD9B4E019))
    place = np.repeat(start[:-1], count) + (h & np.repeat((64 * wide - 1).astype(np.uint64), count)).astype(np.int64)
    odd = np.packbits(np.bincount(place, minlength=start[-1]) & 1, bitorder="little").tobytes()
    return [odd[a // 8 : b // 8] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]


def _lines(keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, _row, line, id) of each line that has words, id being 128 bits of hash; and rows of CELL_KIND that count words and pairs."""
    names = ["doc", "_row", "line", "id", "part", "salt", "counts"]
    doc_kind = dict(keyed.dtypes)[id_col]

    def run(batches):
        total, kinds = np.zeros((2, CELLS), np.int64), None
        for batch in batches:
            kinds = [batch.schema.field(0).type, batch.schema.field(1).type]
            data, offs = text_buffer(batch.column(2))
            for a, b in row_blocks(offs):
                row, number, both, _, first, words = _line_words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                if len(words):
                    count_cells(total, [words, _pairs(words, first)[0]])
                    at, n = pa.array(a + row), len(row)
                    ids = pa.StructArray.from_arrays([pa.array(x.view(np.int64)) for x in both], ["a", "b"])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(number.astype(np.int32)), ids, *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.binary()))], names)
        if kinds:
            cells = cell_rows(total)
            n = len(cells[0])
            yield pa.RecordBatch.from_arrays([pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.struct([("a", pa.int64()), ("b", pa.int64())])), *cells], names)

    return keyed.select(id_col, "_row", text_col).mapInArrow(lean(run), f"doc {doc_kind}, _row {_KEY_OF_ROW}, line int, id {_KEY_OF_ROW}, {CELL_KIND}")


def _left_lines(batches):
    """From batches of (_row, text, skip: line numbers) the lines of LEAST_WORDS words and more that are not to be skipped: the batch's
    rows, line numbers, ids (of row and line), numbers of words, first words, and all words."""
    for batch in batches:
        data, offs = text_buffer(batch.column(1))
        of_row = batch.column(0).field("a").to_numpy().view(np.uint64)
        skip = batch.column(2)
        gone_row, gone = np.repeat(np.arange(batch.num_rows), np.maximum(skip.value_lengths().fill_null(0).to_numpy(), 0)), skip.flatten().to_numpy()
        for a, b in row_blocks(offs):
            row, number, _, count, first, words = _line_words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            if not len(words):
                continue
            lo, hi = np.searchsorted(gone_row, [a, b])
            marks = (gone_row[lo:hi] - a) * (1 << 40) + gone[lo:hi]
            keep = (count >= LEAST_WORDS) & ~np.isin(row * (1 << 40) + number, marks)
            words, count = words[np.repeat(keep, count)], count[keep]
            if len(count):
                row, number = a + row[keep], number[keep]
                ids = mix(of_row[row] ^ mix(number.astype(np.uint64) + np.uint64(1))) | np.uint64(1)
                yield batch, row, number, ids.view(np.int64), count, np.cumsum(count) - count, words


def _features(left: DataFrame) -> DataFrame:
    """(id, _row, line, n, sig) of each line that may link."""

    def run(batches):
        for batch, row, number, ids, count, first, words in _left_lines(batches):
            columns = [pa.array(ids), batch.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(count.astype(np.int32)), binaries(parities(words, first, count))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "_row", "line", "n", "sig"])

    return left.mapInArrow(lean(run), f"id long, _row {_KEY_OF_ROW}, line int, n int, sig binary")


class _Parities:
    """Numbers of words and parities of a table's rows."""

    def __init__(self, rows: pa.Table):
        self.n = rows.column("n").to_numpy().astype(np.int64)
        sig, offs = rows.column("sig").to_pylist(), np.zeros(rows.num_rows + 1, np.int64)
        self.data = np.frombuffer(b"".join(sig), np.uint64)
        np.cumsum([len(x) // 8 for x in sig], out=offs[1:])
        self.start, self.words, self.folds = offs[:-1], np.diff(offs), {}

    def folded(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The parities of all rows of so many words or more, folded to that, and where in these a row stands."""
        if words not in self.folds:
            place, at = np.zeros(len(self.n), np.int64), np.flatnonzero(self.words >= words)
            place[at] = np.arange(len(at))
            bits = np.empty((len(at), words), np.uint64)
            for width in np.unique(self.words[at]):
                these = at[self.words[at] == width]
                cells = self.start[these][:, None] + np.arange(width)[None, :]
                bits[place[these]] = np.bitwise_xor.reduce(self.data[cells].reshape(len(these), -1, words), axis=1)
            self.folds[words] = bits, place
        return self.folds[words]

    def apart(self, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        """How many parities of each pair of rows differ, at the width of the narrower one."""
        out, width = np.zeros(len(ia), np.int64), np.minimum(self.words[ia], self.words[ib])
        for w in np.unique(width).tolist():
            bits, place = self.folded(w)
            pairs = np.flatnonzero(width == w)
            for at in np.array_split(pairs, max(1, -(-len(pairs) * w // COMPARED))):
                out[at] = np.bitwise_count(bits[place[ia[at]]] ^ bits[place[ib[at]]]).sum(1, dtype=np.int64)
        return out


class WordCounts(Matcher):
    """Each edit changes two counts of words at most, and one if it also changes the length."""

    columns = ["n", "sig"]

    def prepare(self, rows: pa.Table) -> _Parities:
        return _Parities(rows)

    def leaf(self, state: _Parities, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
        low, high = np.minimum(state.n[ia], state.n[ib]), np.maximum(state.n[ia], state.n[ib])
        keep = 5 * low >= 4 * high
        keep[keep] = state.apart(ia[keep], ib[keep]) <= (2 * (high // 5) - (high - low))[keep]
        return keep

    def tree(self, state, left: np.ndarray, right: np.ndarray | None):
        out = []
        other = left if right is None else right
        for a in range(0, len(left), 256):
            i, j = np.divmod(np.arange(min(256, len(left) - a) * len(other)), len(other))
            i = i + a
            keep = i < j if right is None else np.ones(len(i), bool)
            ia, ib = left[i[keep]], other[j[keep]]
            good = self.leaf(state, ia, ib)
            out.append((ia[good], ib[good]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def edit_within(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether the edit distance of two word sequences is at most `most`."""
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    head = n if same.all() else int(same.argmin())
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    same = x[len(x) - n :][::-1] == y[len(y) - n :][::-1]
    tail = n if same.all() else int(same.argmin())
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or len(y) - len(x) > most:
        return len(y) <= most
    if len(x) == len(y) and np.count_nonzero(x != y) <= most:
        return True
    known = set(y.tolist())
    if len(y) - sum(word in known for word in x.tolist()) > most:  # words of y that x cannot match
        return False
    steps = np.arange(len(y) + 1)
    row = steps.copy()
    for i, word in enumerate(x.tolist()):
        now = np.empty_like(row)
        now[0] = i + 1
        now[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != word))
        row = np.minimum.accumulate(now - steps) + steps
        if row.min() > most:
            return False
    return int(row[-1]) <= most


def _word_lists(docs: DataFrame) -> DataFrame:
    """From (text, wanted: lines with id, unit) to (id, unit, items), the hashes of those lines' words."""

    def run(batches):
        for batch in batches:
            parts, wanted = [], batch.column(1).combine_chunks() if isinstance(batch.column(1), pa.ChunkedArray) else batch.column(1)
            number = wanted.flatten().field("line").to_pylist()
            ends = np.cumsum(wanted.value_lengths().to_numpy())
            for row, end in enumerate(ends.tolist()):
                lines = batch.column(0)[row].as_py().encode().split(b"\n")
                parts += [lines[i] for i in number[len(parts) : end]]
            offs = np.cumsum([0, *map(len, parts)])
            words, starts, _ = word_spans(b"".join(parts).translate(NORMAL), offs)
            cuts = np.searchsorted(starts, offs).tolist()
            items = binaries([words[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)])
            yield pa.RecordBatch.from_arrays([*(wanted.flatten().field(c) for c in ("id", "unit")), items], ["id", "unit", "items"])

    return docs.mapInArrow(lean(run), "id long, unit long, items binary")


def _cut_lines(docs: DataFrame) -> DataFrame:
    """docs (text, _gone and others) with the lines of the numbers in _gone cut from text, and without _gone."""
    names = [c for c in docs.columns if c not in ("text", "_gone")]

    def run(batches):
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            texts = []
            for text, gone in zip(column["text"], column["_gone"], strict=True):
                gone = set(gone.as_py() or ())
                texts.append("\n".join(x for i, x in enumerate(text.as_py().split("\n")) if i not in gone) if gone else text.as_py())
            yield pa.RecordBatch.from_arrays([*(column[c] for c in names), pa.array(texts, pa.string())], [*names, "text"])

    kinds = dict(docs.dtypes)
    return docs.select(*names, "text", "_gone").mapInArrow(lean(run), ", ".join(f"`{c}` {kinds[c]}" for c in [*names, "text"]))


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with text_col cut to its first occurrences, and n_lines, n_removed.

    Lines are normalised: A-Z lower-cased, digits to 0, other ASCII characters part words. Lines without words always stay. Two
    lines link if their word edit distance is at most a fifth of the longer one. Of each connected group the occurrence of the
    smallest (id_col, line) stays, null ids last. Repeated rows are one document here: they keep the same lines. A null text
    stays null, an empty one empty. An empty table gives an empty table. Columns of docs named n_lines or n_removed are
    replaced; others pass through, whatever their names.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    others = [c for c in columns if c != text_col]
    # the caller's columns travel in one, so that no name can clash
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_all") if others else F.lit(0).alias("_all"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("doc"))
    keyed = whole.withColumn("_row", row_key("doc", "text"))
    found = stored(_lines(keyed, "doc", "text"))
    levels = levels_of(found.where("part IS NOT NULL").select("part", "salt", "counts"), 2)
    at = F.struct(F.col("doc").isNull().alias("none"), "doc", "line", "_row")
    lines = found.where("part IS NULL").select("id", "_row", "line", at.alias("at"))
    # repeated rows hold the same occurrences; whole numbers are compared first, places only in classes that have two
    spot = F.xxhash64("_row", "line")
    often = lines.groupBy("id").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).where("x <> y").select("id")
    repeated = saved(with_keys(lines, often, "id").groupBy("id").agg(F.min("at").alias("first")))
    skip = with_keys(lines, repeated, "id").where("at <> first").groupBy("_row").agg(F.collect_set("line").alias("skip"))
    left = with_keys(keyed.select("_row", "text"), skip, "_row", F.size("skip"), "left").select("_row", "text", "skip")
    features = stored(_features(left).dropDuplicates(["id"]))
    release(spark)

    def entries_of(batch: pa.RecordBatch):
        for _, _, _, ids, count, first, words in _left_lines([batch]):
            key, line, place = rare_pairs(words, first, count, levels)
            yield entries_for(key, count[line], 0.8, place), ids[line]

    n_entries = int(features.agg(F.sum(F.col("n") * 0.4 + 1)).first()[0] or 0)
    rows = shared_keys(left, entries_of, n_entries, 0.8)

    def fetch(needed: DataFrame) -> DataFrame:
        # a text travels once, however many of its lines are asked for
        wanted = needed.join(features.select("id", "_row", "line"), "id").groupBy("_row").agg(F.collect_list(F.struct("line", "id", "unit")).alias("wanted"))
        return _word_lists(with_keys(keyed.select("_row", "text"), wanted, "_row", F.size("wanted")).select("text", "wanted")).dropDuplicates(["id", "unit"])

    def decode(item: bytes) -> np.ndarray:
        return np.frombuffer(item, np.uint64)

    def accept(x: np.ndarray, y: np.ndarray) -> bool:
        return edit_within(x, y, max(len(x), len(y)) // 5)

    roots = linked(rows, features, WordCounts(), lambda pairs: verified(pairs, fetch, decode, accept))
    members = features.select("id", "_row", "line").join(roots.select(F.col("node").alias("id"), "root"), "id").select("_row", "line", "root")
    near = saved(with_keys(lines.select("id", "_row", "line"), members, ["_row", "line"]).select("id", "root").distinct())
    # a group's name is the least hash of its classes; classes without near lines are groups of their own
    names = near.groupBy("root").agg(F.min("id").alias("group"))
    groups = repeated.select("id").union(near.select("id")).distinct().join(near.join(names, "root").select("id", "group"), "id", "left").select("id", F.coalesce("group", "id").alias("group"))
    places = stored(with_keys(lines, groups, "id").select("group", "_row", "line", "at"))
    first = places.groupBy("group").agg(F.min("at").alias("first"))
    gone = with_keys(places, first, "group").where("at <> first").groupBy("_row").agg(F.collect_set("line").alias("_gone"))
    out = with_keys(keyed, gone, "_row", F.size("_gone"), "left")
    n_lines = F.when(F.length("text") > 0, F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).otherwise(0).cast("long")
    out = out.withColumn("_n_lines", n_lines).withColumn("_n_removed", F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long"))
    out = _cut_lines(out.select("_all", "text", "_gone", "_n_lines", "_n_removed"))
    back = [F.col("text").alias(c) if c == text_col else F.col("_all").getField(c).alias(c) for c in columns]
    return out.select(*back, F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"))


def op8_query(spark, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))

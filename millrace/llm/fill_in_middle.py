"""Fill-in-middle transformation: a text's cuts are located on a wavelet matrix over the classes of its characters.

A character's class says what it is (white space, line end, ASCII letter or digit, other) and whether a unit ends with it.
The number of units that end before a place is a sum of ranks of the ending classes; bisection on that sum finds the
place of the k-th end. Only counts and places leave Python: the texts are cut and put together by Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import BLOCK_BYTES, SPACES, row_blocks, table, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Classes of characters by their first byte; ENDS is added where a unit ends.
BLANK, LINE_END, ALPHANUMERIC, OTHER, ENDS = 0, 1, 2, 3, 4
LEVELS = 3
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[c for c in range(128) if chr(c).isalnum()]] = ALPHANUMERIC
KINDS[SPACES] = BLANK
KINDS[[0x0A, 0x0D]] = LINE_END


class WaveletMatrix:
    """Ranks of classes below 2**LEVELS: a bit vector a level, each with counts of ones before every 64 bits."""

    def __init__(self, classes: np.ndarray):
        self.size, self.bits, self.ones, self.zeros = len(classes), [], [], []
        for level in range(LEVELS - 1, -1, -1):
            bit = (classes >> level) & 1
            words = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, np.uint8)]), bitorder="little").view(np.uint64)
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.bits.append(words)
            self.ones.append(before)
            self.zeros.append(len(bit) - int(before[-1]))
            classes = np.concatenate([classes[bit == 0], classes[bit == 1]])

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.ones[level][word] + np.bitwise_count(self.bits[level][word] & ((np.uint64(1) << low) - np.uint64(1)))

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many of the first at characters are of this class, for many places at once."""
        start, end = np.zeros_like(at), at
        for level in range(LEVELS):
            one, first = self._rank1(level, end), self._rank1(level, start)
            if kind >> (LEVELS - 1 - level) & 1:
                start, end = self.zeros[level] + first, self.zeros[level] + one
            else:
                start, end = start - first, end - one
        return end - start

    def boundaries(self, at: np.ndarray) -> np.ndarray:
        """How many units end within the first at characters."""
        return sum(self.rank(kind + ENDS, at) for kind in (BLANK, LINE_END, ALPHANUMERIC, OTHER))

    def locate(self, count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest place between low and high within which count units end, by bisection."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high) >> 1
            enough = self.boundaries(middle) >= count
            high, low = np.where(open_ & enough, middle, high), np.where(open_ & ~enough, middle + 1, low)


def word_ends(kinds: np.ndarray, after: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A unit is white space and the word after it, or white space at the end of a text."""
    return last | ((kinds >= ALPHANUMERIC) & (after < ALPHANUMERIC))


def line_ends(kinds: np.ndarray, after: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A unit is a line with its line ends, or what follows the last of them."""
    return last | ((kinds == LINE_END) & (after != LINE_END))


UNITS: dict[str, Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]] = {"word": word_ends, "line": line_ends}


def _classes(data: np.ndarray, offs: np.ndarray, ends, follow: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all characters, and where each text starts among them. follow: the byte after the last text, if it goes on."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kinds = KINDS[data[lead]]
    starts = np.searchsorted(lead, offs)
    last = np.zeros(len(kinds), bool)
    filled = starts[1:] > starts[:-1]
    last[starts[1:][filled] - 1] = True
    after = np.empty_like(kinds)
    after[:-1] = kinds[1:]
    if len(kinds):
        after[-1] = OTHER if follow is None else KINDS[follow]
        last[-1] &= follow is None
    return kinds + ENDS * ends(kinds, after, last).astype(np.uint8), starts


def _cuts(data: np.ndarray, offs: np.ndarray, draws: np.ndarray, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the number of its units, and the places of its cuts after (draw modulo that number + 1) units."""
    classes, starts = _classes(data, offs, ends)
    matrix = WaveletMatrix(classes)
    low, high = starts[:-1], starts[1:]
    before = matrix.boundaries(low)
    units = matrix.boundaries(high) - before
    chosen = np.sort(draws % (units[:, None] + 1), axis=1)
    places = [np.where(chosen[:, i] == 0, low, matrix.locate(before + chosen[:, i], low, high)) - low for i in (0, 1)]
    return units, places[0], places[1]


def _long_cuts(data: np.ndarray, draws: np.ndarray, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one long text: a matrix for each of its pieces, of which one is held at a time."""
    edges = [0]
    while edges[-1] < len(data):
        b = min(edges[-1] + BLOCK_BYTES, len(data))
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        edges.append(b)

    def piece(i: int) -> WaveletMatrix:
        a, b = edges[i], edges[i + 1]
        return WaveletMatrix(_classes(data[a:b], np.array([0, b - a]), ends, int(data[b]) if b < len(data) else None)[0])

    chars, units = [0], [0]
    for i in range(len(edges) - 1):
        matrix = piece(i)
        chars.append(chars[-1] + matrix.size)
        units.append(units[-1] + int(matrix.boundaries(np.array([matrix.size]))[0]))
    places = []
    for count in sorted(draws[0] % (units[-1] + 1)):
        i = int(np.searchsorted(units, count)) - 1
        if count:
            matrix = piece(i)
            places.append(chars[i] + int(matrix.locate(np.array([count - units[i]]), np.array([0]), np.array([matrix.size]))[0]))
        else:
            places.append(0)
    return tuple(np.array([x]) for x in (units[-1], *places))


def located(text: Column, first: Column, second: Column, unit: str = "word") -> Column:
    """A struct of n, the text's units, and of low and high, the characters before the cuts after first % (n + 1) and
    second % (n + 1) units, the smaller one first. A null text is an empty one; it has no units, and both cuts are 0."""
    ends = UNITS[unit]

    @F.arrow_udf("struct<n: bigint, low: bigint, high: bigint>")
    def cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        data, offs = text_buffer(texts)
        draws = np.stack([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)], axis=1)
        found = [np.zeros(0, np.int64)] * 3
        for a, b in row_blocks(offs):
            part = data[offs[a] : offs[b]]
            now = _long_cuts(part, draws[a:b], ends) if b - a == 1 and len(part) > BLOCK_BYTES else _cuts(part, offs[a : b + 1] - offs[a], draws[a:b], ends)
            found = [np.concatenate(x) for x in zip(found, now, strict=True)]
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["n", "low", "high"])

    return cuts(text, first, second)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "word", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """docs with n, form, prefix_chars, middle_chars and output.

    The first four 8-digit groups of the sha256 of "seed:id" decide: two draw the cuts, one whether a text stays plain (all but
    rate in a hundred), one its form (spm in spm_rate of a hundred, else psm). psm is prefix, suffix, middle behind their marks,
    spm suffix, prefix, middle. A text that is empty or holds a mark stays plain; there prefix_chars and middle_chars are null.

    A null text is an empty one and a null id is read as ''. Rows with equal ids are cut by the same draws. Columns of docs named
    like a result are replaced; an empty table gives an empty table.
    """
    results = ["n", "form", "prefix_chars", "middle_chars", "output"]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = [c for c in docs.columns if c not in results or c in (id_col, text_col)]
    if clash := {id_col, text_col} & set(results):
        raise ValueError(f"{sorted(clash)} name results: rename these columns first")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (h[2] % 100 >= rate)
    taken = docs.select(*others, F.struct(located(text, h[0], h[1], unit).alias("cut"), F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm").alias("form")).alias("_fim"))
    low, high, form = F.col("_fim.cut.low").cast("int"), F.col("_fim.cut.high").cast("int"), F.col("_fim.form")
    prefix, middle, suffix = F.substring(text, F.lit(1), low), F.substring(text, low + 1, high - low), F.substring(text, high + 1, F.length(text) - high)
    mark = {k: F.lit(k) for k in (PREFIX, SUFFIX, MIDDLE)}
    output = (
        F.when(form == "plain", text)
        .when(form == "psm", F.concat(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle))
        .otherwise(F.concat(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle))
    )
    return taken.select(*others, F.col("_fim.cut.n").alias("n"), form.alias("form"), F.when(form != "plain", low).cast("long").alias("prefix_chars"), F.when(form != "plain", high - low).cast("long").alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that fill_in_middle() has made output from. Parts hold no mark, and none can arise where parts meet: a mark has
    no character twice and starts with one that no mark holds elsewhere."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.length(one) + len(second) + 1, F.length(rest))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def op13_query(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents
), h AS (
  SELECT *, len(w) AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2, ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h
), c AS (
  SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""

"""Source divergence audit: how the terms of a language's sources differ, from in-mapper stripes.

Each task folds whole documents into hash stripes, from a term to its document frequency and its count in each source, and
hands them on when they hold SPILL_ENTRIES entries and at its end. A shuffle merges the stripes of a (language, term). Merged
stripes then meet their language's sources, a few thousand terms at a time, and emit divergences directly.

All arithmetic is on whole numbers, exact up to 9 * 10**15 occurrences in a language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import BLOCK_BYTES, HOT_PARTS, lean, lists, stored, table, text_buffer

#: Letters of ASCII, A-Z lower-cased, and everything beyond ASCII make up terms; other bytes become blanks.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
#: Entries (a term in a source) that a task's stripes hold before they are handed on.
SPILL_ENTRIES = 400_000
#: Terms of a unit of the last step at most and, unless a unit would be more than 1/HOT_PARTS of all, at least.
MOST_TERMS, LEAST_TERMS = 4096, 32
#: Cells (a term or source by a source) worked on at once.
CELLS = 1 << 20
#: Languages over several units that are broadcast.
SPREAD_LANGUAGES = 1 << 16
#: Rows of a batch that a task hands on.
STRIPE_ROWS = 10_000
#: Smoothing of counts, and what relative frequencies are multiplied by.
SMOOTH, UNIT = 5, 1_000_000_000

STRIPE = "lang string, term string, stripe array<struct<source: string, n: bigint, d: bigint>>"


class _Stripes:
    """The stripes of one task: of each term its sources with n, its occurrences there, and d, the documents that hold it. While
    texts are folded they are kept source by source, as Counters count in C; rows() turns them round."""

    def __init__(self):
        self.held: dict[str, dict[str, tuple[Counter, Counter]]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, terms: list[bytes], new: set[bytes]) -> None:
        """terms: as they occur in a piece of a document; new: those of them that are new in the document."""
        counts, documents = self.held.setdefault(lang, {}).setdefault(source, (Counter(), Counter()))
        before = len(counts)
        counts.update(terms)
        documents.update(new)
        self.entries += len(counts) - before

    def rows(self):
        """The stripes as record batches; none are held after that."""
        held, self.held, self.entries = self.held, {}, 0
        for lang, sources in held.items():
            place: dict[bytes, int] = {}
            ids = [np.fromiter((place.setdefault(t, len(place)) for t in counts), np.int64, len(counts)) for counts, _ in sources.values()]
            codes = np.repeat(np.arange(len(sources)), [len(x) for x in ids])
            n = np.concatenate([np.fromiter(counts.values(), np.int64, len(counts)) for counts, _ in sources.values()])
            d = np.concatenate([np.fromiter((documents[t] for t in counts), np.int64, len(counts)) for counts, documents in sources.values()])
            ids = np.concatenate(ids)
            order = np.argsort(ids, kind="stable")
            offsets = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=len(place)))))
            names, terms = pa.array(list(sources), pa.string()), pa.array(list(place), pa.binary()).cast(pa.string())
            for a in range(0, len(place), STRIPE_ROWS):
                b = min(a + STRIPE_ROWS, len(place))
                at = order[offsets[a] : offsets[b]]
                entries = pa.StructArray.from_arrays([names.take(pa.array(codes[at])), pa.array(n[at]), pa.array(d[at])], ["source", "n", "d"])
                stripes = pa.ListArray.from_arrays(pa.array(offsets[a : b + 1] - offsets[a], pa.int32()), entries)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a), pa.string()), terms.slice(a, b - a), stripes], ["lang", "term", "stripe"])


def _pieces(raw: memoryview):
    """A text's bytes in pieces of about BLOCK_BYTES, cut where no term is cut."""
    a = 0
    while a < len(raw):
        b = min(a + BLOCK_BYTES, len(raw))
        while b < len(raw) and TERM_BYTES[raw[b]] != 0x20:
            b += 1
        yield bytes(raw[a:b]).translate(TERM_BYTES)
        a = b


def _fold(batches):
    held = _Stripes()
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        data, offs = text_buffer(batch.column(2))
        raw = memoryview(data)
        for lang, source, a, b in zip(langs, sources, offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            held.add(lang, source, [b""], {b""})  # the empty term counts documents, so that sources without terms occur too
            seen: set[bytes] = set()
            for piece in _pieces(raw[a:b]):
                terms = piece.split()
                new = set(terms)
                if b - a > BLOCK_BYTES:
                    new -= seen
                    seen |= new
                held.add(lang, source, terms, new)
                if held.entries > SPILL_ENTRIES:
                    yield from held.rows()
    yield from held.rows()


def term_stripes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30) -> DataFrame:
    """(lang, term, df, stripe): the merged stripe of every term in at least min_docs documents of its language; the stripe is an
    array of (source, n). The empty term stands for documents: each source of the language with its number of documents.

    Nulls are read as ''. Rows count as documents, so repeated rows count again; other columns are ignored. An empty table has no stripes.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))))
    entries = plain.mapInArrow(lean(_fold), STRIPE).repartition("lang", "term").select("lang", "term", F.explode("stripe").alias("e")).select("lang", "term", "e.*")
    # both groupings follow the shuffle by (lang, term): nothing is shuffled again
    summed = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    merged = summed.groupBy("lang", "term").agg(F.sum("d").alias("df"), F.collect_list(F.struct("source", "n")).alias("stripe"))
    return merged.where((F.col("term") == "") | (F.col("df") >= min_docs))


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + SMOOTH) / totals), three decimal digits at a time so that nothing overflows."""
    left, out = counts + SMOOTH, np.zeros(np.broadcast(counts, totals).shape, np.int64)
    whole, left = left // totals, left % totals  # a share of one leaves no more than whole = 1
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // totals, left % totals
    return 1 + whole * UNIT + out


class _Unit:
    """Some terms of one language with all of its sources."""

    def __init__(self, lang: str, heads: list[pa.RecordBatch], terms: list[pa.RecordBatch]):
        self.lang, heads = lang, pa.Table.from_batches(heads)
        self.sources = heads.column("item").combine_chunks()
        counts, kept_terms = heads.column("n").to_numpy(), heads.column("terms")[0].as_py()
        self.totals = counts + SMOOTH * kept_terms
        self.lang_total = counts.sum() + SMOOTH * kept_terms
        rows = pa.Table.from_batches(terms) if terms else None
        self.size = rows.num_rows if rows else 0
        if self.size:
            self.terms = rows.column("item").combine_chunks()
            stripe = rows.column("stripe").combine_chunks()
            flat = stripe.flatten()
            self.row = np.repeat(np.arange(self.size), pc.list_value_length(stripe).to_numpy())
            self.at = pc.index_in(flat.field("source"), value_set=self.sources).to_numpy()
            self.n = flat.field("n").to_numpy()

    def shares(self, a: int, b: int) -> np.ndarray:
        counts = np.zeros((b - a, len(self.sources)), np.int64)
        low, high = np.searchsorted(self.row, [a, b])
        counts[self.row[low:high] - a, self.at[low:high]] = self.n[low:high]
        return _shares(counts, self.totals[None, :])

    def rows(self):
        """Record batches of (lang, source, part, item, value): sums over this unit's terms for pairs of sources, each pair once."""
        n = len(self.sources)
        step = max(1, CELLS // max(n, 1))
        for first in range(0, n - 1, step):
            last = min(first + step, n)
            sums = np.zeros((last - first, n), np.int64)
            for a in range(0, self.size, step):
                shares = self.shares(a, min(a + step, self.size))
                for s in range(first, last):
                    sums[s - first] += np.abs(shares - shares[:, s : s + 1]).sum(axis=0)
            left, right = np.nonzero(np.arange(first, last)[:, None] < np.arange(n)[None, :])
            yield self._batch(left + first, "pair", self.sources.take(pa.array(right)), sums[left, right])
        if self.size:
            overall = _shares(np.add.reduceat(self.n, np.searchsorted(self.row, np.arange(self.size))), self.lang_total)
            gain = _shares(self.n, self.totals[self.at]) - overall[self.row]
            good = np.flatnonzero((gain > 0) & (self.n > 0))
            yield self._batch(self.at[good], "term", self.terms.take(pa.array(self.row[good])), gain[good])

    def _batch(self, source: np.ndarray, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        k = len(value)
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * k, pa.string()), self.sources.take(pa.array(source)), pa.array([part] * k, pa.string()), item, pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])


def _emit(batches):
    """From rows sorted by (lang, unit, kind): a unit's sources (kind 0), then its terms (kind 1)."""
    key, heads, terms = None, [], []
    for batch in batches:
        langs, units, kinds = batch.column("lang").to_pylist(), batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
        cuts = [0, *(i for i in range(1, len(langs)) if units[i] != units[i - 1] or langs[i] != langs[i - 1]), len(langs)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if key != (langs[a], units[a]):
                if key:
                    yield from _Unit(key[0], heads, terms).rows()
                key, heads, terms = (langs[a], units[a]), [], []
            middle = a + int(np.searchsorted(kinds[a:b], 1))
            heads += [batch.slice(a, middle - a)] if middle > a else []
            terms += [batch.slice(middle, b - middle)] if b > middle else []
    if key:
        yield from _Unit(key[0], heads, terms).rows()


def _unit_count(terms: Column, all_terms: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(terms / MOST_TERMS), F.least(F.ceil(terms * HOT_PARTS / F.greatest(all_terms, F.lit(1))), F.ceil(terms / LEAST_TERMS))).cast("int")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30, top_terms: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (language, source) that occurs.

    A source, or a whole language, gives each kept term with count occurrences the share 1 + floor(10**9 * (count + 5) / (N + 5 V)),
    where V is the number of the language's kept terms, those in at least min_docs of its documents, and N the sum of their counts.
    Part pair: each other source of the language, with the sum over kept terms of the shares' differences (0 without terms).
    Part term: the top_terms terms by how far the source's share exceeds the language's. Ranks are by value, descending, then by item.

    Nulls are read as '', repeated rows count again, a language with one source has no pairs, an empty table gives no rows.
    Terms of any length and texts of any size are taken whole; other columns are ignored.
    """
    merged = stored(term_stripes(docs, text_col, lang_col, source_col, min_docs))
    kept = merged.where("term != ''")
    totals = kept.select("lang", F.explode("stripe").alias("e")).groupBy("lang", "e.source").agg(F.sum("e.n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    units = _unit_count(F.col("terms"), F.lit(kept.count()))
    spread = vocabulary.withColumn("units", units).where("units > 1").select("lang", "units")
    spread = F.broadcast(spread) if spread.count() <= SPREAD_LANGUAGES else spread  # beyond that no language is a large part of all
    rows = kept.join(spread, "lang", "left").withColumn("unit", F.pmod(F.xxhash64("term"), F.coalesce("units", F.lit(1))).cast("int"))
    rows = rows.select("lang", "unit", F.lit(1).alias("kind"), F.col("term").alias("item"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("terms"), "stripe")
    heads = merged.where("term = ''").select("lang", F.explode("stripe.source").alias("source")).join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left").na.fill(0, ["n", "terms"])
    heads = heads.select("lang", F.explode(F.sequence(F.lit(0), units - 1)).alias("unit"), F.lit(0).alias("kind"), F.col("source").alias("item"), "n", "terms", F.lit(None).cast("array<struct<source: string, n: bigint>>").alias("stripe"))
    found = heads.union(rows).repartition("lang", "unit").sortWithinPartitions("lang", "unit", "kind").mapInArrow(lean(_emit), "lang string, source string, part string, item string, value bigint")
    found = stored(found)
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.union(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top_terms)
    return both.unionByName(terms)


def op11_query(spark, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30
), grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (
  SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY ALL
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM grp g JOIN kept k ON g.lang = k.lang LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM dense
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM dense GROUP BY lang, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
), r AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, p.source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""

"""License scans by a positional rare-token index.

Document frequencies of the templates' words, counted over all texts, say which words of a template are rarest. The index
holds the places of these in the templates. A text's words that are in it are looked up; each place of a template's word puts
the template at one place of the text, and where at least half of a template's places agree, its mandatory key phrases are verified.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import BLOCK_BYTES, lean, lists, table, text_buffer

#: Digits and letters of ASCII, A-Z lower-cased, and everything beyond ASCII make up words; other bytes become blanks.
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A or 0x30 <= c <= 0x39 else 0x20 for c in range(256))
#: Different words of a template that the index holds: half of them, RARE at most.
RARE = 8


@dataclass(frozen=True)
class Template:
    """A passage that shows a license, in lower-case words. keys: phrases of it that must occur within slack words of their
    place, as the passage's alignment gives it; a phrase that a passage has twice is looked for at the first place."""

    label: str
    text: str
    keys: tuple[str, ...]
    slack: int = 5

    @property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    def key_places(self) -> list[tuple[int, list[bytes]]]:
        words, out = self.words, []
        for key in self.keys:
            want = key.encode().split()
            out.append((next(i for i in range(len(words)) if words[i : i + len(want)] == want), want))
        return out


def phrase(label: str, text: str) -> Template:
    """A template of which every word must stand in its place."""
    return Template(label, text, (text,), 0)


#: Phrases whose places are all counted.
BASE = [phrase("cc-by", "cc by"), phrase("gpl", "general public license"), phrase("reserved", "all rights reserved")]

#: Passages of public licenses and of notices that name them (fixed values).
PASSAGES = [
    Template("agpl-3.0", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain", ("dedicated the work to the public domain",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("you can redistribute it and or modify it", "gnu general public license", "free software foundation")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "released under the mit license", ("the mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("subject to the terms of the mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
]


class TemplateIndex:
    """Postings of the templates' rarest words. documents: in how many documents a word occurs; ties go to the smaller word."""

    def __init__(self, templates: list[Template], documents: dict[bytes, int]):
        self.lengths = [len(t.words) for t in templates]
        self.keys = [t.key_places() for t in templates]
        self.slack = [t.slack for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.sizes = []
        for t, template in enumerate(templates):
            different = sorted(set(template.words), key=lambda w: (documents.get(w, 0), w))
            rare = set(different[: min(RARE, math.ceil(len(different) / 2))])
            places = [(o, w) for o, w in enumerate(template.words) if w in rare]
            self.sizes.append(len(places))
            for o, w in places:
                self.postings.setdefault(w, []).append((t, o))
        #: Words beyond a template's start that its places and key phrases can reach.
        self.reach = max((n + s for n, s in zip(self.lengths, self.slack, strict=True)), default=0)

    def find(self, words: list[bytes], low: int, high: int) -> list[tuple[int, int, float]]:
        """(template, start, share of its indexed places that agree) for verified starts from low to high, in order of starts.
        A start below 0 is that of a passage whose first words are cut off."""
        postings = self.postings
        votes = Counter((t, i - o) for i, w in enumerate(words) if w in postings for t, o in postings[w])
        good = [(t, d, n / self.sizes[t]) for (t, d), n in votes.items() if 2 * n >= self.sizes[t] and low <= d < high]
        return sorted((x for x in good if self._verified(words, x[0], x[1])), key=lambda x: (x[1], x[0]))

    def _verified(self, words: list[bytes], t: int, start: int) -> bool:
        slack = self.slack[t]
        return all(any(words[i : i + len(want)] == want for i in range(max(0, start + at - slack), start + at + slack + 1)) for at, want in self.keys[t])

    def scan(self, raw: memoryview) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of a text's words and all that is found in it; a long text is held in pieces that overlap by reach."""
        held: list[bytes] = []
        first, low, found = 0, -self.reach, []  # held[0] is word number first; starts below low are done
        for piece, last in _pieces(raw):
            held += piece
            high = first + len(held) - (0 if last else self.reach)
            if high > low:
                found += [(t, first + d, share) for t, d, share in self.find(held, low - first, high - first)]
                low = high
            drop = min(max(0, low - first - self.reach), len(held))
            n = first + len(held)
            held, first = held[drop:], first + drop
            if last:
                return n, found
        return 0, found


def _pieces(raw: memoryview) -> Iterator[tuple[list[bytes], bool]]:
    """A text's words, in pieces of about BLOCK_BYTES of text, and whether it ends there."""
    a = 0
    while True:
        b = min(a + BLOCK_BYTES, len(raw))
        while b < len(raw) and WORD_BYTES[raw[b]] != 0x20:
            b += 1
        yield bytes(raw[a:b]).translate(WORD_BYTES).split(), b == len(raw)
        a = b
        if a == len(raw):
            return


def word_documents(docs: DataFrame, text_col: str, words: list[bytes]) -> dict[bytes, int]:
    """In how many rows of docs each of these words occurs; what reaches the driver is no longer than words."""
    wanted = frozenset(words)

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            data, offs = text_buffer(batch.column(0))
            raw = memoryview(data)
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                seen: set[bytes] = set()
                for piece, _ in _pieces(raw[a:b]):
                    seen |= wanted.intersection(piece)
                held.update(seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counts = docs.select(text_col).mapInArrow(lean(count), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counts.collect()}


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: list[Template] | None = None) -> DataFrame:
    """docs with n_words and matches, an array of (label, start, end, share, place of the template in the list), by start.

    start and end are word numbers from 0; the first words of a passage can be cut off, then start is that of what is left.
    share is the part of a template's indexed places that agree on where it stands, from 0.5 to 1. Overlapping matches are all kept,
    also of templates with the same label. Null and empty texts have no words and no matches, texts of any length are scanned whole.
    Repeated rows are scanned alike, columns of docs named n_words or matches are replaced, an empty table gives an empty table.
    """
    templates = BASE + PASSAGES if templates is None else templates
    results = {"n_words", "matches"}
    if text_col in results:
        raise ValueError(f"{text_col} names a result: rename this column first")
    index = TemplateIndex(templates, word_documents(docs, text_col, sorted({w for t in templates for w in t.words})))

    @F.arrow_udf("struct<n_words: bigint, template: array<int>, start: array<bigint>, share: array<double>>")
    def scan(texts: pa.Array) -> pa.Array:
        data, offs = text_buffer(texts)
        raw = memoryview(data)
        rows = [index.scan(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        counts, flat = np.array([len(f) for _, f in rows], np.int64), [x for _, f in rows for x in f]
        columns = [lists(np.array([x[i] for x in flat], kind), counts, arrow) for i, (kind, arrow) in enumerate(((np.int32, pa.int32()), (np.int64, pa.int64()), (np.float64, pa.float64())))]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in rows], pa.int64()), *columns], ["n_words", "template", "start", "share"])

    labels, lengths = F.array(*(F.lit(t.label) for t in templates)), F.array(*(F.lit(len(t.words)) for t in templates))
    others = [c for c in docs.columns if c not in results]
    found = docs.select(*others, scan(text_col).alias("_scan"))
    match = lambda x: F.struct(labels[x["template"]].alias("label"), F.greatest(x["start"], F.lit(0)).alias("start"), F.least(x["start"] + lengths[x["template"]], F.col("_scan.n_words")).alias("end"), x["share"].alias("share"), x["template"].alias("template"))
    return found.select(*others, F.col("_scan.n_words").alias("n_words"), F.transform(F.arrays_zip("_scan.template", "_scan.start", "_scan.share"), match).alias("matches"))


def op12_query(spark, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["template"] < len(BASE))
    joined = lambda matches: F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
    places = F.transform(base, lambda m: m["start"])
    return out.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"), F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def _template_rows() -> str:
    return ", ".join(f"({t}, '{x.label}', {x.slack}, string_split('{x.text}', ' '))" for t, x in enumerate(BASE + PASSAGES))


def _key_rows() -> str:
    return ", ".join(f"({t}, {at}, {x.slack}, string_split('{b' '.join(want).decode()}', ' '))" for t, x in enumerate(BASE + PASSAGES) for at, want in x.key_places())


OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), template(t, label, slack, body) AS (VALUES {_template_rows()}),
key(t, place, slack, want) AS (VALUES {_key_rows()}),
body AS (SELECT t, unnest(body) AS word, generate_subscripts(body, 1) - 1 AS o FROM template),
df AS (
  SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS word FROM d) SEMI JOIN body USING (word) GROUP BY word
), ranked AS (
  SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY coalesce(df, 0), word) AS r, count(*) OVER (PARTITION BY t) AS n
  FROM (SELECT DISTINCT t, word FROM body) LEFT JOIN df USING (word)
), posting AS (
  SELECT t, o, word, count(*) OVER (PARTITION BY t) AS size FROM body JOIN (SELECT t, word FROM ranked WHERE r <= least({RARE}, ceil(n / 2))) USING (t, word)
), vote AS (
  SELECT doc_id, t, i - o AS start, count(*) / any_value(size) AS share
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d) JOIN posting USING (word) GROUP BY doc_id, t, i - o HAVING 2 * count(*) >= any_value(size)
), shifted AS (
  SELECT v.doc_id, v.t, v.start, v.share, k.place, k.want, v.start + k.place + unnest(range(-k.slack, k.slack + 1)) AS p FROM vote v JOIN key k USING (t)
), met AS (
  SELECT s.doc_id, t, start, share, count(DISTINCT place) AS n FROM shifted s JOIN d USING (doc_id) WHERE p >= 0 AND w[p + 1:p + len(want)] = want GROUP BY ALL
), match AS (
  SELECT m.*, label FROM met m JOIN template USING (t) WHERE n = (SELECT count(*) FROM key k WHERE k.t = m.t)
), agg AS (
  SELECT doc_id, count(*) FILTER (t < {len(BASE)}) AS n_base, min(start) FILTER (t < {len(BASE)}) AS first_word, max(start) FILTER (t < {len(BASE)}) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (t < {len(BASE)}) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM match GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN agg USING (doc_id)
"""

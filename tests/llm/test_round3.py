"""Source divergence, license scan and fill-in-middle against brute force, with the edge cases that their docstrings define."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import fill_in_middle as fim
from millrace.llm import license_scan as lic
from millrace.llm import source_divergence as div

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _divergence(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, _ in rows]
    df, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        groups[lang].add(source)
        df.update((lang, w) for w in set(words))
        counts[lang, source].update(words)
    out = set()
    for lang, sources in groups.items():
        kept = [t for (g, t), n in df.items() if g == lang and n >= min_docs]
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(counts[lang, s]) for s in sources}, share(total)
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s)
            terms = sorted((q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, part, item, -v, r + 1) for part, found in (("pair", pairs), ("term", terms)) for r, (v, item) in enumerate(found)}
    return out


def test_divergence_equals_brute_force(spark, monkeypatch):
    draw = random.Random(5)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(80)] + ["É", "the", "THE", "x1y"]
    rows = [(i, None if i % 17 == 0 else " ".join(draw.choices(words, k=draw.choice([0, 3, 60]))), draw.choice(["en", "fr", None]), draw.choice(["s1"] * 5 + ["s2", "s3", None]), 1) for i in range(120)]
    rows += rows[:7] + [(900, "alone alone", "xx", "s1", 1), (901, "", "xx", "s2", 1), (902, "only", "yy", "s1", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    want = _divergence(rows, 12, 5)
    monkeypatch.setattr(div, "LEAST_TERMS", 3)  # several units of a language
    assert {tuple(r) for r in div.source_divergence(docs, min_docs=12, top_terms=5).collect()} == want
    assert any(r[2] == "pair" and r[0] == "xx" and r[4] == 0 for r in want)  # a language without terms still has its pairs
    renamed = docs.toDF("id", "term", "kind", "unit", "stripe")
    assert {tuple(r) for r in div.source_divergence(renamed, "term", "kind", "unit", 12, 5).collect()} == want


def test_blocks_of_a_unit(monkeypatch):
    draw = np.random.RandomState(2)
    stripes = [[{"source": f"s{s}", "n": int(draw.randint(1, 50))} for s in sorted(draw.choice(7, draw.randint(1, 8), replace=False))] for _ in range(30)]
    totals = [sum(e["n"] for x in stripes for e in x if e["source"] == f"s{s}") for s in range(7)]
    heads = div.pa.RecordBatch.from_pydict({"item": [f"s{s}" for s in range(7)], "n": totals, "terms": [30] * 7})
    terms = div.pa.RecordBatch.from_pydict({"item": [f"t{i}" for i in range(30)], "stripe": stripes})
    rows = lambda: sorted(tuple(r.values()) for b in div._Unit("en", [heads], [terms]).rows() for r in b.to_pylist())
    whole = rows()
    monkeypatch.setattr(div, "CELLS", 14)  # two sources and two terms at once
    assert rows() == whole and sum(r[2] == "pair" for r in whole) == 21


def test_spilled_stripes_add_up(monkeypatch):
    rows = [("en", f"s{i % 3}", " ".join(f"{'abc'[j % 3]}{'def'[i % 3]}" for j in range(i))) for i in range(40)]
    batch = div.pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r, strict=True)) for r in rows])
    read = lambda: Counter()

    def added():
        out = read()
        for b in div._fold([batch]):
            for r in b.to_pylist():
                for e in r["stripe"]:
                    out[r["term"], e["source"]] += e["n"]
                    out[r["term"], None] += e["d"]
        return out

    whole = added()
    monkeypatch.setattr(div, "SPILL_ENTRIES", 5)
    assert added() == whole and whole["", "s0"] == 14 and whole["ad", None] == 13


def test_divergence_of_a_long_text_and_of_none(spark, monkeypatch):
    assert div.source_divergence(spark.createDataFrame([], DOCS)).count() == 0
    monkeypatch.setattr(div, "BLOCK_BYTES", 64)
    held = list(div._fold([spark.createDataFrame([("en", "s", "ab cde " * 5000 + "x" * 200)], "lang string, source string, text string").toArrow().to_batches()[0]]))
    stripes = {r["term"]: {e["source"]: (e["n"], e["d"]) for e in r["stripe"]} for b in held for r in b.to_pylist()}
    assert stripes == {"": {"s": (1, 1)}, "ab": {"s": (5000, 1)}, "cde": {"s": (5000, 1)}, "x" * 200: {"s": (1, 1)}}


@pytest.mark.parametrize("total", [1, 7, 10**6 + 3, 9 * 10**15])
def test_shares_are_exact(total):
    counts = np.array([0, 1, total // 3, max(0, total - 5)], np.int64)
    assert div._shares(counts, np.array([total + 5], np.int64)).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 5) for c in counts]


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_licenses_equal_brute_force(spark):
    draw = random.Random(3)
    parts = [t.text for t in lic.BASE + lic.PASSAGES] + ["cc", "by", "rights", "public license", "Émile", "x9", "the mit", "-"]
    rows = [(i, None if i == 0 else draw.choice([" ", ", ", "\n"]).join(draw.choices(parts, k=draw.choice([0, 1, 4, 12])))) for i in range(150)]
    rows += [(200, "All Rights Reserved. all rights RESERVED"), (200, "CC-BY cc by, cc"), (201, "permission is hereby granted free of charge to any person who wants to deal in the software without restriction")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = lic.scan_licenses(docs.withColumn("matches", docs.doc_id)).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"doc_id", "text", "n_words", "matches"}
    templates = lic.BASE + lic.PASSAGES
    for r in out:
        words = _words(r.text)
        assert r.n_words == len(words)
        want = {(t, i) for t, x in enumerate(lic.BASE) for i in range(len(words)) if words[i : i + len(x.words)] == x.text.split()}
        assert {(m.template, m.start) for m in r.matches if m.template < len(lic.BASE)} == want
        assert len(r.matches) == len({(m.template, m.start, m.share) for m in r.matches})
        for t, x in enumerate(templates):  # a whole passage is always found, at its place and with every indexed word
            text = x.text.split()
            for i in range(len(words)):
                if words[i : i + len(text)] == text:
                    assert (t, i, i + len(text), 1.0) in {(m.template, m.start, m.end, m.share) for m in r.matches}
        for m in r.matches:  # whatever is found holds the first word of each key phrase
            assert all(k.split()[0] in words for k in templates[m.template].keys)
    assert lic.scan_licenses(docs.limit(0)).count() == 0


def test_licenses_near_passages_and_long_texts(monkeypatch):
    index = lic.TemplateIndex(lic.BASE + lic.PASSAGES, {})
    labels = lambda text: {(lic.BASE + lic.PASSAGES)[t].label for t, _, _ in index.scan(memoryview(text.encode()))[1]}
    bsd = next(t.text for t in lic.PASSAGES if t.label == "bsd")
    assert "bsd" in labels(bsd.replace("with or without", "with or even without"))  # an insertion
    assert "bsd" not in labels(bsd.replace("source and binary", "other"))  # a mandatory phrase is missing
    assert "bsd" not in labels(" ".join(sorted(bsd.split())))  # the same words out of place
    text = ("filler words " * 40 + "all rights reserved " + bsd + " ") * 30 + "w" * 500
    whole = index.scan(memoryview(text.encode()))
    monkeypatch.setattr(lic, "BLOCK_BYTES", 50)
    assert index.scan(memoryview(text.encode())) == whole and len(whole[1]) == 60 and whole[0] == len(text.split())


def _fim(doc_id, text):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, digest = len(tokens), hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    return (n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}") if h[3] % 100 < 80 else (n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


def test_cuts_of_long_texts(monkeypatch):
    draw = random.Random(9)
    for ends in fim.UNITS.values():
        for _ in range(40):
            text = "".join(draw.choices(["a", " ", "\n", "é", "漢", "7"], k=draw.choice([1, 30, 300])))
            data, draws = np.frombuffer(text.encode(), np.uint8), np.array([[draw.randrange(1 << 32), draw.randrange(1 << 32)]])
            whole = [x.tolist() for x in fim._cuts(data, np.array([0, len(data)]), draws, ends)]
            with monkeypatch.context() as m:
                m.setattr(fim, "BLOCK_BYTES", 16)
                assert [x.tolist() for x in fim._long_cuts(data, draws, ends)] == whole


def test_fill_in_middle_equals_brute_force(spark):
    draw = random.Random(8)
    alphabet = ["a", "Z", "7", " ", "\n", "\t", "\x0b", "\r", "é", "漢", "😀", " ", "\x1c", "<", "S", ">", "<M", "-"]
    texts = ["".join(draw.choices(alphabet, k=draw.choice([0, 1, 5, 40, 400]))) for _ in range(300)] + ["<P>", " <S> x", " ", "\n\n", "word", " word ", "< S><", "x<P", "S><M"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[50]), (None, "a b c"), (7777, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(docs.withColumn("form", docs.text)).withColumn("back", fim.restored(fim.F.col("output"), fim.F.col("form"))).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _fim("" if r.doc_id is None else r.doc_id, r.text or "")
        assert r.back == (r.text or "")
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_cuts_at_lines(spark):
    row = spark.createDataFrame([(1, "one\ntwo\r\n\nthree")], "doc_id long, text string").select(fim.located(fim.F.col("text"), fim.F.lit(1), fim.F.lit(6), "line").alias("c")).first().c
    assert tuple(row) == (3, 4, 10)  # 6 % 4 = 2 lines: "one\n" and "two\r\n\n"


def test_wavelet_ranks():
    classes = np.random.RandomState(1).randint(0, 8, 1000).astype(np.uint8)
    matrix = fim.WaveletMatrix(classes)
    at = np.arange(1001)
    for kind in range(8):
        assert matrix.rank(kind, at).tolist() == np.concatenate([[0], np.cumsum(classes == kind)]).tolist()


def test_quality_sample_is_whole_rows(spark, monkeypatch):
    from millrace.llm import quality_mil as q

    seen = []
    monkeypatch.setattr(q.AttentionModel, "fit", lambda self, x, start, label: seen.append((len(x), len(start), sorted(label))) or self)
    texts = [(i, " ".join(["good words of prose"] * (16 * (1 + i % 3)))) for i in range(40)] + [(100, "w " * 64 * 60)]
    labels = [(i, i % 2) for i in range(40)] + [(0, 1), (1, 0), (100, 1), (None, 1), (3, None)]
    docs, given = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    q.fit_quality(docs, given)
    q.fit_quality(docs, given.orderBy("quality"))
    assert seen[0] == seen[1]  # whatever the order of an id's labels
    kept = [i for i in [*range(40), 100] if __import__("zlib").crc32(str(i).encode()) % 5]
    assert seen[0][1] == len(kept) and seen[0][0] == sum(60 if i == 100 else 1 + i % 3 for i in kept)  # every passage
    q.fit_quality(docs, given, sample_passages=20)
    assert seen[2][0] <= 20 and seen[2][1] > 3


def test_vectors_whose_squares_overflow_link(spark):
    from millrace.llm.embedding_pq import near_vectors

    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1.01e200], 1), (3, [1e-200, 1e-200], 1), (4, [1e200, -1e200], 1), (5, [5e-324, 5e-324], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


def test_a_repeated_pair_of_words_is_one_entry_of_a_line(spark, monkeypatch):
    from millrace.llm import line_dedup

    seen, linked = [], line_dedup.linked
    monkeypatch.setattr(line_dedup, "linked", lambda rows, *rest: seen.append([tuple(r) for r in rows.select("key", "id").collect()]) or linked(rows, *rest))
    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]
    rows = [(i, f"first{name(i)} second{name(i)} " + "is onhe " * 60) for i in range(90)] + [(100 + i, f"so third{i} " + "go far " * 9) for i in range(5)]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.n_removed for r in got) == 93
    assert len(seen[0]) == len(set(seen[0])) >= 90


def test_long_lines_without_common_words_are_no_candidates():
    import numpy as np
    import pyarrow as pa
    from millrace.llm import line_dedup

    r = np.random.RandomState(5)
    count = np.array([4, 30, 150, 150, 153, 148, 240, 253, 700, 720, 9000, 9000])
    words, first = r.randint(0, 1 << 62, count.sum()).astype(np.uint64), np.cumsum(count) - count
    near = words[first[2] : first[2] + 150].copy()
    near[::5] = 7  # 30 of 150 words: just within the rule
    words, first, count = np.concatenate([words, near]), np.append(first, len(words)), np.append(count, 150)
    features = line_dedup.parities(words, first, count)
    rows = pa.table({"n": pa.array(count, pa.int32()), "sig": pa.array(features, pa.binary())})
    match = line_dedup.WordCounts()
    ia, ib = match.tree(match.prepare(rows), np.arange(len(count)), None)
    assert list(zip(ia.tolist(), ib.tolist(), strict=True)) == [(2, 12)]


def test_a_pair_of_the_last_round_comes_from_one_unit(spark, monkeypatch):
    from millrace.llm import line_dedup, linking

    found, candidates = [], linking.candidates

    def seen(*args, whole=False):
        out = candidates(*args, whole=whole)
        found.extend((x.a, x.b) for x in out.collect() if whole)
        return out

    monkeypatch.setattr(linking, "candidates", seen)
    monkeypatch.setattr(linking, "NAMED", 64)  # all units of these rows
    # two groups of near lines that share words and pairs, and are more than a fifth apart: a dense unit on each of many pairs
    name = lambda i: "abcdefghij"[i // 10] + "abcdefghij"[i % 10]
    base = [f"w{name(i)}" for i in range(60)]
    other = [f"v{name(i)}" if i % 20 in (3, 4, 5, 6) or i == 59 else w for i, w in enumerate(base)]
    rows = [(40 * g + i, " ".join(f"x{name(i)}" if k == 30 + i % 9 else w for k, w in enumerate(line))) for g, line in enumerate((base, other)) for i in range(40)]
    for blocks in (2048, 16):
        found.clear()
        monkeypatch.setattr(linking, "BLOCK_ROWS", blocks)
        got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id for r in got if not r.n_removed} == {0, 40}
        assert len(found) == len(set(found)) > 0

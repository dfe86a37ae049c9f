"""Small cases of the training-data operators, against brute force or planted truth."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontamination, embedding_pq, line_dedup, linking, ngram_jaccard, packing, quality_mil, shared, suffix_dedup, url_rules, warc
from millrace.llm.secret_forest import findings, scan_secrets, weak_labels
from millrace.llm.shared import shared_folder

SCHEMA = "doc_id long, text string, lang string"


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base, other = prose(300, 1), prose(200, 2)
    words = base.split()
    near = " ".join(["changed" if i in (40,) else w for i, w in enumerate(words)])
    rows = [(1, base, "en"), (2, near, "en"), (3, base, None), (4, other, "en"), (5, None, "en"), (6, "", "en"), (7, "two words", "en"), (None, prose(50, 3), "en"), (4, other, "en"), (8, prose(100, 5) + "\n" + base[:900], "en")]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_repeats_equal_brute_force(spark, docs):
    df, rows = docs
    seen = {}
    texts = [(t or "").encode() for _, t, _ in rows]
    for b in texts:
        for i in range(len(b) - 399):
            seen[b[i : i + 400]] = seen.get(b[i : i + 400], 0) + 1
    want, spans = [], []
    for (d, _, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans.append((d, sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))))
        want.append((d, len(b), sum(gone), hashlib.sha256(kept).hexdigest(), kept))
    found = suffix_dedup.remove_repeats(df).collect()
    assert sorted(((r.doc_id, r.n_spans) for r in found), key=str) == sorted(spans, key=str)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256, bytes(r.kept)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_suffix_order_is_sorted():
    r = random.Random(4)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 300))) for _ in range(60)] + [b"a" * 290, b"a" * 290, b"a" * 200]
    rank, _ = suffix_dedup.suffix_order(strings, np.zeros(len(strings), np.int64), 400)
    assert [strings[i] for i in np.argsort(rank)] == sorted(strings)


def test_jaccard_groups(spark, docs):
    df, _ = docs
    got = {(r.doc_id, r.text): (r.n_shingles, r.group_key) for r in ngram_jaccard.jaccard_classes(df, id_col="doc_id").collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[1][1] == by_id[2][1] == by_id[3][1] != by_id[4][1]
    assert by_id[5] == by_id[6] == (0, None) and by_id[7][0] == 1
    kept = [r.doc_id for r in ngram_jaccard.keep_one(df).collect()]
    assert 1 in kept and 2 not in kept and 3 not in kept and 5 in kept and kept.count(4) == 1
    assert ngram_jaccard.jaccard_classes(df.limit(0)).count() == 0


def test_packing_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    df, rows = docs
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = packing.pack(df, path, capacity=64).collect()
    whole = Tokenizer.from_file(path)
    want = sorted((str(d), whole.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _ in rows)
    pieces = {}
    for r in sorted(out, key=lambda r: (str(r.doc_id), r.start)):
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pieces.setdefault(str(r.doc_id), []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert sum(len(v) for v in pieces.values()) == sum(len(v) for _, v in want)
    assert pieces["1"] == dict(want)["1"]
    for s in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64


def test_added_tokens_have_their_own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, ids = Tokenizer.from_file(path), packing._Ids(path)
    for text in ("a<|endoftext|>b", "one <|endoftext|> two", "<|endoftext|>", " a  <|endoftext|>\n b", "a <|endof text|> b", "plain words"):
        assert np.frombuffer(ids.of_text(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids.of_text("a<|endoftext|>b"), "<u4").tolist() == [64, 50256, 65]


def test_configurations_place_everything():
    histogram = {5: 7, 33: 2, 60: 9, 64: 3, 1: 1}
    placed = {}
    for config, n in packing.configurations(histogram, 64):
        assert sum(k * v for k, v in config.items()) <= 64
        for k, v in config.items():
            placed[k] = placed.get(k, 0) + n * v
    assert placed == histogram


def test_rules_and_globs(spark):
    df = spark.createDataFrame([(1, "http://a.NET/es/x?q"), (2, None), (3, "no scheme"), (4, "https://www.example.com/en/p"), (5, "https://x.example.com/en/"), (6, "http://b.com"), (7, "http://a.org/x.net/es/")], "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(df, url_rules.RULES).collect()}
    assert got == {1: ("net/es/", "block"), 2: (None, "allow"), 3: (None, "allow"), 4: ("www.example.com/en/", "allow"), 5: ("example.com/en/", "block"), 6: (None, "allow"), 7: (None, "allow")}
    assert url_rules.ShiftAnd(["a*c.org/p?q/", "org/"]).matches(["x.abbc.org", "ac.org"], ["/pzq/1", "/pq/"]).tolist() == [[True, True], [False, True]]


def test_archives_round_trip(spark):
    rows = [(1, "http://a/", "x\r\n\r\nWARC/1.1"), (2, "http://b/", "x\r\n\r\nWARC/1.1"), (3, None, None), (4, "http://d/", ""), (4, "http://d/", ""), (5, "http://e/\n", "ö" * 5000)]
    folder = shared_folder(spark, "test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = sorted((r.id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, folder, payloads=True).collect())
    assert got == [(1, "response", None, 13), (2, "revisit", 1, 13), (3, "response", None, 0), (4, "revisit", 3, 0), (4, "revisit", 3, 0), (5, "response", None, 10000)]


def test_near_vectors(spark):
    r = np.random.RandomState(0)
    x = r.normal(size=(200, 16))
    x[100:120] = x[:20] + r.normal(size=(20, 16)) * 0.03
    label = [i % 3 if i < 100 else (i - 100) % 3 for i in range(200)]
    rows = [(i, [float(np.float32(v)) for v in x[i]], label[i]) for i in range(200)] + [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [1.0] * 16, None), (204, [float(np.float32(v)) for v in x[0]], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_pq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = np.array([v for _, v, _ in rows[:200]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    for i in range(1, 200):
        if not near[i, 0]:
            assert got[i][0] == near[i].sum() - 1
    assert got[204][1] == 0 and got[0][0] == near[0].sum() and all(got[i] == (0, i, True) for i in (200, 201, 202, 203))


def test_contamination(spark, docs):
    df, rows = docs
    items = spark.createDataFrame([(11, " ".join(rows[0][1].split()[20:40]).upper()), (12, "two words"), (13, None), (14, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contamination(df, items).collect()}
    assert got[1].n_hit == 20 and got[1].hit_items == ["11"] and got[7].n_hit == 2 and not got[4].contaminated and got[5].n_words == 0
    assert {r.doc_id for r in decontamination.drop_contaminated(df, items).collect()} >= {4, 5, 6}


def test_contamination_by_shuffle(spark, docs, monkeypatch):
    df, rows = docs
    items = spark.createDataFrame([(11, " ".join(rows[0][1].split()[20:40]).upper()), (12, "two words"), (13, None), (14, " ".join(rows[3][1].split()[:30]))], "item_id long, text string")
    both = []
    for limit in (decontamination.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
        both.append(sorted(((r.doc_id, r.n_hit, r.hit_items, r.spots) for r in decontamination.contamination(df, items).collect()), key=str))
    assert both[0] == both[1] and any(x[1] > 20 for x in both[0])


def test_passages_do_not_depend_on_parts(monkeypatch):
    text = np.frombuffer((prose(6000, 9) + " " + "x" * 70_000 + " " + prose(3000, 10)).encode(), np.uint8)
    whole = quality_mil._passages(text, np.array([0, len(text)]))[0]
    monkeypatch.setattr(quality_mil, "BLOCK_BYTES", 20_000)
    assert np.array_equal(quality_mil.all_passages(text, np.array([0, len(text)]))[0], whole)


def test_vectors_of_other_types(spark):
    rows = [(i, [1.0, float(i // 2), 0.5], "xy"[i % 5 == 0]) for i in range(12)] + [(12, None, None), (13, [], "x")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_pq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got[2] == got[3] or got[2][1] == got[3][1] == 2
    assert got[12] == (0, 12) and got[13] == (0, 13)
    assert embedding_pq.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label string")).count() == 0


def test_lines(spark):
    line = prose(40, 7)
    rows = [(1, f"{line}\nfirst own line"), (2, f"other text here\n{line.upper()}\n\n"), (3, None), (4, "")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (f"{line}\nfirst own line", 0), 2: ("other text here\n\n", 1), 3: (None, 0), 4: ("", 0)}
    a, b = np.array([1, 2, 3, 4, 5]), np.array([1, 9, 3, 4, 5])
    assert line_dedup.edit_within(a, b, 1) and not line_dedup.edit_within(a, b[::-1].copy(), 1)


def test_line_distances_equal_brute_force():
    r = np.random.RandomState(8)

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, w in enumerate(x):
            now = [i + 1]
            for j, v in enumerate(y):
                now.append(min(row[j + 1] + 1, now[j] + 1, row[j] + (w != v)))
            row = now
        return row[-1]

    for _ in range(400):
        x = r.randint(0, 6, r.randint(0, 14))
        y = r.randint(0, 6, r.randint(0, 14)) if r.rand() < 0.3 else np.delete(np.where(r.rand(len(x)) < 0.2, r.randint(0, 6, len(x)), x), r.randint(0, max(len(x), 1), r.randint(0, 2) if len(x) else 0))
        for most in (0, 1, 2, 5):
            assert line_dedup.edit_within(x, y, most) == (distance(x.tolist(), y.tolist()) <= most)


def edit_distance(x, y):
    row = list(range(len(y) + 1))
    for i, w in enumerate(x):
        now = [i + 1]
        for j, v in enumerate(y):
            now.append(min(row[j + 1] + 1, now[j] + 1, row[j] + (w != v)))
        row = now
    return row[-1]


def roots_of(n, linked):
    """The least number reachable from each of n by links."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [find(i) for i in range(n)]


def test_near_lines_are_cut(spark):
    r = random.Random(12)
    base = [prose(30, 100 + i).split() for i in range(40)]
    rows = []
    for d in range(30):
        lines = [list(x) for x in r.sample(base, 8)]
        for x in lines:
            if r.random() < 0.5:
                x[r.randrange(len(x))] = "other"
        rows.append((d, "\n".join(" ".join(x) for x in lines)))
    rows += [(30, None), (31, ""), (None, rows[0][1]), (5, rows[5][1])]
    # columns whose names an implementation might use itself
    docs = spark.createDataFrame([(d, t, 1, 2, 3, 4, 5) for d, t in rows], "doc_id long, text string, _row int, _gone int, n_removed int, doc int, _all int").repartition(3)
    got = line_dedup.drop_repeated_lines(docs).collect()
    nodes = sorted({(d is None, d or 0, i, tuple(line.translate(str.maketrans("0123456789", "0000000000")).split())) for d, t in rows for i, line in enumerate((t or "").split("\n")) if line})
    at = roots_of(len(nodes), lambda i, j: edit_distance(nodes[i][3], nodes[j][3]) <= max(len(nodes[i][3]), len(nodes[j][3])) // 5)
    stay = {nodes[i][:3] for i in range(len(nodes)) if at[i] == i}
    want = sorted(((d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if not x or (d is None, d or 0, i) in stay)) for d, t in rows), key=str)
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == want
    assert {(x._row, x._gone, x.doc, x._all) for x in got} == {(1, 2, 4, 5)}
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_jaccard_equals_brute_force(spark, monkeypatch):
    """All pairs, with sizes of blocks, leaves and runs so small that trees, several blocks, hot keys and dense units occur."""
    r = random.Random(77)
    texts = [None, "", " \t", "one", "One", "one two"]
    for g in range(12):
        base = prose(r.choice([4, 12, 40, 160]), 500 + g).split()
        for _ in range(r.choice([1, 3, 9, 60])):
            x = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                x[r.randrange(len(x))] = r.choice("abc")
            texts.append(" ".join(x))
    texts += [prose(20, 500) + " " + prose(60, 3000 + i) for i in range(60)]  # a passage that unrelated texts share
    rows = list(enumerate(texts)) + [(3, "one"), (None, texts[9])]
    ids = range(len(rows))
    for k, share, block, frequent in ((3, "0.9", 2048, 64), (5, "0.8", 24, 3)):
        sets = []
        for _, t in rows:
            w = [x for x in (t or "").lower().split()]
            sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
        up = int(share[2:])
        want = roots_of(len(rows), lambda i, j: bool(sets[i]) and bool(sets[j]) and 10 * len(sets[i] & sets[j]) >= up * len(sets[i] | sets[j]))
        monkeypatch.setattr(linking, "BLOCK_ROWS", block)
        monkeypatch.setattr(linking, "FREQUENT", frequent)
        docs = spark.createDataFrame([(i, *x) for i, x in zip(ids, rows, strict=True)], "n int, doc_id long, text string").repartition(3)
        got = {x.n: (x.n_shingles, x.group_key) for x in ngram_jaccard.jaccard_classes(docs, k=k, threshold=share, id_col="doc_id").collect()}
        assert [got[i][0] for i in ids] == [len(x) for x in sets]
        groups = {}
        for i in ids:
            groups.setdefault(("empty", i) if got[i][1] is None else got[i][1], []).append(i)
        assert sorted(groups.values()) == sorted([j for j in ids if want[j] == i] for i in ids if want[i] == i)


def test_trees_prune_by_overlap():
    """Sets of one size, so that only the bitmaps can tell them apart: nearly all leaves go, and no true pair."""
    r = np.random.RandomState(3)
    sets = [r.randint(0, 1 << 49, 240) for _ in range(64)]
    near = []
    for s in sets:
        for _ in range(16):
            x = s.copy()
            x[r.randint(0, 240, 4)] = r.randint(0, 1 << 49, 4)
            near.append(np.unique(x.astype(np.uint64)))
    count = np.array([len(x) for x in near])
    rows = pa.table({"n": pa.array(count, pa.int64()), "sig": pa.array(ngram_jaccard.bitmaps(np.concatenate(near), count), pa.binary())})
    held = ngram_jaccard._Sets(rows)
    side = ngram_jaccard._Side(held, np.arange(len(near)), int(held.words.min()))
    i, j = ngram_jaccard.node_pairs(side, side, 9, 10)
    leaves = len(side.levels[0]["lo"])
    assert len(i) < 0.3 * leaves * (leaves + 1) / 2
    ia, ib = ngram_jaccard.signature_tree_pairs(held, np.arange(len(near)), None, Fraction(9, 10))
    found = {(min(x, y), max(x, y)) for x, y in zip(ia.tolist(), ib.tolist(), strict=True)}
    for g in range(64):
        for x in range(16 * g, 16 * g + 16):
            for y in range(x + 1, 16 * g + 16):
                both = len(np.intersect1d(near[x], near[y]))
                assert (x, y) in found or 10 * both < 9 * (count[x] + count[y] - both)


def test_lines_within_the_edit_rule_are_cut(spark, monkeypatch):
    r = random.Random(31)
    lines = []
    for g in range(60):
        n = r.choice([4, 5, 7, 10, 19, 20, 30, 40, 90])
        base = [r.choice("abcdefghijkl") if r.random() < 0.4 else prose(1, 10_000 + 100 * g + i) for i in range(n)]
        lines.append(base)
        for _ in range(2):
            x = list(base)
            for _ in range(r.randint(1, n // 5 + 1)):  # one edit more than the rule takes, at times
                kind, at = r.randrange(3), r.randrange(len(x))
                x[at : at + (kind < 2)] = ["other"] * (kind > 0)
            lines.append(x)
    rows = [(d, "\n".join(" ".join(x) for x in lines[d::9])) for d in range(9)]

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, w in enumerate(x):
            now = [i + 1]
            for j, v in enumerate(y):
                now.append(min(row[j + 1] + 1, now[j] + 1, row[j] + (w != v)))
            row = now
        return row[-1]

    nodes = [(d, i, line.split()) for d, t in rows for i, line in enumerate(t.split("\n"))]
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            longer = max(len(nodes[i][2]), len(nodes[j][2]))
            if abs(len(nodes[i][2]) - len(nodes[j][2])) <= longer // 5 and distance(nodes[i][2], nodes[j][2]) <= longer // 5:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    stay = {nodes[i][:2] for i in range(len(nodes)) if find(i) == i}
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) in stay) for d, t in rows}
    for frequent in (3,):
        monkeypatch.setattr(linking, "FREQUENT", frequent)
        got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert {x.doc_id: x.text for x in got} == want


def test_quality_held_out(spark):
    where = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")
    scored = quality_mil.score_quality(docs, quality_mil.fit_quality(docs, labels)).join(labels, "doc_id").where(quality_mil.held_out("doc_id"))
    right = scored.agg(F.avg((F.when(F.col("score") >= 0.3, 1).otherwise(0) == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9


def test_secrets(spark):
    rows = [(i, f'some plain words token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more') for i in range(40)] + [(100 + i, f"see https://example.com/docs/page{i}/of/the/manual or call 12345678901234{i:02d}") for i in range(40)] + [(900, None), (901, "")]
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.is_secret} == set(range(40))


def test_every_secret_of_a_word_is_found(spark):
    a, b = (hashlib.sha1(x).hexdigest() for x in (b"a", b"b"))
    aws = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    texts = [f"aws_secret_access_key={aws}", f"https://host/v2/long-path-name?token={a}", f'{{"api_key":"{a}","n":[1,2],"other_token":"{b}"}}', f"{a},{b},{a}", f"Authorization: Bearer {a}", f"please rotate {b} today", "nothing here", None]
    found = findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), []).persist()
    got = sorted((r.doc_id, r.position, r.value) for r in found.collect())
    assert got == sorted([(0, 0, aws), (1, 0, "//host/v2/long-path-name"), (1, 0, a), (2, 0, a), (2, 0, b), (3, 0, a), (3, 0, b), (3, 0, a), (4, 2, a), (5, 2, b)])
    labels = {(r.doc_id, r.value): r.label for r in weak_labels(found).collect()}
    assert labels[1, "//host/v2/long-path-name"] == 0 and labels[1, a] == labels[2, a] == labels[2, b] == labels[4, a] == 1
    assert (5, b) not in labels and (3, a) not in labels


def test_documents_of_other_scripts_stay(spark):
    line = "эта строка стоит в двух документах"
    rows = [(1, line), (2, f"{line}\nсвоя строка"), (3, f"{line}\n本文"), (4, f"{line}\n___ --"), (5, f"own words\n{line}"), (6, "___"), (7, None)]
    docs = spark.createDataFrame([(d, t, "ru", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {1: line, 2: "своя строка", 3: "本文", 5: "own words", 6: "___", 7: None}


def test_pipeline_keeps_what_brute_force_keeps(spark, tmp_path):
    """run() on a small table: no labels (all texts pass the classifier), repeated and near lines, near copies, benchmark passages, nulls, empty texts."""
    passage, line = prose(14, 71), prose(30, 72)
    near_line = " ".join(["other", *line.split()[1:]])
    base = prose(120, 73).split()
    copy = " ".join([*base[:60], "other", *base[61:]])
    texts = {1: " ".join(base), 2: copy, 3: f"{prose(40, 74)}\n{line}", 4: f"{near_line}\n{prose(40, 75)}", 5: near_line, 6: f"{prose(9, 76)} {passage.upper()} {prose(9, 77)}", 7: None, 8: "", 9: "two words", 10: prose(40, 78)}
    rows = [(d, t, "en", "s", len(t or "")) for d, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # 2 is a near line of 1, so nothing of it is left; of 4 the near line goes; 5 is that line alone; 6 holds the passage
    want = {1: texts[1], 3: texts[3], 4: texts[4].split("\n")[1], 7: None, 8: "", 9: texts[9], 10: texts[10]}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert {r.doc_id: r.n_chars for r in docs.collect()}[4] == len(want[4])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in packed) == sorted(want) and len({r.sequence_id for r in packed}) == 1


def test_salted_join_keeps_all_rows(spark):
    """Hot keys are spread, whatever their share; keys that other lacks, null keys and repeated rows stay as in a plain join."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 900).cast("long").alias("k"), "id")
    rows = rows.union(rows.where("id < 5"))
    other = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(spark.createDataFrame([(7, 70)], "k long, v long"))
    hot = shared.hot_keys(rows.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", rows.count())
    assert hot.where("k = 7").first()._parts > 300
    for how in ("inner", "left", "left_semi"):
        got = sorted(map(str, shared.salted_join(rows, other, ["k"], hot, how, "id").collect()))
        assert got == sorted(map(str, rows.join(other, "k", how).collect()))


def test_repeats_of_empty_and_clashing_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(empty).count() == 0
    same = "the same passage in every row, " * 20
    rows = [(i, same, i, i) for i in range(40)] + [(99, None, 1, 1), (100, "short", 1, 1)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_bytes long, copies long"), keep_text=False).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(i, len(same)) for i in range(40)] + [(99, 0), (100, 0)]

"""Empty tables, clashing names, long texts; findings with labels that were planted."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, embedding_pq, line_dedup, ngram_jaccard, packing, quality_mil, secret_forest, suffix_dedup, url_rules, warc
from millrace.llm.shared import shared_folder


def _path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_empty_tables_give_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    folder = shared_folder(spark, "none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    results = [
        quality_mil.score_quality(none, quality_mil.fit_quality(none, labels)),
        url_rules.judge(spark.createDataFrame([], "page_id long, url string"), url_rules.RULES),
        packing.pack(none, _path()),
        secret_forest.scan_secrets(none),
        warc.read_archives(spark, folder),
        embedding_pq.near_vectors(vectors),
        line_dedup.drop_repeated_lines(none),
        decontamination.contamination(none, none.withColumnRenamed("doc_id", "item_id")),
        ngram_jaccard.keep_one(none, k=5, threshold="0.8"),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_names_of_the_callers_columns_may_clash(spark):
    long = "a passage that stands in both rows, " * 30
    names = ["own_sha", "_part", "_key", "copies", "_all", "spans", "key", "text_of.x"]
    rows = [(i, long + str(i) * i, *([i] * len(names))) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names))
    got = suffix_dedup.remove_repeats(df, keep_text=False)
    assert got.columns == ["doc_id", "text", *names, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert all(r[n] == r.doc_id for r in got.collect() for n in names) and got.where("n_removed > 0").count() == 4
    packed = packing.pack(df.select(F.col("doc_id").alias("piece"), F.col("text").alias("length")), _path(), "piece", "length", keep_ids=False)
    assert sorted(r.piece_id for r in packed.where("piece = 0").collect()) == [0, 1, 2, 3]
    secret = spark.createDataFrame([(7, "token=a1B2c3D4e5F6g7H8i9J0"), (8, None)], "value long, piece string")
    assert [(r.value_id, r.value) for r in secret_forest.scan_secrets(secret, id_col="value", text_col="piece").collect()] == [(7, "a1B2c3D4e5F6g7H8i9J0")]


def test_ids_of_every_document_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    whole = Tokenizer.from_file(_path())
    want = {r.doc_id: whole.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    got: dict[int, list[int]] = {}
    for r in sorted(packing.pack(docs, _path(), capacity=512).collect(), key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(got.setdefault(r.doc_id, []))
        got[r.doc_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert got == want


def _planted(n, seed):
    """Texts with one value each and whether it is a secret. Kinds of secrets and of others share alphabets, lengths and assignment;
    neighbouring words tell them apart only in part, and one in 25 labels is against them."""
    r = random.Random(seed)
    draw = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    base62 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = "please see below for what the team has changed since then and note it".split()
    rows = []
    for i in range(n):
        secret = r.random() < 0.4
        if secret:
            value, near = r.choice([(draw(base62, r.randint(24, 44)), "rotate the new key"), (draw("0123456789abcdef", 40), "api token ="), (draw(base62, 32), "it is now"), (draw("0123456789abcdef", 32), "client secret:")])
        else:
            value, near = r.choice([(draw("0123456789abcdef", 40), "fixed in commit"), (draw("0123456789abcdef", 32), "md5 checksum ="), ("/usr/lib/" + draw("abcdefgh", 9) + "2/share", "installed to"), (draw("0123456789", 18), "order number:"), ("team-change-note-below-since-2024", "branch =")])
        label = int(secret) if r.random() > 0.04 else int(not secret)
        rows.append((i, f"{' '.join(r.choices(words, k=6))} {near} {value} {' '.join(r.choices(words, k=5))}", label))
    return rows


def test_reviewed_findings_of_other_rows(spark):
    df = spark.createDataFrame(_planted(1500, 4), "doc_id long, text string, label int")
    known, rest = df.where("doc_id % 3 > 0"), df.where("doc_id % 3 = 0")
    words = secret_forest.dictionary(df)
    labelled = secret_forest.findings(known, words).join(known.select("doc_id", "label"), "doc_id")
    out = secret_forest.scan_secrets(rest, labelled).join(rest.select("doc_id", "label"), "doc_id")
    told = out.agg(F.sum(F.expr("int(is_secret AND label = 1)")), F.sum(F.expr("int(is_secret)")), F.sum("label")).first()
    precision, recall = told[0] / told[1], told[0] / told[2]
    assert out.count() == 500 and precision >= 0.85 and recall >= 0.85, (precision, recall)


@pytest.mark.parametrize("file_bytes", [1, 1 << 26])
def test_pages_of_one_payload(spark, file_bytes):
    rows = [(i, f"http://h/{i}", "" if i % 10 else f"page {i}") for i in range(400)] + [(None, "http://none/", "")]
    folder = shared_folder(spark, "hot")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), folder, file_bytes=file_bytes)
    got = warc.read_archives(spark, folder).collect()
    empty = [r for r in got if r.payload_bytes == 0]
    assert len(got) == 401 and len(empty) == 361
    assert [r.id for r in empty if r.record_type == "response"] == [1] and {r.refers_to for r in empty if r.record_type == "revisit"} == {1}
    assert all(r.record_type == "response" for r in got if r.payload_bytes)

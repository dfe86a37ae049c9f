"""WARC archives with revisit resolution.

Headers alone are shuffled by payload digest to find each digest's response; the other records become revisits that refer to it.
Archives are written by Spark's text writer: its line separator is the blank line that ends a WARC record. They are read
back as whole files of bounded size and parsed by Content-Length, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shared import hot_keys, lean, row_key, saved, salted_join, shared_folder, table

END = "\r\n\r\n"
#: Bytes of the records that a reader hands on together.
BATCH_BYTES = 1 << 22
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 20 bits are five hexadecimal and four base-32 digits."""
    digest = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str | None = None, file_bytes: int = 1 << 26) -> None:
    """Writes a record for each row to gzip files in folder, of about file_bytes of payload each.

    date: of the headers, by default now. Of rows with equal payloads of min_bytes or more, that of the smallest id is a response (a null id comes last; among fully
    equal rows one is chosen), the others are revisits. A null payload is an empty one; a null URL leaves its header out, line ends
    in one are taken out. Ids are cast to long; one that isn't a whole number raises. Other columns are ignored. An empty table
    writes no record. Payloads are equal if SHA-1, SHA-256 and length are.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    keyed = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")).withColumn("_key", row_key("id", "url", "payload"))
    body, same = F.encode("payload", "UTF-8"), ["digest", "sha256", "bytes"]
    headers = saved(keyed.select("_key", "id", "url", base32_sha1(body).alias("digest"), F.unhex(F.sha2(body, 256)).alias("sha256"), F.octet_length("payload").cast("long").alias("bytes")))
    total = headers.agg(F.sum("bytes")).first()[0] or 0
    first = saved(headers.groupBy(*same).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_key", "url")).alias("of"), F.count("*").alias("n")))
    # a payload that very many pages share, such as an empty one, is spread over parts
    each = headers.groupBy("_key", *same).agg(F.lit(1).alias("_"))
    known = salted_join(each, first.select(*same, "of"), same, hot_keys(first, same, "n", headers.count()), "inner", "_key").select("_key", "digest", "bytes", F.col("of.id").alias("first_id"), F.col("of.url").alias("first_url"), F.col("of._key").alias("first_key"))
    files = max(4, -(-total // file_bytes))
    rows = keyed.repartition(files, "_key").join(known.repartition(files, "_key"), "_key")
    number = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    rows = rows.withColumn("number", number).withColumn("revisit", (F.col("bytes") >= min_bytes) & ~((F.col("_key") == F.col("first_key")) & (F.col("number") == 1)))
    clean = lambda c: F.regexp_replace(c, "[\\r\\n]", "")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(F.col("revisit"), F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.concat(F.lit("WARC-Record-ID: <urn:x-page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.hex("_key.a"), F.hex("_key.b"), F.lit("-"), F.col("number").cast("string"), F.lit(">\r\n")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", clean(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n")),
        F.when(
            F.col("revisit"),
            F.concat(
                F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"), F.coalesce(F.col("first_id").cast("string"), F.lit("")), F.lit(":"), F.hex("first_key.a"), F.hex("first_key.b"), F.lit("-1>\r\n"),
                _line("WARC-Refers-To-Target-URI", clean(F.col("first_url"))), F.lit(f"WARC-Refers-To-Date: {date}\r\n"),
            ),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))).cast("string"),
        F.lit(END),
    )
    record = F.concat(header, http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


def parse_records(archive):
    """(headers, block) of each record of an archive, a binary stream: one record at a time is held."""
    n = 0
    while line := archive.readline():
        n += 1
        if not line.startswith(b"WARC/"):
            raise ValueError(f"record {n} isn't a WARC record: {line[:80]!r}")
        headers = {}
        while (line := archive.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"record {n} ends in its headers")
            name, _, value = line.decode().removesuffix("\r\n").partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = archive.read(size)
        if len(block) != size or archive.read(len(END)) != END.encode():
            raise ValueError(f"record {n} doesn't end after {size} bytes")
        yield headers, block


def _page(uri: str | None) -> int | None:
    number = uri.removeprefix("<urn:x-page:").partition(":")[0] if uri else ""
    return int(number) if number else None


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload (null for revisits)."""
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def rows_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                out, held = [], 0
                for headers, block in parse_records(gzip.GzipFile(fileobj=io.BytesIO(raw.as_py()))):
                    http, _, payload = block.partition(END.encode())
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = headers["WARC-Type"] == "response"
                    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its header")
                    content = payload if payloads and response else None
                    out.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), size, digest, headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), content))
                    held += 200 + len(content or b"")
                    if held >= BATCH_BYTES:
                        yield rows_of(out)
                        out, held = [], 0
                if out:
                    yield rows_of(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    found = files.mapInArrow(lean(run), "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
    return found if payloads else found.drop("payload")


def op6_query(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, strlen(html) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS low FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_reduce(list_transform(range(0, 8), lambda i: list_reduce(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 5 * i::INT + 1, 5))::BIGINT >> (15 - 5 * j::INT)) & 31)::INT, 1)), lambda a, b: a || b)), lambda a, b: a || b) AS payload_digest,
  CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = low THEN NULL ELSE low END AS refers_to
FROM d
"""

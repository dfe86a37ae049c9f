"""Snapshots and releases on shared storage: bucketed trees, manifests, a pointer to the published version, and file exports.

A snapshot root holds data/_version=N/bucket=B/ (Parquet), manifests/N/ (a row for each bucket: which version holds it, and what it holds),
about/N (what the version is and was made from) and pointers/K (which version is published, and which pointer stood before). A pointer or
version is claimed by creating its file without overwriting, so of two writers one wins. Nothing is ever overwritten, so readers
of an older version go on undisturbed until retain() deletes it.
"""

from __future__ import annotations

import json
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


def shared_root(spark: SparkSession, name: str) -> str:
    """A new folder name below spark.checkpoint.dir; where that is unset a local session gets a temporary one, a cluster an error."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    run = spark.range(1).select(F.uuid()).first()[0]
    return f"{(place or tempfile.mkdtemp(prefix='spark-', dir='/tmp')).rstrip('/')}/{name}-{run}"


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a token: the first 32 bits of its SHA-256, modulo the number of buckets."""
    return (F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def last_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


class Conflict(RuntimeError):
    """Another writer was first."""


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, name: str, content: dict) -> None:
    """A small file with JSON; Conflict if it exists."""
    path, fs = _path(spark, name)
    try:
        out = fs.create(path, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            raise Conflict(name) from None
        raise
    out.write(bytearray(json.dumps(content).encode()))
    out.close()


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers that name a folder's files; a root has one for each version or publication."""
    path, fs = _path(spark, folder)
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()) if fs.exists(path) else []


def _load(spark: SparkSession, name: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(name).collect()))


MANIFEST = "bucket int, version int, rows long, tokens long, fingerprint string, digest string"


def _describe(rows: DataFrame, version: int, token: str) -> DataFrame:
    """A row for each bucket: rows, tokens, the schema's fingerprint and a digest of the content that no order of rows changes."""
    columns = sorted(c for c in rows.columns if c != "bucket")
    fingerprint = F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in rows.schema if f.name != "bucket"))
    content = F.concat_ws(":", *(F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (0, 1)))
    held = rows.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count("*").alias("rows"), F.count_distinct(token).alias("tokens"), F.sha2(content, 256).alias("digest"))
    return held.select("bucket", F.lit(version).alias("version"), "rows", "tokens", F.sha2(fingerprint, 256).alias("fingerprint"), "digest")


def _add_version(rows: DataFrame, root: str, token: str, ts: str, buckets: int, parent: int | None, kept: DataFrame | None) -> int:
    """Claims the next number and writes data, then manifest. Tokens are hashed, so a bucket's rows come from one shuffle that spreads
    each bucket over as many tasks as the shuffle has."""
    spark = rows.sparkSession
    if clash := {"bucket", "_version"} & set(rows.columns):
        raise ValueError(f"{sorted(clash)} name a snapshot's own columns: rename them first")
    version = max(_numbers(spark, f"{root}/about"), default=-1) + 1
    _create(spark, f"{root}/about/{version}", {"parent": parent, "schema": rows.schema.json(), "token": token, "ts": ts, "buckets": buckets})
    at = rows.withColumn("bucket", bucket_of(F.col(token), buckets))
    at.repartition("bucket", F.pmod(F.xxhash64(token), F.lit(16))).sortWithinPartitions("bucket", token, ts).write.partitionBy("bucket").parquet(f"{root}/data/_version={version}")
    changed = _describe(_read(spark, root, [(version, None)], rows.schema), version, token)
    whole = changed if kept is None else kept.unionByName(changed)
    whole.write.parquet(f"{root}/manifests/{version}")
    return version


def _read(spark: SparkSession, root: str, places: list[tuple[int, int | None]], schema: StructType) -> DataFrame:
    held = StructType([*schema, *StructType.fromDDL("bucket int, _version int")])
    if not places:
        return spark.createDataFrame([], held).drop("_version")
    paths = [f"{root}/data/_version={v}" + ("" if b is None else f"/bucket={b}") for v, b in places]
    return spark.read.schema(held).option("basePath", f"{root}/data").parquet(*paths).drop("_version")


def write_snapshot(df: DataFrame, root: str, token: str, ts: str, order: list[str], buckets: int = BUCKETS) -> int:
    """A first version of a snapshot: one row for each (token, time), the last by order, bucketed by token. Returns the version. An empty
    table is a version without rows; df must have no columns named bucket or _version."""
    return _add_version(last_of(df, [token, ts], order), root, token, ts, buckets, None, None)


def update_snapshot(spark: SparkSession, root: str, base: int, delta: DataFrame, token: str, ts: str, order: list[str]) -> int:
    """A version that rewrites only the buckets which delta's tokens fall in. Tokens of delta are replaced whole; other tokens keep their rows.
    Returns the version, a new one even if base is not the latest."""
    buckets = _load(spark, f"{root}/about/{base}")["buckets"]
    fresh = last_of(delta, [token, ts], order)
    dirty = fresh.select(bucket_of(F.col(token), buckets).alias("bucket")).distinct()
    kept = scan_snapshot(spark, root, base).join(F.broadcast(dirty), "bucket", "left_semi").join(fresh.select(token).distinct(), token, "left_anti").drop("bucket")
    untouched = _manifest(spark, root, base).join(F.broadcast(dirty), "bucket", "left_anti")
    return _add_version(kept.unionByName(fresh).select(fresh.columns), root, token, ts, buckets, base, untouched)


def _manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{version}")


def scan_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version (None: the published one), with bucket. The manifest holds a row for each bucket, so reading it is bounded."""
    version = published(spark, root) if version is None else version
    schema = StructType.fromJson(json.loads(_load(spark, f"{root}/about/{version}")["schema"]))
    return _read(spark, root, [(r.version, r.bucket) for r in _manifest(spark, root, version).select("version", "bucket").collect()], schema)


def validate_snapshot(spark: SparkSession, root: str, version: int, token: str) -> DataFrame:
    """(bucket, issue) of buckets whose rows, tokens, schema or content differ from the manifest's, or that hold tokens of another bucket."""
    about, rows = _load(spark, f"{root}/about/{version}"), scan_snapshot(spark, root, version)
    astray = rows.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count_if(bucket_of(F.col(token), about["buckets"]) != F.col("bucket")).alias("_astray"))
    found = _describe(rows, version, token).join(astray, "bucket").withColumnsRenamed({c: f"_{c}" for c in ("rows", "tokens", "fingerprint", "digest")}).drop("version")
    both = _manifest(spark, root, version).join(found, "bucket", "full")
    differs = lambda c: F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit({"rows": "counts", "tokens": "counts", "fingerprint": "schema", "digest": "content"}[c]))
    issues = F.array_distinct(F.array_compact(F.array(*(differs(c) for c in ("rows", "tokens", "fingerprint", "digest")), F.when(F.col("_astray") > 0, F.lit("bucket")))))
    return both.select("bucket", F.explode(issues).alias("issue"))


def publish_snapshot(spark: SparkSession, root: str, version: int, token: str, expected: int | None = None) -> int:
    """Points readers at a version, if it holds what its manifest says, and returns the pointer's number. expected: the pointer that the
    writer has seen last (None: the present one); Conflict if another one was set since."""
    if not validate_snapshot(spark, root, version, token).isEmpty():
        raise ValueError(f"version {version} differs from its manifest")
    last = _pointer(spark, root)[0] if expected is None else expected
    _create(spark, f"{root}/pointers/{last + 1}", {"version": version, "before": last if last >= 0 else None})
    return last + 1


def _pointer(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """The number and content of the last pointer; (-1, None) before the first."""
    last = max(_numbers(spark, f"{root}/pointers"), default=-1)
    return last, _load(spark, f"{root}/pointers/{last}") if last >= 0 else None


def published(spark: SparkSession, root: str) -> int:
    pointer = _pointer(spark, root)[1]
    if pointer is None:
        raise ValueError(f"nothing is published below {root}")
    return pointer["version"]


def rollback(spark: SparkSession, root: str, token: str) -> int:
    """Publishes the version that the present pointer replaced, and returns it; so a second rollback goes one further back."""
    last, pointer = _pointer(spark, root)
    if pointer is None or pointer["before"] is None:
        raise ValueError("no version was published before")
    before = _load(spark, f"{root}/pointers/{pointer['before']}")
    if not validate_snapshot(spark, root, before["version"], token).isEmpty():
        raise ValueError(f"version {before['version']} differs from its manifest")
    _create(spark, f"{root}/pointers/{last + 1}", before)
    return before["version"]


def retain(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Deletes what the kept versions do not refer to, and returns these: the published version, the one that a rollback would publish,
    and the newest others up to keep. A bucket stays as long as a kept version holds it, whatever version it was written for."""
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    versions, pointer = _numbers(spark, f"{root}/manifests"), _pointer(spark, root)[1]
    kept = set() if pointer is None else {pointer["version"]}
    if pointer and pointer["before"] is not None:
        kept.add(_load(spark, f"{root}/pointers/{pointer['before']}")["version"])
    for v in reversed(versions):
        if len(kept) < keep:
            kept.add(v)
    held = {(r.version, r.bucket) for v in kept for r in _manifest(spark, root, v).select("version", "bucket").collect()}
    for v in versions:
        path, fs = _path(spark, f"{root}/data/_version={v}")
        for f in fs.listStatus(path) if fs.exists(path) else []:
            name = f.getPath().getName()
            if name.startswith("bucket=") and (v, int(name[7:])) not in held:
                fs.delete(f.getPath(), True)
        if v not in kept:
            fs.delete(_path(spark, f"{root}/manifests/{v}")[0], True)
    return sorted(kept)


def read_csv_contract(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file with exactly these columns in this order under a header; empty fields are null, rows that do not fit raise."""
    return spark.read.csv(path, schema=schema, header=True, nullValue="", mode="FAILFAST", enforceSchema=False)


def load_seed(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A seed table: all columns are read as text, then cast; text that does not fit its type raises."""
    text = read_csv_contract(spark, path, ", ".join(f"{c} STRING" for c in types))
    return text.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def write_release(df: DataFrame, path: str, order: list[str]) -> None:
    """Ordered, compressed Parquet files: ranges of the order across files, sorted within each."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)


def export_marts(frames: dict[str, DataFrame], root: str) -> dict[str, int]:
    """A Parquet folder for each mart; returns the rows written of each, counted while writing."""
    from pyspark.sql import Observation

    counts = {}
    for name, df in frames.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def release_csv(df: DataFrame, path: str, issues: Column) -> None:
    """CSV of the rows; refuses if a row has issues."""
    bad = df.where(issues.isNotNull()).limit(1).collect()
    if bad:
        raise ValueError(f"forbidden text in {bad[0]}")
    df.write.csv(path, header=True)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").json(path)

"""Bundles of tables that stand or fall together: graph releases, and reference tables taken over as a whole.

A bundle is a folder of Parquet tables and, written last, a file `manifest` that says what each holds. Without it there is no bundle, so a
writer that dies leaves none; what is read is held against it before anyone uses it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.publication import graph_issues
from millrace.sources.snapshots import _create, _load, _numbers, write_release


def describe(df: DataFrame) -> dict:
    """rows, schema (names and types in order) and digest of a table's content, which no order of rows changes."""
    content = F.concat_ws(":", *(F.sum(F.xxhash64(F.lit(seed), *df.columns).cast("decimal(38,0)")) for seed in (0, 1)))
    row = df.agg(F.count("*").alias("rows"), F.sha2(F.coalesce(content, F.lit("")), 256).alias("digest")).first()
    return {"rows": row["rows"], "schema": [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema], "digest": row["digest"]}


def write_bundle(tables: dict[str, tuple[DataFrame, list[str]]], root: str) -> dict:
    """Writes tables (name: rows, order) to a new folder, reads them back, and returns the manifest; ValueError if what was read differs."""
    spark, manifest = next(iter(tables.values()))[0].sparkSession, {}
    for name, (df, order) in tables.items():
        manifest[name] = describe(df)
        write_release(df, f"{root}/{name}", order)
        if describe(spark.read.schema(df.schema).parquet(f"{root}/{name}")) != manifest[name]:
            raise ValueError(f"{name} reads back with other content: is its source deterministic?")
    _create(spark, f"{root}/manifest", manifest)
    return manifest


def release_graph(nodes: DataFrame, edges: DataFrame, root: str, expected: dict[str, int] | None = None) -> dict:
    """A graph release: nodes by node_id, edges by edge_id. ValueError, and nothing is written, if graph_issues() finds any."""
    issues = graph_issues(nodes, edges, expected).collect()
    if issues:
        raise ValueError(", ".join(sorted(f"{r.issue}: {r['rows']}" for r in issues)))
    return write_bundle({"nodes": (nodes, ["node_id"]), "edges": (edges, ["edge_id"])}, root)


def read_bundle(spark: SparkSession, root: str, contract: dict[str, tuple[str, list[str]]]) -> dict[str, DataFrame]:
    """The tables of a bundle, held against its manifest and a contract (name: schema as DDL, primary key). ValueError with every fault: tables missing or beyond the contract, another
    schema, other content than the manifest says, keys that are null or repeated."""
    manifest, faults, tables = _load(spark, f"{root}/manifest"), [], {}
    faults += [f"{n}: not in the bundle" for n in contract if n not in manifest] + [f"{n}: not in the contract" for n in manifest if n not in contract]
    for name, (ddl, keys) in contract.items():
        if name not in manifest:
            continue
        schema = StructType.fromDDL(ddl)
        if manifest[name]["schema"] != [f"{f.name}:{f.dataType.simpleString()}" for f in schema]:
            faults.append(f"{name}: schema")
            continue
        tables[name] = df = spark.read.schema(schema).parquet(f"{root}/{name}")
        if describe(df) != manifest[name]:
            faults.append(f"{name}: content")
        empty = F.lit(False)
        for k in keys:
            empty = empty | F.col(k).isNull()
        if not df.where(empty).isEmpty() or not df.groupBy(*keys).count().where("count > 1").isEmpty():
            faults.append(f"{name}: key")
    if faults:
        raise ValueError("; ".join(faults))
    return tables


def take_over(spark: SparkSession, bundle: str, root: str, contract: dict[str, tuple[str, list[str]]]) -> int | None:
    """Makes a sound bundle the current reference below root, all tables at once, and returns its number; None if the current one has the same content. Readers use current()."""
    tables = read_bundle(spark, bundle, contract)
    digest = hashlib.sha256(json.dumps(_load(spark, f"{bundle}/manifest"), sort_keys=True).encode()).hexdigest()
    done = _numbers(spark, f"{root}/taken")
    if done and _load(spark, f"{root}/taken/{done[-1]}")["digest"] == digest:
        return None
    number = done[-1] + 1 if done else 0
    place = f"{root}/tables/{number}-{digest[:16]}"
    write_bundle({n: (df, contract[n][1]) for n, df in tables.items()}, place)
    _create(spark, f"{root}/taken/{number}", {"digest": digest, "place": place})
    return number


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current reference."""
    done = _numbers(spark, f"{root}/taken")
    if not done:
        raise ValueError(f"no reference was taken over below {root}")
    return spark.read.parquet(f"{_load(spark, f'{root}/taken/{done[-1]}')['place']}/{name}")

"""Near-duplicate embeddings by product quantisation over coarse inverted lists.

Equal vectors of a label are one class. A bounded sample gives coarse centroids and, for residuals, a codebook for each
subspace. Every class is in the list of its nearest centroid with its code and the error of that code. A class probes
every list that can hold a vector within the threshold: if x and y are within r, and y is nearest to centroid c,
then |x-c|^2 - |x-c'|^2 <= 2 r |c-c'| for x's own centroid c'. Table look-ups give asymmetric distances; with the stored
errors they bound true distances, so no link is lost. What passes is compared by exact cosine in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import lean, saved, sorted_groups, table

#: Coarse centroids: the square root of the number of vectors, from, to. Lists then grow no faster than the square root, until the last.
CENTROIDS = (64, 1024)
SUBSPACES, CODES = 8, 256
#: Vectors that the quantiser is fitted on, at most.
SAMPLE = 12_000
#: Rows of a list's segment, and of a chunk of the vectors that probe it.
SEGMENT = 1024
SLACK = 1e-4


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.RandomState(seed)
    k = min(k, len(x))
    centers = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = ((centers**2).sum(1)[None, :] - 2 * x @ centers.T).argmin(1)
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        centers[count > 0] = total[count > 0] / count[count > 0, None]
    return centers


class Quantiser:
    """Coarse centroids and residual codebooks for unit vectors of one dimension."""

    def __init__(self, sample: np.ndarray, n_centers: int, seed: int = 11):
        x = unit_rows(sample)
        self.dim = x.shape[1]
        self.centers = _kmeans(x, n_centers, seed)
        norms = (self.centers**2).sum(1)
        self.gaps = np.sqrt(np.maximum(0, norms[:, None] + norms[None, :] - 2 * self.centers @ self.centers.T))
        self.parts = np.array_split(np.arange(self.dim), min(SUBSPACES, self.dim))
        residual = x - self.centers[self.nearest(x)[0]]
        self.books = [_kmeans(np.ascontiguousarray(residual[:, p]), CODES, seed + i + 1) for i, p in enumerate(self.parts)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.maximum(0, 1 + (self.centers**2).sum(1)[None, :] - 2 * x @ self.centers.T)
        return far.argmin(1), far

    def encode(self, x: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each vector to what its code stands for."""
        residual = x - self.centers[near]
        codes, error = np.empty((len(x), len(self.parts)), np.uint8), np.zeros(len(x))
        for i, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            far = (residual[:, p] ** 2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2 * residual[:, p] @ book.T
            codes[:, i] = far.argmin(1)
            error += np.maximum(0, far[np.arange(len(x)), codes[:, i]])
        return codes, np.sqrt(error)

    def table_distances(self, x: np.ndarray, center: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances of x to the vectors that codes stand for in a list."""
        residual, out = x - self.centers[center], np.zeros((len(x), len(codes)))
        for i, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            tables = (residual[:, p] ** 2).sum(1)[:, None] + (book**2).sum(1)[None, :] - 2 * residual[:, p] @ book.T
            out += tables[:, codes[:, i]]
        return np.maximum(out, 0)


def fit(classes: DataFrame) -> dict[int, Quantiser]:
    """A quantiser for each dimension found, from at most SAMPLE classes (those of the smallest hashes)."""
    rows = classes.select("vector").orderBy(F.xxhash64("vector", F.lit(3))).limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r[0]), []).append(r[0])
    n_centers = int(np.clip(math.sqrt(classes.count()), *CENTROIDS))
    return {d: Quantiser(np.array(v, float), n_centers) for d, v in by_dim.items()}


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are divided by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _unit(column: pa.Array) -> np.ndarray:
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    x = values.reshape(len(column), -1).astype(float)
    return unit_rows(x)


def _by_dim(batch: pa.RecordBatch, name: str):
    sizes = pa.compute.list_value_length(batch.column(name)).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d))


def _lists(classes: DataFrame, quantisers: dict[int, Quantiser], radius: float) -> DataFrame:
    """Each class in its own list (probe false), and in the later lists that it probes (probe true)."""

    def run(batches):
        for batch in batches:
            for d, part in _by_dim(batch, "vector"):
                q = quantisers.get(d)
                x = _unit(part.column("vector"))
                if q is None:  # a dimension that the sample lacks: one list, no codes
                    near, far = np.zeros(len(x), np.int64), np.zeros((len(x), 1))
                    codes, error = np.zeros((len(x), 1), np.uint8), np.full(len(x), 9.0)
                    reach = np.ones((len(x), 1), bool)
                else:
                    near, far = q.nearest(x)
                    codes, error = q.encode(x, near)
                    reach = far - far[np.arange(len(x)), near][:, None] <= 2 * radius * q.gaps[near] + SLACK
                reach &= np.arange(far.shape[1])[None, :] >= near[:, None]
                rows, lists = np.nonzero(reach)
                own = lists == near[rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(rows)), part.column("label").take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array(lists.astype(np.int32)), pa.array(~own), part.column("vector").take(pa.array(rows)), part.column("n").take(pa.array(rows)), pa.array([codes[i].tobytes() for i in rows], pa.binary()), pa.array(error[rows])],
                    ["id", "label", "dim", "list", "probe", "vector", "n", "code", "error"],
                )

    kind = dict(classes.dtypes)
    return classes.select("id", "label", "vector", "n").mapInArrow(lean(run), f"id long, label {kind['label']}, dim int, list int, probe boolean, vector {kind['vector']}, n long, code binary, error double")


def _compare(dealt: DataFrame, quantisers: dict[int, Quantiser], cosine: float) -> DataFrame:
    """(id, links, other): linked vectors counted for each class, and a spanning forest of each unit's links (links 0)."""
    keys, radius = ["label", "dim", "list", "segment", "chunk"], math.sqrt(2 - 2 * cosine)

    def pairs(unit: pa.Table):
        d, c = unit.column("dim")[0].as_py(), unit.column("list")[0].as_py()
        probe = unit.column("probe").to_numpy(zero_copy_only=False)
        x, ids, n = _unit(unit.column("vector").combine_chunks()), unit.column("id").to_numpy(), unit.column("n").to_numpy()
        base = np.flatnonzero(~probe & (unit.column("role").to_numpy(zero_copy_only=False) == "base"))
        ask = np.flatnonzero(unit.column("role").to_numpy(zero_copy_only=False) == "ask")
        if not len(base) or not len(ask):
            return
        codes = np.frombuffer(b"".join(unit.column("code").take(pa.array(base)).to_pylist()), np.uint8).reshape(len(base), -1)
        error = unit.column("error").to_numpy()[base]
        for a in range(0, len(ask), 256):
            rows = ask[a : a + 256]
            if d in quantisers:
                near = np.sqrt(quantisers[d].table_distances(x[rows], c, codes)) <= radius + error[None, :] + SLACK
            else:
                near = np.ones((len(rows), len(base)), bool)
            near &= probe[rows][:, None] | (ids[rows][:, None] < ids[base][None, :])  # within the list, each pair once
            i, j = np.nonzero(near)
            exact = np.concatenate([np.einsum("ij,ij->i", x[rows[i[k : k + 100_000]]], x[base[j[k : k + 100_000]]]) for k in range(0, len(i), 100_000)]) if len(i) else np.zeros(0)
            good = exact >= cosine
            yield ids[rows[i[good]]], ids[base[j[good]]], n[rows[i[good]]], n[base[j[good]]]

    def run(batches):
        for unit in sorted_groups(batches, keys):
            found = [np.concatenate(f) for f in zip(*pairs(unit), strict=True)]
            if not found or not len(found[0]):
                continue
            a, b, na, nb = found
            both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            links = np.bincount(at, weights=np.concatenate([nb, na])).astype(np.int64)
            label = np.arange(len(both))
            ea, eb = [], []
            for p, q in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
                while label[p] != p:
                    label[p] = label[label[p]]
                    p = label[p]
                while label[q] != q:
                    label[q] = label[label[q]]
                    q = label[q]
                if p != q:
                    label[max(p, q)] = min(p, q)
                    ea.append(both[p])
                    eb.append(both[q])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([both, ea]).astype(np.int64)), pa.array(np.concatenate([links, np.zeros(len(ea), np.int64)])), pa.array([None] * len(both) + [int(v) for v in eb], pa.int64())], ["id", "links", "other"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run), "id long, links long, other long")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """df's id_col with n_links (other rows linked directly), component_id (smallest id reachable) and kept (id = component_id).

    Rows link if their labels are equal and not null and the cosine in double precision is at least `cosine`. Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing, nor do vectors of different dimensions.
    Labels are of any type that can be compared, components of any numeric type. Only these three columns are read.
    Repeated rows are linked copies. A null id has a null or its group's smallest id. An empty table gives an empty table.
    """
    kind = dict(df.dtypes)[vector_col]
    v = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")
    sound = F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, lambda e: e + F.lit(0.0).cast("float" if kind == "array<float>" else "double")).alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.withColumn("id", F.when(F.col("sound"), F.xxhash64("label", "vector")))
    classes = saved(rows.where("sound").groupBy("id", "label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("low")))
    quantisers = fit(classes)
    listed = saved(_lists(classes, quantisers, math.sqrt(2 - 2 * cosine)))
    keys = ["label", "dim", "list"]
    sizes = listed.groupBy(*keys).agg(F.ceil(F.count_if(~F.col("probe")) / SEGMENT).cast("int").alias("segments"), F.ceil(F.count("*") / (4 * SEGMENT)).cast("int").alias("chunks")).where("segments > 0")
    placed = listed.join(sizes, keys)
    base = placed.where("NOT probe").withColumn("role", F.lit("base")).withColumn("segment", F.pmod(F.xxhash64("id"), F.col("segments")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    ask = placed.withColumn("role", F.lit("ask")).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(5)), F.col("chunks")).cast("int")).withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)))
    found = saved(_compare(base.unionByName(ask), quantisers, cosine))
    links = found.where("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    grouped = classes.select("id", "n", "low").join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    low = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    grouped = grouped.join(low, "root").select("id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "id").join(grouped, "id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).withColumnRenamed("vec_id", id_col)


def op7_query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

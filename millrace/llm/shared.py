"""Helpers that the operators of this subpackage share: tables, checkpoints, hashing of text blocks."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are held as numpy arrays at once.
BLOCK_BYTES = 1 << 20

_RNG = np.random.RandomState(20240229)
#: A random 64-bit number for each byte.
BYTE_CODES = (_RNG.randint(0, 1 << 32, 256).astype(np.uint64) << np.uint64(32)) | _RNG.randint(0, 1 << 32, 256).astype(np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows with texts or sets are kilobytes each: smaller Arrow batches bound what a Python worker holds.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder in spark.checkpoint.dir, which must be one that all executors share. Where none is set, a local session, as in
    tests, gets a new temporary folder; on a cluster it is an error. It also sets BATCHES in the session."""
    context = spark.sparkContext
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        place = spark.conf.get("spark.checkpoint.dir", None)
        if not place and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = place or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(place)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of data that a checkpoint has replaced: it does so once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def saved(df: DataFrame) -> DataFrame:
    """df, materialised once in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, after which its Python worker gives freed memory back: idle workers would hold on to the most that any task has used."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def stored(df: DataFrame) -> DataFrame:
    """df, written once as a compressed table in the shared checkpoint folder: a fraction of a checkpoint's size, for larger tables."""
    place = shared_folder(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, for files that executors write and read."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def row_key(*names: str) -> F.Column:
    """A 128-bit key of a row's content: never null, and the same for repeated rows."""
    return F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit(1), *names).alias("b"))


#: A key with over this part of all rows is hot; so fewer than HOT_PARTS keys are, whatever the table's size.
HOT_PARTS = 1024


def hot_keys(counts: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """The hot keys of counts (a row a key, n its rows out of total), and over how many parts each is to be spread."""
    return counts.where(F.col(n) * HOT_PARTS > total).select(*keys, F.ceil(F.col(n) * HOT_PARTS / F.lit(max(total, 1))).cast("int").alias("_parts"))


def salted_join(rows: DataFrame, other: DataFrame, keys: list[str], hot: DataFrame, how: str, *spread: str) -> DataFrame:
    """rows joined with other, which has each key once. Rows of a hot key are spread by the columns in spread over parts of at most
    about 1/HOT_PARTS of all rows, and other's row goes to each of them: fewer than twice HOT_PARTS rows more."""
    hot = F.broadcast(hot)
    many = rows.join(hot, keys, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread), "_parts"), F.lit(0)).cast("int")).drop("_parts")
    each = other.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return many.join(each, [*keys, "_part"], how).drop("_part")


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    if not _POWERS or len(_POWERS["up"]) < n:
        n2 = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(n2, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S such that (S[j] - S[i]) * BASE**-i is a hash of data[i:j]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(len(data))[0], out=out[1:])
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and each row's offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    first, last = (int(offs[0]), int(offs[-1])) if len(offs) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return raw, offs - first


def row_blocks(offs: np.ndarray, limit: int = BLOCK_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes and so many rows; a longer row stands alone."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = min(a + rows, max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1))
        yield a, min(b, n)
        a = min(b, n)


#: White space of ASCII.
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SPACES = np.zeros(256, bool)
SPACES[list(WHITE)] = True
#: A-Z to a-z and white space to a blank, for bytes.translate().
PLAIN = bytes(0x20 if c in WHITE else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
#: The low k bytes of a number, by k.
LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Bytes of a word from which on it is hashed by hashlib.
LONG_WORD = 1024


def word_spans(plain: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and length of the words of bytes in which blanks part words, as do the starts of rows in offs."""
    n = len(plain)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(plain + bytes(8), np.uint8)
    inner = offs[(offs > 0) & (offs < n)]
    char = raw[:n] != 0x20
    edge = np.ones(n, bool)
    np.logical_not(char[:-1], out=edge[1:])
    edge[inner] = True
    starts = np.flatnonzero(edge & char)
    edge[-1] = True
    np.logical_not(char[1:], out=edge[:-1])
    edge[inner - 1] = True
    length = np.flatnonzero(edge & char) + 1 - starts
    eight = np.lib.stride_tricks.as_strided(raw[:8].view(np.uint64), (n + 1,), (1,))
    hashes = mix((eight[starts] & LOW_BYTES[np.minimum(length, 8)]) ^ (length.astype(np.uint64) * BASE))
    at, k = np.flatnonzero((length > 8) & (length < LONG_WORD)), 8
    while len(at):
        hashes[at] = mix(hashes[at] * np.uint64(0xD6E8FEB86659FD93) + (eight[starts[at] + k] & LOW_BYTES[np.minimum(length[at] - k, 8)]))
        k += 8
        at = at[length[at] > k]
    for i in np.flatnonzero(length >= LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(plain[starts[i] : starts[i] + length[i]], digest_size=8).digest(), "little")
    return hashes, starts, length


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z lower-cased: hash and row. One very long row is taken in parts."""
    if len(offs) != 2 or len(data) <= BLOCK_BYTES:
        hashes, starts, _ = word_spans(data.tobytes().translate(PLAIN), offs)
        return hashes, np.searchsorted(offs, starts, side="right") - 1
    found, a = [], 0
    while a < len(data):
        b = min(a + BLOCK_BYTES, len(data))
        while b < len(data) and not SPACES[data[b]]:
            nearest = np.flatnonzero(SPACES[data[b : b + BLOCK_BYTES]])
            b = b + int(nearest[0]) if len(nearest) else min(b + BLOCK_BYTES, len(data))
        found.append(word_spans(data[a:b].tobytes().translate(PLAIN), np.array([0, b - a]))[0])
        a = b
    found = np.concatenate(found)
    return found, np.zeros(len(found), np.int64)


#: Cells that the hashes of tokens are counted in, and those of a part that one row carries.
CELLS, PART = 1 << 16, 1 << 13


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


#: Columns of the rows that carry counted cells.
CELL_KIND = "part int, salt int, counts binary"


def cell_rows(total: np.ndarray) -> list[pa.Array]:
    """A task's counts of cells (a row for each kind of token) as columns of CELL_KIND."""
    parts = total.reshape(-1, PART)
    task = TaskContext.get().partitionId()
    return [pa.array(range(len(parts)), pa.int32()), pa.array([task % 64] * len(parts), pa.int32()), binaries([x.tobytes() for x in parts])]


def levels_of(parts: DataFrame, kinds: int) -> np.ndarray:
    """From rows of CELL_KIND the rounded logarithms of the counts of each kind's cells. The rows are added up in two steps."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                now = np.frombuffer(counts, np.int64)
                held[part] = held[part] + now if part in held else now
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([0] * len(held), pa.int32()), binaries([x.tobytes() for x in held.values()])], ["part", "salt", "counts"])

    out = np.zeros((kinds * CELLS // PART, PART), np.int64)
    for part, _, counts in parts.repartition("part", "salt").mapInArrow(lean(add), CELL_KIND).repartition("part").mapInArrow(lean(add), CELL_KIND).collect():
        out[part] += np.frombuffer(counts, np.int64)
    return np.ceil(np.log2(np.maximum(out, 1))).astype(np.uint8).reshape(kinds, CELLS)


def count_cells(total: np.ndarray, tokens: list[np.ndarray]) -> None:
    for counts, hashes in zip(total, tokens, strict=True):
        counts += np.bincount(cell(hashes), minlength=CELLS)


def cell_levels(docs: DataFrame, text_col: str, tokens: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], kinds: int) -> np.ndarray:
    """For each kind of token and each cell the rounded logarithm of how many tokens of all texts fall to it: a count sketch of
    fixed size, whatever the input."""

    def count(batches):
        total = np.zeros((kinds, CELLS), np.int64)
        for batch in batches:
            data, offs = text_buffer(batch.column(0))
            for a, b in row_blocks(offs):
                count_cells(total, tokens(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))
        yield pa.RecordBatch.from_arrays(cell_rows(total), ["part", "salt", "counts"])

    return levels_of(docs.select(text_col).mapInArrow(lean(count), CELL_KIND), kinds)


def above_median(levels: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """By how much the cells of these hashes are above a kind's usual level."""
    return np.maximum(0, levels.astype(np.int64) - int(np.median(levels)))[cell(hashes)]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal keys in a stream that is sorted by them."""
    held: list[pa.Table] = []  # the pieces of the group that is not yet complete
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if not now.num_rows:
            continue
        if held and any(held[-1].column(k)[-1] != now.column(k)[0] for k in keys):
            yield pa.concat_tables(held).combine_chunks()
            held = []
        a = 0
        for b in _cuts(now, keys):
            yield pa.concat_tables([*held, now.slice(a, int(b) - a)]).combine_chunks()
            held, a = [], int(b)
        held.append(now.slice(a))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of equal keys from a sorted stream, with where each group starts and, last, the end."""
    held: list[pa.Table] = []
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if not now.num_rows:
            continue
        cuts = _cuts(now, keys)
        if len(cuts) or (held and any(held[-1].column(k)[-1] != now.column(k)[0] for k in keys)):
            last = int(cuts[-1]) if len(cuts) else 0
            whole = pa.concat_tables([*held, now.slice(0, last)]).combine_chunks()
            yield whole, np.concatenate(([0], _cuts(whole, keys), [whole.num_rows]))
            held = []
            now = now.slice(last)
        held.append(now)
    if held:
        whole = pa.concat_tables(held).combine_chunks()
        yield whole, np.array([0, whole.num_rows])


def _cuts(now: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(now.num_rows, bool)
    for k in keys:
        v = now.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array of the given lengths over values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def binaries(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())

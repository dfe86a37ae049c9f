"""Best-fit packing of tokenised documents: a configuration linear program over the histogram of lengths.

Only the histogram (as many entries as a sequence has tokens, at most) reaches the driver. There multiplicative weights
price lengths, a knapsack dynamic program finds the best-priced configuration, and the weighted configurations are
rounded; what rounding leaves is placed best-fit. Pieces then take their places by their rank among
pieces of the same length, which salted windows give without a large group.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import lean, saved, table

#: The pre-tokeniser's pattern of this public byte-level vocabulary (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Strings between spaces whose ids a Python worker remembers, and the longest one.
CACHED, CACHED_CHARS = 100_000, 32

_NEAR_SPACE = re.compile(r" \s|\s ")


class _Ids(dict):
    """From a string that follows a single space to the ids of both, packed as little-endian 32-bit numbers.

    The pre-tokeniser always cuts before a space that has no other white space beside it, so such strings can be
    encoded one by one. Texts with other white space beside a space go to the tokeniser whole, and so do
    texts that hold an added token's string.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, self.added = file["model"]["vocab"], [t["content"] for t in file["added_tokens"]]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if all(c in byte_of for c in token) and not token.startswith("<|")}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        found = array("I", self.fast.encode_ordinary(" " + word)).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found

    def of_text(self, text: str) -> bytes:
        if not text:
            return b""
        if _NEAR_SPACE.search(text) or text[0] == " " or text[-1] == " " or any(t in text for t in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.fast.encode_ordinary(first)).tobytes() + b"".join(map(self.__getitem__, rest))


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Pieces of at most capacity tokens: id_col, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit)."""
    end = array("I", [end_id]).tobytes()

    def run(batches):
        ids_of = _Ids(path)  # per task: a worker that later runs other stages must not go on holding the vocabulary
        for batch in batches:
            keys, texts, at, out = batch.column(0), batch.column(1), [], []
            encode = ids_of.of_text
            for row in range(batch.num_rows):
                ids = encode(texts[row].as_py() or "") + end
                n = len(ids) // 4
                cut, piece = (n % capacity or capacity) if n > capacity else n, 0
                a = 0
                while a < n:
                    part = ids[4 * a : 4 * cut]
                    at.append(row)
                    out.append((piece, a, cut - a, zlib.crc32(part), part if keep_ids else None))
                    a, cut, piece = cut, cut + capacity, piece + 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *columns], ["id", "piece", "start", "length", "ids_crc32", "ids"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(chosen.dtypes)["id"]
    pieces = chosen.mapInArrow(lean(run), f"id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")
    return (pieces if keep_ids else pieces.drop("ids")).withColumnRenamed("id", id_col)


def best_configuration(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack pricing: how often each length stands in the configuration of the highest total price."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            worth = best[c - lengths[: fits[c]]] + prices[: fits[c]]
            i = int(worth.argmax())
            if worth[i] > best[c]:
                best[c], pick[c] = worth[i], i
    times, c = np.zeros(len(lengths), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            times[pick[c]] += 1
            c -= lengths[pick[c]]
    return times


def configurations(histogram: dict[int, int], capacity: int, rounds: int = 250, rate: float = 4.0) -> list[tuple[dict[int, int], int]]:
    """(configuration, number of sequences) pairs that place every piece of the histogram.

    Multiplicative weights on the covering program: a length's price starts at its share of the capacity and falls as
    its demand is met. The averaged configurations are rounded to whole numbers within the demand; the rest goes best-fit.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[dict[int, int], int]] = []
    if capacity in left:
        out.append(({capacity: 1}, left.pop(capacity)))
    lengths = np.array(sorted(left), np.int64)
    if not len(lengths):
        return out
    demand = np.array([left[n] for n in lengths.tolist()], float)
    covered, weights = np.zeros(len(lengths)), {}
    for _ in range(rounds):
        times = best_configuration(lengths, lengths / capacity * np.exp(-rate * covered), capacity)
        used = np.flatnonzero(times)
        step = (demand[used] / times[used]).min() / 4
        covered[used] += step * times[used] / demand[used]
        key = tuple(zip(lengths[used].tolist(), times[used].tolist(), strict=True))
        weights[key] = weights.get(key, 0.0) + step
        if covered.min() >= 1:
            break
    scale = 1 / max(1.0, float(np.average(covered, weights=demand * lengths)))
    for key, weight in sorted(weights.items(), key=lambda x: -x[1]):
        n = min(round(weight * scale), *(left[size] // times for size, times in key))
        if n > 0:
            out.append((dict(key), n))
            for size, times in key:
                left[size] -= n * times
    return out + _best_fit({n: c for n, c in left.items() if c}, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that has room; equal sequences are handled together."""
    room: dict[int, list[list]] = {}
    count = np.zeros(capacity + 1, np.int64)
    done: list[tuple[dict[int, int], int]] = []

    def put(config: dict[int, int], n: int, free: int) -> None:
        if free == 0:
            done.append((config, n))
        else:
            room.setdefault(free, []).append([config, n])
            count[free] += n

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            open_at = np.flatnonzero(count[size:])
            if not len(open_at):
                each = min(capacity // size, n)
                put({size: each}, n // each, capacity - each * size)
                n -= n // each * each
                continue
            free = size + int(open_at[0])
            config, have = room[free].pop()
            each = min(free // size, max(1, n // have))
            use = min(have, n // each)
            count[free] -= have
            if have > use:
                put(config, have - use, free)
            put(config | {size: config.get(size, 0) + each}, use, free - each * size)
            n -= use * each
    return done + [(config, n) for entries in room.values() for config, n in entries]


#: Columns of pack()'s result besides the id.
RESULTS = ["piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, salts: int | None = None) -> DataFrame:
    """Every piece of docs with its sequence_id and its offset there; offsets of a sequence leave no gap from 0.

    A null or empty text is the end id alone. Texts over capacity are cut into pieces of capacity tokens, the first
    may be shorter; others are never cut. Repeated rows and null ids are packed like any other. Only id_col and
    text_col are read; an id_col named as another column of the result comes back as <id_col>_id. An empty table gives an
    empty table.
    """
    name = f"{id_col}_id" if id_col in RESULTS else id_col
    docs, id_col, text_col = docs.select(F.col(f"`{id_col}`").alias(name), F.col(f"`{text_col}`").alias("_text")), name, "_text"
    pieces = saved(token_pieces(docs, path, id_col, text_col, capacity, end_id, keep_ids))
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    slots, sequences = [], 0
    taken: dict[int, int] = {}
    for config, n in configurations(histogram, capacity):
        offset = 0
        for size, times in sorted(config.items(), reverse=True):
            first = taken.get(size, 0)
            slots.append((size, first, first + times * n, times, sequences, offset))
            taken[size] = first + times * n
            offset += times * size
        sequences += n
    # as many entries as configurations have parts: bounded by the rounds and the capacity, whatever the table's size
    places = docs.sparkSession.createDataFrame(slots, "length long, first long, last long, times long, base long, at long")
    if salts is None:
        salts = max(32, -(-sum(histogram.values()) // 1_000_000))
    own = [c for c in pieces.columns if c != "ids"]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*own)) - 1
    ranked = salted.withColumn("_rank", rank).join(starts, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    joined = ranked.alias("p").join(F.broadcast(places).alias("s"), F.expr("p.length = s.length AND p._rank >= s.first AND p._rank < s.last"))
    since = F.col("p._rank") - F.col("s.first")
    return joined.select(
        *(F.col(f"p.{c}") for c in pieces.columns),
        (F.col("s.base") + F.floor(since / F.col("s.times"))).cast("long").alias("sequence_id"),
        (F.col("s.at") + (since % F.col("s.times")) * F.col("p.length")).cast("long").alias("offset"),
    )


def op4_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

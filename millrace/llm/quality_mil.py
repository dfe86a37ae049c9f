"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE_WORDS words. Each passage is encoded from its characters and words; a hidden layer, gated
attention weights (tanh and sigmoid gates) and a logistic layer over the weighted passage representation are learned from
document labels. Fitting uses a bounded sample of labelled rows in the driver; scoring runs in tasks over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import BLOCK_BYTES, SPACES, lean, row_blocks, saved, table, text_buffer

PASSAGE_WORDS = 64
#: Labelled rows that the model is fitted on, at most: those of the smallest hashes of their ids.
SAMPLE = 6000
#: Bytes of one passage that stands for a text without white space.
PASSAGE_BYTES = 4096
#: Passages of the sample, at most: labelled rows are taken whole, in the order of their ids' hashes, as long as all of theirs fit.
SAMPLE_PASSAGES = 200_000

#: Printable ASCII singly; other ASCII; bytes of characters beyond it.
CLASS_OF = np.full(256, 96, np.int64)
CLASS_OF[32:127] = np.arange(95)
CLASS_OF[:32], CLASS_OF[127] = 95, 95
N_CLASSES, N_FEATURES = 97, 97 + 6


def _parts(data: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """Cuts of one long text at passages' starts, about BLOCK_BYTES apart: from, to, words of the passage before, inside a word."""
    out, at, rank, words, inside = [], 0, 0, 0, False
    for a in range(0, len(data), BLOCK_BYTES):
        block = SPACES[data[a : a + BLOCK_BYTES]]
        before = np.empty(len(block), bool)
        before[0], before[1:] = a == 0 or SPACES[data[a - 1]], block[:-1]
        starts = np.flatnonzero(~block & before)
        begins = starts[(words + np.arange(len(starts))) % PASSAGE_WORDS == 0]
        cut = a + int(begins[-1]) if len(begins) else at + (a + len(block) - at) // PASSAGE_BYTES * PASSAGE_BYTES
        if at < cut < len(data):
            out.append((at, cut, rank, inside))
            known = words + int(np.searchsorted(starts, cut - a))
            at, rank, inside = cut, known % PASSAGE_WORDS, not SPACES[data[cut - 1]]
        words += len(starts)
    return [*out, (at, len(data), rank, inside)]


def all_passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _passages; one very long text is taken in parts."""
    if len(offs) != 2 or len(data) <= BLOCK_BYTES:
        return _passages(data, offs)
    x = np.concatenate([_passages(data[a:b], np.array([0, b - a]), rank, inside)[0] for a, b, rank, inside in _parts(data)])
    return x, np.zeros(len(x), np.int64)


def _passages(data: np.ndarray, offs: np.ndarray, rank_before: int = 0, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage and its row; a row without text has one passage of zeros. rank_before, inside: of the first row, how
    many words its first passage already has, and whether it starts inside a word."""
    n_rows = len(offs) - 1
    space = SPACES[data]
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offs] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = space[:-1]
    edge = ~space & (before | row_start[:-1])
    edge[:1] &= not inside
    starts = np.flatnonzero(edge)
    row = np.searchsorted(offs, starts, side="right") - 1
    rank = np.arange(len(starts)) - np.searchsorted(row, row, side="left") + rank_before * (row == 0)
    begins = starts[rank % PASSAGE_WORDS == 0]
    begins = np.unique(np.concatenate([begins[begins > offs[np.searchsorted(offs, begins, side="right") - 1]], offs[:-1][np.diff(offs) > 0]])) if len(data) else np.zeros(0, np.int64)
    long = np.flatnonzero(np.diff(np.append(begins, len(data))) > 2 * PASSAGE_BYTES)
    if len(long):
        ends = np.append(begins, len(data))
        begins = np.unique(np.concatenate([begins, *(np.arange(begins[i], ends[i + 1], PASSAGE_BYTES) for i in long)]))
    size = np.diff(np.append(begins, len(data)))
    of_byte = np.repeat(np.arange(len(begins)), size)
    out = np.zeros((len(begins), N_FEATURES))
    out[:, :N_CLASSES] = np.bincount(of_byte * N_CLASSES + CLASS_OF[data], minlength=len(begins) * N_CLASSES).reshape(-1, N_CLASSES) / np.maximum(size, 1)[:, None]
    at = np.searchsorted(begins, starts, side="right") - 1
    words = np.bincount(at, minlength=len(begins))
    each = np.maximum(words, 1)
    ends = np.append(starts[1:], len(data))
    length = np.minimum(ends - starts, 64)
    first = data[starts] if len(starts) else np.zeros(0, np.uint8)
    out[:, 97] = np.bincount(at, weights=length, minlength=len(begins)) / each
    out[:, 98] = np.sqrt(np.maximum(0, np.bincount(at, weights=length**2, minlength=len(begins)) / each - out[:, 97] ** 2))
    out[:, 99] = np.bincount(at, weights=(first >= 65) & (first <= 90), minlength=len(begins)) / each
    out[:, 100] = np.bincount(at, weights=((first < 48) | ((first > 57) & (first < 65))), minlength=len(begins)) / each
    out[:, 101] = np.log1p(words)
    out[:, 102] = np.bincount(at, weights=length <= 2, minlength=len(begins)) / each
    of_row = np.searchsorted(offs, begins, side="right") - 1
    empty = np.setdiff1d(np.arange(n_rows), of_row)
    if len(empty):
        out, of_row = np.concatenate([out, np.zeros((len(empty), N_FEATURES))]), np.concatenate([of_row, empty])
        order = np.argsort(of_row, kind="stable")
        out, of_row = out[order], of_row[order]
    return out, of_row


class AttentionModel:
    """h = tanh(Wx + b); a = softmax over a bag of w.(tanh(Vh) * sigmoid(Uh)); score = sigmoid(c.(sum a h) + d)."""

    def __init__(self, width: int = 24, gate: int = 12, seed: int = 5):
        rng = np.random.RandomState(seed)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        shapes = {"W": (N_FEATURES, width), "b": (width,), "V": (width, gate), "U": (width, gate), "w": (gate,), "c": (width,), "d": (1,)}
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) * (len(s) > 1 or k in "wc") for k, s in shapes.items()}

    def _forward(self, x: np.ndarray, start: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        count = np.diff(np.append(start, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, start), count))
        a /= np.repeat(np.add.reduceat(a, start), count)
        z = np.add.reduceat(a[:, None] * h, start)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -30, 30)))
        return h, t, s, a, z, y, count

    def score(self, x: np.ndarray, start: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale, start)[5]

    def fit(self, x: np.ndarray, start: np.ndarray, label: np.ndarray, rounds: int = 250, rate: float = 0.02, decay: float = 1e-4) -> "AttentionModel":
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x, p = (x - self.mean) / self.scale, self.p
        first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, rounds + 1):
            h, t, s, a, z, y, count = self._forward(x, start)
            dy = (y - label) / len(label)
            dz = np.repeat(dy[:, None] * p["c"], count, axis=0)
            da = (dz * h).sum(1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, start), count))
            dt, ds = de[:, None] * s * p["w"] * (1 - t**2), de[:, None] * t * p["w"] * s * (1 - s)
            dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h**2)
            grad = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ dy, "d": np.array([dy.sum()])}
            for k, g in grad.items():
                g = g + decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self


def held_out(id_col: str) -> F.Column:
    """Whether a row is kept from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, sample_passages: int = SAMPLE_PASSAGES) -> AttentionModel:
    """A model of label_col (0 or 1), learned from at most `sample` labelled ids that are not held out; nothing but texts is an input.

    Of rows with the same labelled id one counts (that of the least text hash), and of an id's labels the least. Every passage of a text counts;
    labelled rows are taken in the order of their ids' hashes as long as they have at most sample_passages passages together. Null labels and ids are left out. Without rows, or with one label only, the
    model gives every text the same score: 0.95 if there is no row or the label is 1, 0.05 if it is 0.
    """
    chosen = labels.where(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("double").alias("label"))
    chosen = saved(chosen.groupBy(id_col).agg(F.min("label").alias("label")).orderBy(F.xxhash64(id_col, F.lit(17)), id_col).limit(sample))

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(0))
            label = batch.column(1).to_numpy()
            ids, texts = batch.column(2), batch.column(3)
            for a, b in row_blocks(offs):
                x, row = all_passages(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                bags = np.split(x, np.cumsum(np.bincount(row, minlength=b - a))[:-1])
                # a text of more passages than the whole sample may have is never fitted on
                held = [p.astype(np.float32).tobytes() if len(p) <= sample_passages else None for p in bags]
                yield pa.RecordBatch.from_arrays([pa.array(label[a:b]), pa.array(held, pa.binary()), pa.array([len(p) for p in bags], pa.int64()), ids.slice(a, b - a), texts.slice(a, b - a)], ["label", "passages", "n", "id", "text_hash"])

    # the sample is bounded, and so is the table that is broadcast to the scan
    some = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(text_col, "label", F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("text_hash"))
    bags = some.mapInArrow(lean(run), "label double, passages binary, n long, id string, text_hash long")
    bags = saved(bags.groupBy("id").agg(F.min_by(F.struct("label", "passages", "n"), "text_hash").alias("x")).select("id", "x.*"))
    before = F.sum("n").over(Window.orderBy(F.xxhash64("id", F.lit(17)), "id"))  # of `sample` rows at most
    fitting = bags.select("id", before.alias("before")).where(F.col("before") <= sample_passages).select("id")
    rows = bags.where("passages IS NOT NULL").join(F.broadcast(fitting), "id").select("label", "passages").collect()
    bags = [np.frombuffer(r[1], np.float32).reshape(-1, N_FEATURES) for r in rows]
    model = AttentionModel()
    if not bags or len({r[0] for r in rows}) < 2:
        model.p["c"][:] = 0
        model.p["d"][:] = 3.0 if not rows or rows[0][0] else -3.0
        return model
    order = np.lexsort(([b.tobytes()[:64] for b in bags], [len(b) for b in bags]))
    bags, label = [bags[i] for i in order], np.array([rows[i][0] for i in order])
    count = np.array([len(b) for b in bags])
    return model.fit(np.concatenate(bags).astype(float), np.cumsum(count) - count, label)


def score_quality(docs: DataFrame, model: AttentionModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score_col, the likelihood of label 1, from every passage of the whole text.

    Null and empty texts are scored as one empty passage; repeated rows are scored alike; other columns pass through (one of the name
    of score_col is replaced); an empty table gives an empty table.
    """
    columns = [c for c in docs.columns if c != score_col]

    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column(batch.schema.get_field_index(text_col)))
            scores = np.zeros(batch.num_rows)
            for a, b in row_blocks(offs):
                x, row = all_passages(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                scores[a:b] = model.score(x, np.searchsorted(row, np.arange(b - a)))
            yield batch.append_column(score_col, pa.array(scores)) if hasattr(batch, "append_column") else pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, score_col])

    kept = docs.select(*columns)
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return kept.mapInArrow(lean(run), f"{schema}, `{score_col}` double")


def op1_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model).drop("text")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))

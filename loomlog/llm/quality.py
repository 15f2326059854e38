"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is
encoded from its bytes (shares of byte classes, word repetition, hashed
words), ``h = tanh(x W)``; gated attention weighs the passages,
``a = softmax(w . (tanh(h V) * sigmoid(h U)))``, and the document's label is
a logistic function of ``sum a h``.  All weights are learned from document labels only.

Learning uses at most ``sample`` labelled documents, and of these, in the
order of a hash of the id (so the same rows every time), as many as have
``passages`` passages together (documented bounds on the labelled rows; a
document is taken whole or not at all).  Spark encodes them; the encoded
passages are fitted on the driver.  Scoring encodes every passage of every whole text inside Spark
tasks, a bounded slice at a time.

Edge cases: a null or empty text, or one without words, is a bag with one
zero passage and gets a score too; without usable labels of both kinds every
score is the share of label 1 (0.5 if there is none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm import textbytes as B
from loomlog.llm.common import importable, short_batches, written

PASSAGE = 48                         # words
HASHED = 64
SAMPLE = 5_000                       # labelled documents
SAMPLE_PASSAGES = 80_000             # of them together
ENCODED_BYTES = 500_000              # of texts encoded at a time: their arrays take some 60 times as much
_SYMBOLS = b"|$%&#*!?.,;:=<>{}()[]_-/@\\'\"+~"

#: byte classes: lower, upper, digit, space, newline, beyond ASCII, then single symbols, then other
_CLASS = np.full(256, 6 + len(_SYMBOLS), np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
_CLASS[[32, 9, 13, 11, 12]], _CLASS[10] = 3, 4
for _k, _b in enumerate(_SYMBOLS):
    _CLASS[_b] = 6 + _k
N_CLASS = 7 + len(_SYMBOLS)
N_FEATURES = N_CLASS + 6 + HASHED


def encode(s: B.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, row of each passage); a row without words has one zero passage."""
    rows = len(s.start) - 1
    w = B.words(s, B.SPACES)
    n_words = np.diff(w.first)
    per_row = np.maximum(1, -(-n_words // PASSAGE))
    row = np.repeat(np.arange(rows), per_row)
    first = np.cumsum(per_row) - per_row
    out = np.zeros((len(row), N_FEATURES), np.float32)
    if not len(w.start):
        return out, row
    of_row = np.repeat(np.arange(rows), n_words)
    within = np.arange(len(w.start)) - w.first[of_row]
    passage = first[of_row] + within // PASSAGE                    # of each word
    starts = np.flatnonzero(np.diff(passage, prepend=-1))          # first word of each passage with words
    at = passage[starts]
    size = np.diff(np.append(starts, len(passage)))
    # bytes belong to the passage of the last word begun before them
    edge = w.start[starts].copy()
    of_byte = np.zeros(len(s.data), np.int64)
    of_byte[edge] = 1
    of_byte = np.maximum(np.cumsum(of_byte) - 1, 0)
    k = len(starts)
    kinds = np.bincount(of_byte * N_CLASS + _CLASS[s.data], minlength=k * N_CLASS).reshape(k, N_CLASS)
    n_bytes = np.maximum(kinds.sum(1, keepdims=True), 1)
    code = B.word_hashes(s, w)
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])
    key = np.lexsort((code, passage))
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[key][1:] != code[key][:-1]) | (passage[key][1:] != passage[key][:-1])
    length = (w.end - w.start).astype(np.float64)
    sums = lambda v: np.add.reduceat(v.astype(np.float64), starts)
    count = size.astype(np.float64)
    mean = sums(length) / count
    stats = np.stack([sums(same) / count, sums(fresh) / count,    # `fresh` is sorted by passage, as are its sums
                      mean / 10, np.sqrt(np.maximum(sums(length**2) / count - mean**2, 0)) / 10,
                      np.log1p(count) / np.log(PASSAGE), sums(length == 1) / count], 1)
    stats[:, 1] = np.add.reduceat(fresh.astype(np.float64), starts) / count
    words = np.bincount(np.repeat(np.arange(k), size) * HASHED + (code % np.uint64(HASHED)).astype(np.int64),
                        minlength=k * HASHED).reshape(k, HASHED)
    out[at, :N_CLASS] = np.sqrt(kinds / n_bytes)
    out[at, N_CLASS:N_CLASS + 6] = stats
    out[at, N_CLASS + 6:] = np.sqrt(words / count[:, None])
    return out, row


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] | None  # W, b, V, U, w, c, and the bias in c's last place
    prior: float

    def scores(self, x: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        if self.weights is None:
            return np.full(rows, self.prior)
        return _forward(self.weights, (x - self.mean) / self.scale, row, rows)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(weights, x, row, rows):
    W, b, V, U, w, c = weights
    h = np.tanh(x @ W + b)
    tv, su = np.tanh(h @ V), _sigmoid(h @ U)
    e = np.exp(np.clip((tv * su) @ w, -20, 20))
    first = np.searchsorted(row, np.arange(rows))
    a = e / np.add.reduceat(e, first)[row]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    p = _sigmoid(z @ c[:-1] + c[-1])
    return p, (h, tv, su, a, z)


def fit(x: np.ndarray, row: np.ndarray, label: np.ndarray, hidden: int = 24, gate: int = 12,
        epochs: int = 30, batch: int = 256, seed: int = 7) -> Model:
    """x: passage features, row: document of each (ascending, none missing), label: of each document."""
    mean, scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-3
    prior = float(label.mean()) if len(label) else 0.5
    if not len(label) or label.min() == label.max():
        return Model(mean, scale, None, prior)
    rng = np.random.default_rng(seed)
    x = ((x - mean) / scale).astype(np.float32)
    weights = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
               rng.normal(0, hidden ** -0.5, (hidden, gate)), rng.normal(0, hidden ** -0.5, (hidden, gate)),
               rng.normal(0, gate ** -0.5, gate), np.append(rng.normal(0, hidden ** -0.5, hidden), 0)]
    moment, square, step = [0 * p for p in weights], [0 * p for p in weights], 0
    first = np.searchsorted(row, np.arange(len(label) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), batch):
            docs = order[lo:lo + batch]
            size = first[docs + 1] - first[docs]
            at = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            bag = np.repeat(np.arange(len(docs)), size)
            grads = _gradients(weights, x[at], bag, label[docs])
            step += 1
            for k, g in enumerate(grads):
                g = g + 1e-4 * weights[k]
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                weights[k] = weights[k] - 3e-3 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, weights, prior)


def _gradients(weights, x, row, label):
    W, b, V, U, w, c = weights
    rows = len(label)
    p, (h, tv, su, a, z) = _forward(weights, x, row, rows)
    d = (p - label) / rows                                         # of the log loss by the last sum
    dc = np.append(z.T @ d, d.sum())
    dz = d[:, None] * c[None, :-1]
    first = np.searchsorted(row, np.arange(rows))
    da = (dz[row] * h).sum(1)
    ds = a * (da - np.add.reduceat(a * da, first)[row])
    dgate = ds[:, None] * w[None]
    dv, du = dgate * su * (1 - tv**2), dgate * tv * su * (1 - su)
    dh = a[:, None] * dz[row] + dv @ V.T + du @ U.T
    dpre = dh * (1 - h**2)
    return [x.T @ dpre, dpre.sum(0), h.T @ dv, h.T @ du, (tv * su).T @ ds, dc]


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, text: str = "text",
          doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE, passages: int = SAMPLE_PASSAGES) -> Model:
    """Fit on at most ``sample`` labelled documents; ``usable`` says which rows may be learned from."""
    importable(docs.sparkSession)
    known = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label")))
    if usable is not None:
        known = known.where(usable(F.col("id")))
    known = written(known.orderBy(F.xxhash64("id"), "id").limit(sample), "sample")    # `sample` rows of two numbers
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    size = texts.join(F.broadcast(known), "id").select("id", "label", F.greatest(F.ceil(F.coalesce(words, F.lit(0)) / PASSAGE), F.lit(1)).alias("n"))
    size = size.groupBy("id", "label").agg(F.sum("n").alias("n"))                     # `sample` rows
    so_far = F.sum("n").over(Window.orderBy(F.xxhash64("id"), "id"))
    known = written(size.withColumn("so_far", so_far).where(F.col("so_far") <= passages).select("id", "label"), "sample")

    def encoded(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            ids = batch.column("id").to_numpy()
            for s in B.slices(batch.column("text"), ENCODED_BYTES):
                x, row = encode(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[s.lo:s.hi][row]), pa.array(label[s.lo:s.hi][row]),
                     pa.array([v.tobytes() for v in x], pa.binary())], ["id", "label", "x"])

    kind = docs.schema[doc_id].dataType.simpleString()
    with short_batches(docs.sparkSession):
        rows = (texts.join(F.broadcast(known), "id").select("id", "label", "text")
                .mapInArrow(encoded, f"id {kind}, label int, x binary").toArrow().to_pandas())
    if not len(rows):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), None, 0.5)
    rows = rows.sort_values(["id", "x"], kind="stable")            # the same order whatever the tasks' was
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, N_FEATURES)
    ids, row = np.unique(rows["id"].to_numpy(), return_inverse=True)
    label_of = np.zeros(len(ids))
    label_of[row] = rows["label"].to_numpy()
    return fit(x, row, label_of)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every row with __score."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    importable(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            at = batch.schema.names.index(text)
            found = [np.zeros(0)]
            for s in B.slices(batch.column(at), ENCODED_BYTES):
                x, row = encode(s)
                found.append(model.scores(x, row, s.hi - s.lo))
            kept = [batch.column(batch.schema.names.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(found))], [*keep, "__score"])

    schema = StructType([*[docs.schema[c] for c in keep], StructField("__score", DoubleType(), True)])
    return docs.mapInArrow(run, schema)

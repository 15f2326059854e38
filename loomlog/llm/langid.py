"""Language identification by prediction by partial matching (PPM).

Per language a variable-order byte context tree is frozen from counts over
all training text: a context of up to three bytes predicts the next byte,
an unseen byte escapes to the next shorter context with probability
``distinct / (total + distinct)`` and the bytes already ruled out are
excluded, so each tree is a proper distribution.  A text's code length under
each language is the exact sum over its bytes; the shortest wins and the
score is its posterior probability under equal priors.

Counting is a Spark aggregate of (language, four-byte run); the frozen trees
are broadcast: one dense table ``cost[context, byte, language]`` (log2) of the
contexts up to two bytes, and a language's three-byte contexts as sorted runs,
each counted one, and nothing else.  The byte alphabet is that of the training text.

Edge cases: a null text or one without a letter is ``und`` with score 0; an
empty training set gives ``und`` everywhere; equal code lengths go to the
language first in alphabetical order; texts of any length are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm import textbytes as B

ORDER = 3


def _previous(s: B.Slice, k: int) -> np.ndarray:
    """The byte ``k`` places earlier in the same row, 0 before its start."""
    out = np.zeros(len(s.data), np.uint8)
    out[k:] = B.LOWER[s.data[:-k]] if k < len(s.data) else 0
    for d in range(k):
        at = s.start[:-1] + d
        out[at[at < s.start[1:]]] = 0
    return out


def _runs(s: B.Slice) -> np.ndarray:
    code = np.zeros(len(s.data), np.uint32)
    for k in range(ORDER, 0, -1):
        code = (code | _previous(s, k)) << np.uint32(8)
    return code | B.LOWER[s.data]


def count_runs(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, code, n): how often each four-byte run occurs in each language."""
    def count(batches):
        for batch in batches:
            names, label = np.unique(np.array(batch.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
            found, times = [], []
            for s in B.slices(batch.column(0)):
                code = _runs(s).astype(np.uint64)
                code |= np.repeat(label[s.lo:s.hi].astype(np.uint64), np.diff(s.start)) << np.uint64(32)
                k, n = np.unique(code, return_counts=True)
                found.append(k)
                times.append(n)
            if found:
                k, at = np.unique(np.concatenate(found), return_inverse=True)
                n = np.bincount(at, np.concatenate(times), len(k)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[(k >> np.uint64(32)).astype(int)].astype(object), pa.string()),
                     pa.array((k & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "code", "n"])

    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    return rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    langs: list[str]
    symbol: np.ndarray               # byte -> symbol; 0: not seen in training
    row: np.ndarray                  # two symbols -> row of cost
    cost: np.ndarray                 # [row * symbols + symbol, language]: log2 probability
    long: list[tuple[np.ndarray, ...]]   # per language, of three symbols: runs and their log2 probability,
                                     # contexts and what an escape adds to the log2 of the shorter one


def _node(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Byte probabilities of contexts from their counts and their shorter contexts'."""
    if len(counts) > 1000:                                        # bounds the temporary arrays
        return np.concatenate([_node(counts[k:k + 1000], lower[k:k + 1000]) for k in range(0, len(counts), 1000)])
    seen = counts > 0
    total, distinct = counts.sum(-1, keepdims=True), seen.sum(-1, keepdims=True)
    left = np.maximum(1 - np.where(seen, lower, 0).sum(-1, keepdims=True), 1e-9)
    escape = distinct / np.maximum(total + distinct, 1)
    return np.where(total > 0, np.where(seen, counts / np.maximum(total + distinct, 1), escape * lower / left), lower)


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``keys``, whether it is there) of each wanted key."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def freeze(counts: DataFrame) -> Trees | None:
    """The trees of all languages from ``count_runs`` (a row per language and distinct run)."""
    counts.persist()
    short = counts.groupBy("lang", F.col("code").bitwiseAND(0xFFFFFF).alias("code")).agg(F.sum("n").alias("n")).toPandas()
    if not len(short):
        counts.unpersist()
        return None
    langs = sorted(short["lang"].unique())
    number = F.array_position(F.array(*[F.lit(name) for name in langs]), F.col("lang")) - 1
    runs = counts.select(number.cast("int").alias("lang"), "code", "n").toPandas()   # three numbers a run
    counts.unpersist()
    of = {name: i for i, name in enumerate(langs)}
    present = np.unique(short["code"].to_numpy() & 255)
    symbol = np.zeros(256, np.int64)
    symbol[present] = np.arange(1, len(present) + 1)
    a = len(present) + 1

    def table(rows: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct contexts of ``length`` symbols, and counts[context, language, symbol]."""
        code, key = rows["code"].to_numpy(), np.zeros(len(rows), np.int64)
        for k in range(length, 0, -1):
            key = key * a + symbol[(code >> (8 * k)) & 255]
        keys, at = np.unique(key, return_inverse=True)
        n = np.zeros((len(keys), len(langs), a), np.float32)
        np.add.at(n, (at, rows["lang"].map(of).to_numpy(), symbol[code & 255]), rows["n"].to_numpy())
        return keys, n

    _, n0 = table(short, 0)
    probability = [_node(n0, np.full((1, len(langs), a), 1 / 256, np.float32))]
    lower, filled = np.zeros(1, np.int64), 1                       # row of each shorter context
    for length in range(1, ORDER):
        keys, n = table(short, length)
        parents = lower[keys % a ** (length - 1)]
        probability.append(_node(n, np.concatenate(probability)[parents]))
        mine = np.tile(lower, a)                                   # key % a**(length-1) picks the shorter context
        mine[keys] = filled + np.arange(len(keys))
        filled, lower = filled + len(keys), mine
    p = np.concatenate(probability)                                # [row, language, symbol]
    code, key = runs["code"].to_numpy(), np.zeros(len(runs), np.int64)
    for k in range(ORDER, -1, -1):
        key = key * a + symbol[(code >> (8 * k)) & 255]
    long = []
    for i in range(len(langs)):
        mine = np.flatnonzero(runs["lang"].to_numpy() == i)
        seen, at = np.unique(key[mine], return_inverse=True)
        n = np.bincount(at, runs["n"].to_numpy()[mine], len(seen))
        context, of, distinct = np.unique(seen // a, return_inverse=True, return_counts=True)
        whole = np.bincount(of, n, len(context)) + distinct
        shorter = p[lower[seen // a % a ** (ORDER - 1)], i, seen % a]
        left = np.maximum(1 - np.bincount(of, shorter, len(context)), 1e-9)
        long.append((seen, np.log2(n / whole[of]).astype(np.float32), context, np.log2(distinct / whole / left).astype(np.float32)))
    cost = np.log2(np.maximum(p.transpose(0, 2, 1).reshape(-1, len(langs)), 1e-12), dtype=np.float32)
    return Trees(langs, symbol, lower.astype(np.int32), cost, long)


def code_lengths(trees: Trees, s: B.Slice) -> np.ndarray:
    """Bits of each row of the slice under each language."""
    a = int(trees.symbol.max()) + 1
    run = np.zeros(len(s.data), np.int64)
    for k in range(ORDER, 0, -1):
        run = (run + trees.symbol[_previous(s, k)]) * a
    run, back = np.unique(run + trees.symbol[B.LOWER[s.data]], return_inverse=True)
    cost = trees.cost[trees.row[run // a % a ** (ORDER - 1)].astype(np.int64) * a + run % a]
    for i, (seen, known, context, escape) in enumerate(trees.long):
        at, there = _lookup(context, run // a)
        cost[there, i] += escape[at[there]]
        at, there = _lookup(seen, run)
        cost[there, i] = known[at[there]]
    cost = cost[back]
    out = np.zeros((len(s.start) - 1, len(trees.langs)))
    full = np.flatnonzero(np.diff(s.start))
    if len(full):
        out[full] = -np.add.reduceat(cost, s.start[:-1][full], axis=0, dtype=np.float64)
    return out


def identify(docs: DataFrame, trees: Trees | None, text: str = "text", doc_id: str = "doc_id",
             held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for every row."""
    held_out = F.lit(False) if held_out is None else held_out
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.col(text).alias("text"))
    if trees is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("bits_per_byte"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        trees = shared.value
        names = np.array(trees.langs, dtype=object)
        for batch in batches:
            column = batch.column("text")
            bits = [code_lengths(trees, s) for s in B.slices(column)]
            bits = np.concatenate(bits) if bits else np.zeros((0, len(names)))
            size = np.diff(B.string_parts(column)[1])
            best = bits.argmin(1)
            least = bits.min(1)
            posterior = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(np.where(letters, names[best], "und"), pa.string()),
                 pa.array(np.where(letters, posterior, 0.0)),
                 pa.array(least / np.maximum(size, 1), mask=~letters)],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")

"""Benchmark decontamination with one Aho-Corasick automaton.

Test items and documents are normalised alike: A-Z lower-cased, words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space.  Every run of 13
consecutive words of an item (its whole sequence if it has fewer) is a
pattern of the automaton; each document is scanned once, hits overlap
freely, and the words they cover are mapped back to character offsets of the
original text.

The automaton is built from the items the driver reads, at most
``shard_bytes`` of text at a time; a larger benchmark is scanned shard by
shard and the hits are united per document (same result, tested).

Edge cases: a null or empty text has no words and is clean; an item without
words matches nothing; a repeated item row counts once; items with the same
text each count; a null doc_id or item_id is carried or ignored respectively.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm import textbytes as B

WINDOW = 13
SHARD_BYTES = 32_000_000

#: Bytes to their normal form: small letters for A-Z, a space for any other byte outside words.
_NORMAL = bytes(int(B.LOWER[b]) if B.ALNUM[b] else 32 for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows(items: list[tuple[object, str]], window: int = WINDOW) -> dict[str, list]:
    """Pattern -> the item ids that have it.  Patterns start and end with a space."""
    out: dict[str, set] = {}
    for item, text in items:
        w = normal_words((text or "").encode())
        for k in range(max(1, len(w) - window + 1) if w else 0):
            out.setdefault(" " + b" ".join(w[k:k + window]).decode("latin-1") + " ", set()).add(item)
    return {k: sorted(v) for k, v in out.items()}


_BUILT: dict[str, ahocorasick.Automaton] = {}


def automaton(key: str, patterns: dict[str, list]) -> ahocorasick.Automaton:
    """Built once per Python worker and ``key``; a worker is reused by later scans, and holds the last one."""
    if key not in _BUILT:
        _BUILT.clear()
        a = ahocorasick.Automaton()
        for k, (pattern, items) in enumerate(sorted(patterns.items())):
            a.add_word(pattern, (pattern.count(" ") - 1, items))
        a.make_automaton()
        _BUILT[key] = a
    return _BUILT[key]


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _scan_text(a, text: bytes):
    """(number of words, hit words as a mask or None, items)."""
    w = normal_words(text)
    if not w or not len(a):
        return len(w), None, ()
    line = b" " + b" ".join(w) + b" "
    found = [(end, size, items) for end, (size, items) in a.iter(line.decode("latin-1"))]
    if not found:
        return len(w), None, ()
    at = np.cumsum(np.frombuffer(line, np.uint8) == 32)          # spaces up to each character
    cover = np.zeros(len(w) + 1, np.int64)
    names = set()
    for end, size, items in found:
        last = at[end] - 1                                       # words before the closing space
        cover[last - size] += 1
        cover[last] -= 1
        names.update(items)
    return len(w), np.cumsum(cover[:-1]) > 0, names


def _offsets(text: bytes, hit: np.ndarray) -> list[dict]:
    """Character offsets [start, end) of the runs of hit words in the original text."""
    data = np.frombuffer(text, np.uint8)
    s = B.Slice(0, 1, data, np.array([0, len(data)]))
    w = B.words(s, B.ALNUM)
    char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    first, last = _spans(hit)
    return [{"start": int(char[w.start[i]]), "end": int(char[w.end[j]])} for i, j in zip(first, last, strict=True)]


SPANS = "array<struct<start:long,end:long>>"


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with n_words, n_hit,
    items (ids as sorted strings) and spans (character offsets of hit words)."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    bench = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL").distinct()
    size = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-int(size) // shard_bytes))
    scanned = None
    for shard in range(shards):
        rows = bench.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == shard) if shards > 1 else bench
        patterns = windows([(str(r["i"]), r["t"]) for r in rows.collect()], window)   # at most about shard_bytes
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, patterns))   # named: tasks can't tell broadcasts apart
        source = docs if scanned is None else scanned
        scanned = source.mapInArrow(_scanner(shared, text, scanned is not None), _schema(docs, scanned is not None))
    return scanned.select(*[F.col(f"`{c}`") for c in keep], F.col("__scan.n_words").alias("n_words"),
                          F.col("__scan.n_hit").alias("n_hit"), F.col("__scan.items").alias("items"),
                          F.col("__scan.spans").alias("spans"))


_RESULT = f"struct<n_words:long,n_hit:long,items:array<string>,spans:{SPANS},words:array<struct<start:long,end:long>>>"


def _schema(docs: DataFrame, _again: bool):
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string
    return StructType([*docs.schema.fields, StructField("__scan", _parse_datatype_string(_RESULT), True)])


def _scanner(shared, text: str, again: bool):
    def run(batches):
        for batch in batches:
            a = automaton(*shared.value)
            column = batch.column(batch.schema.names.index(text))
            data, offsets = B.string_parts(column)
            before = batch.column(batch.num_columns - 1).to_pylist() if again else None
            out = []
            for r in range(batch.num_rows):
                raw = data[offsets[r]:offsets[r + 1]].tobytes()
                n, hit, names = _scan_text(a, raw)
                runs = []
                if again:                                     # unite with the earlier shards' hits
                    old = before[r]
                    names = set(names) | set(old["items"])
                    if old["words"]:
                        hit = np.zeros(n, bool) if hit is None else hit
                        for x in old["words"]:
                            hit[x["start"]:x["end"] + 1] = True
                if hit is not None:
                    runs = [{"start": int(i), "end": int(j)} for i, j in zip(*_spans(hit), strict=True)]
                out.append({"n_words": n, "n_hit": int(hit.sum()) if hit is not None else 0, "items": sorted(names),
                            "spans": _offsets(raw, hit) if hit is not None else [], "words": runs})
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                              ("spans", span), ("words", span)])
            kept = [batch.column(k) for k in range(batch.num_columns - again)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, kind)], [*batch.schema.names[:len(kept)], "__scan"])
    return run


def contaminated():
    """The rule: at least a twentieth of the words lies in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scanned.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                          contaminated().alias("contaminated"))

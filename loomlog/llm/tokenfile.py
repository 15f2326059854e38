"""Token-id files with Simple-8b word-aligned coding.

Documents are tokenised in ascending doc_id order (range-partitioned by
Spark) and written as blocks, one Parquet row each:

    part, block   position: file partition, then block within it
    doc_ids       the documents of the block
    n_tokens      ids of each document, its end id included
    n_ids         ids of the block
    words         little-endian 64-bit Simple-8b words
    word_start    for every ``STRIDE``-th word, the index of its first id

Each word has a 4-bit selector (top bits) and 60 bits of payload holding the
selector's count of equally wide ids, first id lowest.  Selector 0 is the
escape: the next word is one raw 64-bit value; selector 1 is 120 zeros.
Blocks decode on their own and ``word_start`` lets any run of words decode
alone; both directions are numpy over whole blocks.  Parquet is the
container, so Spark's commit protocol decides which task attempt counts.

Edge cases: a null or empty text is the end id alone; a null doc_id sorts
first; rows with equal doc_id keep the order of (doc_id, text); an empty
table gives an empty file; a document longer than ``BLOCK`` ids is a block of its own.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.session import input_partitions, scratch_path

BLOCK = 1 << 16                      # ids, about
STRIDE = 64                          # words between index entries
END_ID = 2
CACHED_CHUNKS = 500_000
CACHED_WORDS = 250_000

# Ids per word and bits per id of each selector (Simple-8b).
COUNTS = np.array([0, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


#: Bits of every number below 2**16.
_BITS = np.concatenate([[0], np.repeat(np.arange(1, 17), 1 << np.arange(16))]).astype(np.uint8)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    bits, value = np.zeros(len(ids), np.uint8), ids
    for k in (48, 32, 16):
        big = np.flatnonzero(ids >> np.uint64(k) > 0) if int(ids.max()) >> k else np.zeros(0, np.int64)
        if len(big):
            fresh = big[bits[big] == 0]
            value = value.copy()
            bits[fresh] = k
            value[fresh] >>= np.uint64(k)
    return bits + _BITS[value.astype(np.int64)]


def pack(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words of non-negative ids: each word takes as many as fit."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.full(n + 120, 255, np.uint8)                         # a word may not run over the end
    bits[:n] = _bit_lengths(ids)
    best = np.zeros(n, np.uint8)                                   # selector; 0: escape
    widest, reach = bits.copy(), 1                                 # widest[i]: most bits among the next `reach` ids
    for selector in range(15, 0, -1):
        while reach < COUNTS[selector]:
            double = min(2 * reach, COUNTS[selector])
            ahead = np.full_like(widest, 255)
            ahead[:len(widest) - (double - reach)] = widest[double - reach:]
            widest, reach = np.maximum(widest, ahead), double
        best[widest[:n] <= WIDTHS[selector]] = selector
    step = COUNTS[best]
    step[best == 0] = 1
    step, at, i = step.tolist(), [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at)
    chosen = best[at]
    place = np.arange(len(at)) + np.cumsum(chosen == 0) - (chosen == 0)   # an escape takes two words
    out = np.zeros(len(at) + int((chosen == 0).sum()), np.uint64)
    for selector in np.unique(chosen):
        mine = chosen == selector
        if selector == 0:
            out[place[mine] + 1] = ids[at[mine]]
            continue
        word = np.full(int(mine.sum()), int(selector) << 60, np.uint64)
        if WIDTHS[selector]:
            for k in range(COUNTS[selector]):
                word |= ids[at[mine] + k] << np.uint64(k * WIDTHS[selector])
        out[place[mine]] = word
    return out


def _first_ids(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(selector, is a raw value, index of the first id) of each word."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    escapes = np.flatnonzero(selector == 0)
    if len(escapes):                                               # a raw value may itself look like an escape
        after = -1
        for k in escapes.tolist():
            if k != after and k + 1 < len(words):
                raw[k + 1] = True
                after = k + 1
    count = np.where(raw, 1, COUNTS[selector])
    return selector, raw, np.cumsum(count) - count


def unpack(words: np.ndarray) -> np.ndarray:
    selector, raw, first = _first_ids(words)
    if not len(words):
        return np.zeros(0, np.uint64)
    last = 1 if raw[-1] else COUNTS[selector[-1]]
    out = np.zeros(first[-1] + last, np.uint64)
    out[first[raw]] = words[raw]
    for s in np.unique(selector[~raw]):
        mine = np.flatnonzero((selector == s) & ~raw)
        if WIDTHS[s]:
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for k in range(COUNTS[s]):
                out[first[mine] + k] = (words[mine] >> np.uint64(k * WIDTHS[s])) & mask
    return out


def word_index(words: np.ndarray) -> np.ndarray:
    return _first_ids(words)[2][::STRIDE].astype(np.uint32)


# Byte-level BPE writes these bytes as themselves, the others as 256, 257, ...
_AS_IS = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHAR = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _AS_IS)}
_WORD_THEN_MARKS = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]+)")
_MARKS = frozenset(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


class Encoder(dict):
    """Ids of whole texts, by way of the ids of their whitespace-free chunks.

    The vocabulary's normaliser and splitter never join characters across
    ASCII white space, so a text's ids are those of its chunks in order.  It
    lower-cases, so A-Z are lower-cased before the look-up (not in a text that
    may name special tokens).  A chunk of small letters in composed form is one
    piece to the splitter and goes to the BPE model directly; so do the two
    parts of letters followed by ASCII marks; any other chunk is encoded in
    full.  (All tested against whole texts.)  At most ``CACHED_CHUNKS`` chunks are
    kept, their ids one after the other in one array, and ``CACHED_WORDS`` words
    without marks of each of two generations, which outlive the chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, tuple[int, ...] | None] = {}
        self.older: dict[bytes, tuple[int, ...] | None] = {}
        self.marks: dict[bytes, tuple[int, ...]] = {}
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0      # ids of all chunks; how many
        self.first, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self[b""] = 0                                              # the mark at a document's end
        self._enter(0, [END_ID], [1])

    def _enter(self, at: int, ids: list[int], sizes: list[int]) -> None:
        """Chunks from number ``at`` on: their ids in a row and how many each has."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(sizes) > len(self.size):
            self.first, self.size = (np.concatenate([v, np.zeros_like(v)]) for v in (self.first, self.size))
        self.ids[self.used:self.used + len(ids)] = ids
        size = np.array(sizes, np.int64)
        self.size[at:at + len(size)] = size
        self.first[at:at + len(size)] = self.used + np.cumsum(size) - size
        self.used += len(ids)

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at

    @staticmethod
    def chunks(text: bytes) -> list[bytes]:
        return (text if b"<|" in text else text.lower()).split()

    def _word(self, word: bytes) -> tuple[int, ...] | None:
        """Ids of a chunk that is one piece to the splitter, else None."""
        if word in self.words:
            return self.words[word]
        if word in self.older:
            ids = self.older[word]
        elif word.isascii():
            ids = self._piece(word.decode()) if word.isalpha() and word.islower() else None
        else:
            plain = word.decode()
            whole = plain.isalpha() and plain == plain.lower() and unicodedata.is_normalized("NFC", plain)
            ids = self._piece(word.decode("latin-1").translate(_BYTE_CHAR)) if whole else None
        if len(self.words) >= CACHED_WORDS:
            self.older, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        return tuple([t.id for t in self.model.tokenize(piece)])

    def _chunk(self, chunk: bytes) -> tuple[int, ...]:
        parts = _WORD_THEN_MARKS.fullmatch(chunk) if chunk[-1] in _MARKS else None
        if parts is None:
            ids = self._word(chunk)
        else:
            ids = self._word(parts[1])
            if ids is not None:
                ids += self._marks(parts[2])
        return tuple(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids) if ids is None else ids

    def _marks(self, marks: bytes) -> tuple[int, ...]:
        if marks not in self.marks:
            if len(self.marks) >= 10_000:
                self.marks.clear()
            self.marks[marks] = self._piece(marks.decode())
        return self.marks[marks]

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each chunk)."""
        if len(self) > CACHED_CHUNKS:
            self.reset()
        at = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
        if self.new:
            found = [self._chunk(chunk) for chunk in self.new]
            self._enter(len(self) - len(found), list(chain.from_iterable(found)), list(map(len, found)))
            self.new.clear()
        first, size = self.first[at], self.size[at]
        where = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.ids[where], size


_ENCODER: dict[str, Encoder] = {}


def _blocks(path: str):
    def run(batches):
        if path not in _ENCODER:
            _ENCODER[path] = Encoder(path)
        encoder, part, block = _ENCODER[path], TaskContext.get().partitionId(), 0
        names, ids, size = [], [], []

        def row():
            nonlocal block
            words = pack(np.concatenate(ids))
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([size], pa.list_(pa.int64())), pa.array([sum(size)], pa.int64()), pa.array([words.astype("<u8").tobytes()]),
                 pa.array([word_index(words).astype("<u4").tobytes()])],
                ["part", "block", "doc_ids", "n_tokens", "n_ids", "words", "word_start"])
            block += 1
            names.clear(), ids.clear(), size.clear()
            return out

        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            keys = batch.column(0).to_pylist()
            lo = 0
            while lo < len(keys):                                  # about a block's worth of text at a time
                chunks, hi, room = [], lo, 4 * BLOCK
                ends = [0]
                while hi < len(keys) and room > 0:
                    t = texts[hi].as_py() or b""
                    chunks += encoder.chunks(t)
                    chunks.append(b"")
                    ends.append(len(chunks))
                    room -= len(t) + 1
                    hi += 1
                got, of_chunk = encoder.encode(chunks)
                bound = np.concatenate([[0], np.cumsum(of_chunk)])[ends]
                names += keys[lo:hi]
                size += np.diff(bound).tolist()
                ids.append(got)
                lo = hi
                if sum(size) >= BLOCK:
                    yield row()
        if names:
            yield row()
    return run


SCHEMA = ("part int, block int, doc_ids array<long>, n_tokens array<long>, n_ids long, "
          "words binary, word_start binary")


def write(docs: DataFrame, tokenizer: str, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenise ``docs`` and write the ids in ascending doc_id order to ``path``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = input_partitions(rows)
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(_blocks(tokenizer), SCHEMA).write.parquet(path)


def _decode(batches):
    for batch in batches:
        for part, block, names, size, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4)), strict=True):
            ids = unpack(np.frombuffer(raw, "<u8")).astype("<u4")
            end = np.cumsum(size)
            crc = [zlib.crc32(ids[b - n:b].tobytes()) for b, n in zip(end.tolist(), size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(names), pa.int32()), pa.array([block] * len(names), pa.int32()),
                 pa.array(names, pa.int64()), pa.array(end - size), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the file."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    sizes = blocks.select("part", "block", "n_ids")
    # one number per file partition, then one per block: no window over all rows
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, at = [], 0
    for r in parts:
        before.append((r["part"], at))
        at += r["n"]
    offsets = spark.createDataFrame(before, "part int, before long")
    w = Window.partitionBy("part").orderBy("block")
    sizes = (sizes.withColumn("base", F.sum("n_ids").over(w) - F.col("n_ids")).join(F.broadcast(offsets), "part")
             .select("part", "block", (F.col("base") + F.col("before")).alias("base")))
    docs = blocks.select("part", "block", "doc_ids", "n_tokens", "words").mapInArrow(
        _decode, "part int, block int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return docs.join(sizes, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` to ``path`` (a scratch folder if None) and read the digest back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    write(docs, tokenizer, path)
    return digest(spark, path)

"""Byte-level BPE by prefix dynamic programming.

The merges of a rank file give every byte string one encoding, and the
encoding of a prefix ends in one token only: the one token ending there that
stays apart from the last token of the prefix before it (the merges over both
tokens' bytes give these two again).  ``Prefixes.last`` stores that token for
every prefix of a byte string, so

* the encoding of any prefix is read off backwards;
* appending bytes only adds entries (``Prefixes.append``);
* after an edit, entries are computed anew until as many in a row as the
  longest token has bytes equal the old ones: from there on, equal bytes after
  equal entries give the old entries again (``Prefixes.replace``).

``TextTokens`` keeps this for a whole text, cut into pieces by the rank
file's pattern; ``encode`` and ``decode`` are the Spark operators: every text
is cut, each distinct piece is encoded once per cache, ids come out as an array.

Edge cases: a null or empty text has no ids (and decodes to no bytes); rows
are independent, so repeated rows, ties and nulls in other columns change
nothing; a text of any length is one row, worked on in slices; an empty table
gives an empty table; only the columns named in ``keep`` are read besides the
text, so other columns never clash.  Every single byte has to be a token.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog.llm import textbytes
from loomlog.llm.common import importable

CACHED_PIECES = 150_000              # distinct pieces of a generation, two of which a task process keeps
CACHED_LENGTH = 48                   # characters of the longest piece kept
CACHED_PAIRS = 1_000_000             # token pairs whose verdict is kept
SLICE_IDS = 1_000_000                # ids decoded at a time


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as fh:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, fh)}


class Prefixes:
    """The last token of every prefix of one byte string."""

    def __init__(self, coder: Coder, data: bytes = b""):
        self.coder, self.data, self.last = coder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end: stored entries stay as they are."""
        self.coder.extend(self.data + more, self.last)
        self.data += more

    def replace(self, lo: int, hi: int, new: bytes) -> int:
        """Put ``new`` in the place of the bytes ``lo .. hi`` (end not included);
        returns how many entries had to be computed."""
        old, tail = self.last[hi:], self.data[hi:]
        self.data = self.data[:lo] + new
        self.last = self.last[:lo]
        self.coder.extend(self.data, self.last)
        done, same, worked = 0, 0, len(new)
        while done < len(tail) and same < self.coder.longest:
            step = tail[done:done + 64]                            # some bytes at a time
            self.data += step
            self.coder.extend(self.data, self.last)
            for a, b in zip(old[done:done + len(step)], self.last[len(self.data) - len(step):], strict=True):
                same = same + 1 if a == b else 0
            done += len(step)
            worked += len(step)
        self.data += tail[done:]
        self.last += old[done:]
        return worked

    def ids(self, length: int | None = None) -> list[int]:
        """Ids of the first ``length`` bytes (of all)."""
        return self.coder.read_off(self.last, len(self.last) if length is None else length)


class Coder:
    """Prefix encoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.none = max(ranks.values()) + 1
        self.finder = ahocorasick.Automaton()                      # all tokens that end at a byte, in one walk
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.states: dict[int, list[tuple[int, bytes, bytes]]] = {}

    def _merging(self, token: int) -> list[tuple[int, bytes, bytes]]:
        """How the merges run over a token's own bytes, always the neighbours of
        least rank and the first of equals: for every state the rank of the next
        merge, and the first and the last part.  A token they do not reach has no states."""
        states = self.states.get(token)
        if states is None:
            data, none = self.token[token], self.none
            parts = [data[k:k + 1] for k in range(len(data))]
            of = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            states = []
            while of and (least := min(of)) < none:
                states.append((least, parts[0], parts[-1]))
                k = of.index(least)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
                del of[k]
                if k < len(of):
                    of[k] = self.ranks.get(parts[k] + parts[k + 1], none)
                if k:
                    of[k - 1] = self.ranks.get(parts[k - 1] + parts[k], none)
            states.append((none, parts[0], parts[-1]))
            self.states[token] = states = states if len(parts) == 1 else []
        return states

    def _apart(self, key: int) -> bool:
        """Whether the tokens of ``key`` stay two tokens beside each other.

        Their merges interleave by rank.  They meet if at some point the parts
        that touch make a token whose turn comes before the next merge on the
        left (which goes first if equal) and not after the next on the right."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        left = self._merging(key >> 32) if key >= 0 else []
        right = self._merging(key & 0xFFFFFFFF)
        i = j = 0
        out = None if left and right else False
        while out is None:
            (a, _, end), (b, start, _) = left[i], right[j]
            both = self.ranks.get(end + start, self.none)
            if both < a and both <= b:
                out = False
            elif a == b == self.none:
                out = True
            elif a <= b:
                i += 1
            else:
                j += 1
        self.pairs[key] = out
        return out

    def _alone(self, token: int) -> bool:
        """Whether the merges reach the token from its own bytes."""
        return bool(self._merging(token))

    def extend(self, data: bytes, last: list[int]) -> None:
        """Complete ``last`` for ``data``, whose first len(last) entries are there."""
        n, done = len(data), len(last)
        if n == done:
            return
        pairs = self.pairs.get
        last += [-1] * (n - done)
        for end, (rank, size) in self.finder.iter(data.decode("latin-1"), max(0, done - self.longest + 1)):
            if last[end] < 0:                                      # no other token fits once one did
                if end < size:
                    good = self._alone(rank)
                else:
                    key = last[end - size] << 32 | rank
                    good = pairs(key)
                    if good is None:
                        good = self._apart(key)
                if good:
                    last[end] = rank
        if min(last[done:]) < 0:
            raise ValueError(f"no token ends after byte {last.index(-1)}: the rank file lacks a byte")

    def read_off(self, last: Sequence[int], length: int) -> list[int]:
        out = []
        while length:
            out.append(last[length - 1])
            length -= self.size[out[-1]]
        return out[::-1]

    def ids(self, data: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        last: list[int] = []
        self.extend(data, last)
        return self.read_off(last, len(data))


class _Pieces(dict):
    """Ids of pieces as arrays, which join as bytes, kept for short ones: those met lately and the generation before."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder, self.before = coder, {}

    def learn(self, found: list[list[str]]) -> None:
        """Encode what is new among the pieces, in byte order: each one's table
        goes on from the bytes it has in common with the one before."""
        new = set(chain.from_iterable(found)).difference(self, self.before)
        data, last = b"", []
        for raw in sorted(p.encode() for p in new if len(p) <= CACHED_LENGTH):
            same = 0
            for a, b in zip(raw, data, strict=False):
                if a != b:
                    break
                same += 1
            data, last = raw, last[:same]
            self.coder.extend(data, last)
            rank = self.coder.ranks.get(raw)                       # a piece that is a token is that token
            self._keep(raw.decode(), array("i", (rank,) if rank is not None else self.coder.read_off(last, len(raw))))

    def _keep(self, piece: str, ids: array) -> None:
        if len(self) >= CACHED_PIECES:
            self.before = dict(self)
            self.clear()
        self[piece] = ids

    def __missing__(self, piece: str) -> array:
        ids = self.before.get(piece)
        if ids is None:
            ids = array("i", self.coder.ids(piece.encode()))
        if len(piece) <= CACHED_LENGTH:
            self._keep(piece, ids)
        return ids


class TextTokens:
    """The tokens of a text that grows or is edited.

    Pieces are matches of the pattern, each encoded on its own.  How far a
    match goes is decided at most two characters past its end, so a change at
    character ``at`` leaves every piece that ends before ``at - 1`` as it is;
    behind the change the cutting stops where it meets an old boundary."""

    REACH = 2

    def __init__(self, coder: Coder, pattern: str, text: str = ""):
        self.coder, self.pattern = coder, regex.compile(pattern)
        self.text, self.ends, self.pieces = "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, lo: int, hi: int, new: str) -> int:
        """Put ``new`` in the place of the characters ``lo .. hi``; returns the pieces encoded for it."""
        keep = bisect_right(self.ends, lo - self.REACH)
        grown = len(new) - (hi - lo)
        old = {end + grown: k for k, end in enumerate(self.ends) if end >= hi}
        self.text = self.text[:lo] + new + self.text[hi:]
        at = self.ends[keep - 1] if keep else 0
        ends, pieces, rest = [], [], len(self.ends)
        for m in self.pattern.finditer(self.text, at):
            ends.append(m.end())
            pieces.append(Prefixes(self.coder, m.group().encode()))
            if m.end() >= lo + len(new) and m.end() in old:
                rest = old[m.end()] + 1
                break
        self.ends = self.ends[:keep] + ends + [e + grown for e in self.ends[rest:]]
        self.pieces = self.pieces[:keep] + pieces + self.pieces[rest:]
        return len(pieces)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p.ids()]


# ------------------------------------------------------------------ Spark

_CODERS: dict[tuple[str, str], tuple[_Pieces, regex.Pattern]] = {}


def _coder(path: str, pattern: str) -> tuple[_Pieces, regex.Pattern]:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = _Pieces(Coder(read_ranks(path))), regex.compile(pattern)
    return _CODERS[path, pattern]


def _encoder(path: str, pattern: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, cut = _coder(path, pattern)
        for batch in batches:
            for s in textbytes.slices(batch.column(batch.num_columns - 1)):
                raw = s.data.tobytes()
                found = [cut.findall(raw[a:b].decode()) for a, b in zip(s.start[:-1].tolist(), s.start[1:].tolist(), strict=True)]
                pieces.learn(found)
                ids = [b"".join(map(pieces.__getitem__, text)) for text in found]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                kept = [batch.column(k).slice(s.lo, s.hi - s.lo) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, column], [*batch.schema.names[:-1], out])
    return run


def _decoder(path: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(path)
        size = np.array([len(t) for t in token], np.int64)
        first = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(token), np.uint8)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            ends = np.asarray(column.offsets, np.int64)
            lo = 0
            while lo < len(column):
                hi = int(np.searchsorted(ends, ends[lo] + SLICE_IDS, side="right")) - 1
                hi = min(len(column), max(lo + 1, hi))
                ids = np.asarray(column.values[int(ends[lo]):int(ends[hi])])
                n = size[ids]
                stop = np.concatenate([[0], np.cumsum(n)])
                data = flat[np.repeat(first[ids] - stop[:-1], n) + np.arange(stop[-1])]
                bounds = stop[ends[lo:hi + 1] - ends[lo]]
                decoded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
                kept = [batch.column(k).slice(lo, hi - lo) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, decoded.cast(pa.binary())], [*batch.schema.names[:-1], out])
                lo = hi
    return run


_TOKENS: dict[str, list[bytes]] = {}


def _tokens(path: str) -> list[bytes]:
    """Tokens by rank; a rank the file leaves out has no bytes."""
    if path not in _TOKENS:
        ranks = read_ranks(path)
        by_rank = {rank: token for token, rank in ranks.items()}
        _TOKENS[path] = [by_rank.get(k, b"") for k in range(max(by_rank) + 1)]
    return _TOKENS[path]


def _mapped(df: DataFrame, keep: Sequence[str], column: Column, out: str, kind: T.DataType, run) -> DataFrame:
    if out in keep:
        raise ValueError(f"column {out!r} is both kept and made")
    importable(df.sparkSession)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, kind)])
    return df.select(*keep, column.alias("__worked_on")).mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",),
           out: str = "ids") -> DataFrame:
    """``keep`` and ``out``, the ids of ``text`` (an array of int), one row per row.

    ``ranks`` is a rank file every executor can open; each match of ``pattern`` is encoded separately."""
    return _mapped(docs, keep, docs[text], out, T.ArrayType(T.IntegerType(), False), _encoder(ranks, pattern, out))


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",),
           out: str = "decoded") -> DataFrame:
    """``keep`` and ``out``, the bytes of the array ``ids`` (none for a null array)."""
    filled = F.coalesce(encoded[ids], F.array().cast("array<int>"))
    return _mapped(encoded, keep, filled, out, T.BinaryType(), _decoder(ranks, out))

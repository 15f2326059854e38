"""Vectors as codes: each part of a vector becomes the number of its nearest codebook entry.

Components are integers floor(256 x), so every distance, sum and entry is
exact.  A codebook per part position starts from the vectors of the smallest
ids and is improved in rounds: assign, then put each entry at the floor of the
mean of its parts; a last assignment gives the codes.

Assignments after the first use adaptive bounds.  The first one computes every
distance and leaves with each part its ``b`` closest entries in order, a lower
bound of the distance to each, and one outer bound for all entries besides.
When entries have moved, each bound falls by its entry's movement, the outer
one by the largest; bounds are put in order again from the far end.  An entry
whose bound exceeds the exact distance to the part's present entry cannot win,
nor can any behind it: only the list's first ones below it are compared, in
integers, ties to the lower number.  Where the outer bound does not clear the
distance, all entries are compared and the list is made anew.  ``b`` follows
what the last assignment needed: it doubles while many parts needed all
entries and else shrinks to what 99 % of the rows used.

Bounds are stored rounded down and movements rounded up, so rounding never
hides a winner.  Spark holds the rows: each assignment reads the table of the
one before (vectors, lists, bounds) and writes its own under
``spark.checkpoint.dir``; sums are added up per task, then by Spark.  The
driver sees codebooks only: entries x components, whatever the row count.

Edge cases: a vector that is null or holds a null or non-finite component is
dropped; the length coded is the one most vectors have that is a multiple of
the number of parts (ties: the longer), rows of another length stay with a
null code and error; equal vectors get equal codes; repeated rows and ids are
rows of their own, though an id gives one start entry only (its smallest
vector) and a null id none; with fewer ids than entries the codebooks are as
short; an empty table gives an empty result.  A component beyond 2**18 (2**26
as an integer) fails the job: its squared distances need not fit a long.
Other columns are read only if named in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog.llm.common import importable
from loomlog.session import drop_scratch, scratch_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BOUNDS = 8                           # closest entries listed at first
LARGEST = 2**26
ROWS = 2048                          # rows worked on at a time

STATE = [T.StructField("__near", T.BinaryType()), T.StructField("__lower", T.BinaryType()),
         T.StructField("__outer", T.BinaryType()), T.StructField("__b", T.IntegerType()),
         T.StructField("__used", T.IntegerType()), T.StructField("__full", T.IntegerType()),
         T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(vector: Column) -> Column:
    def of(x: Column) -> Column:
        y = F.floor(x.cast("double") * SCALE)
        large = F.abs(x.cast("double")) < float("inf")             # not null, not NaN: the planner may run this before the filter
        return F.when(F.abs(y) <= LARGEST, y).when(large, F.raise_error(F.lit("component beyond 2**18"))).cast("int")
    return F.transform(vector, of)


# ------------------------------------------------------------ in a task

def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts (n, w) to entries (k, w)."""
    out = np.zeros((len(x), len(book)), np.int64)
    for c in range(x.shape[1]):
        gap = x[:, c, None] - book[None, :, c]
        out += gap * gap
    return out


def _down(square: np.ndarray) -> np.ndarray:
    """A float32 not above the root."""
    return np.nextafter(np.sqrt(square.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


def _up(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square.astype(np.float64)) * (1 + 1e-12), np.inf)


def _listed(d: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the b closest entries, their distances rounded down, the distance of the next one)."""
    order = np.argsort(d, axis=1, kind="stable")                   # ties: the lower number first
    ranked = np.take_along_axis(d, order[:, :b + 1], 1)
    outer = _down(ranked[:, b]) if d.shape[1] > b else np.full(len(d), np.inf, np.float32)
    return order[:, :b].astype(np.uint8), _down(ranked[:, :b]), outer


@dataclass
class Cells:
    """One part position of some rows: list, bounds, present entry's exact squared distance."""
    near: np.ndarray                 # (n, b) entry numbers; len(book) is no entry
    lower: np.ndarray                # (n, b) ordered lower bounds
    outer: np.ndarray                # (n,)
    square: np.ndarray               # (n,)
    used: np.ndarray                 # (n,) list entries compared; 0 where all were
    full: np.ndarray                 # (n,) whether all entries were compared


def assign_first(x: np.ndarray, book: np.ndarray, b: int) -> Cells:
    d = squared(x, book)
    near, lower, outer = _listed(d, b)
    return Cells(near, lower, outer, d.min(axis=1), np.zeros(len(x), np.int32), np.ones(len(x), bool))


def assign_again(x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, lower: np.ndarray,
                 outer: np.ndarray, b: int) -> Cells:
    """``moved``: how far each entry went, rounded up; the lists are of the assignment before, ``b`` is for the new ones."""
    n, width = near.shape
    rows = np.arange(n)
    went = np.append(moved, 0.0)[near]
    reach = np.concatenate([lower - went - (np.abs(lower) + went) * 1e-12, (outer - moved.max())[:, None]], 1)
    reach[:, width] -= (np.abs(outer) + moved.max()) * 1e-12
    reach = np.minimum.accumulate(reach[:, ::-1], 1)[:, ::-1]      # ordered: none behind is nearer than its bound
    mine = near[:, 0].astype(np.int64)
    gap = x - book[mine]
    square = (gap * gap).sum(1)
    uncertain = reach <= _up(square)[:, None]
    full = uncertain[:, width].copy()
    used = np.where(full, 0, np.maximum(uncertain[:, :width].sum(1), 1))
    reach[:, 0] = np.minimum(_down(square), reach[:, 1])
    near = near.copy()
    some = np.flatnonzero(used > 1)
    if len(some):
        most = int(used[some].max())
        listed = near[some, :most].astype(np.int64)
        away = x[some, None, :] - book[np.minimum(listed, len(book) - 1)]
        d = (away * away).sum(2)
        skip = np.arange(most)[None, :] >= used[some, None]
        key = np.where(skip, np.iinfo(np.int64).max, d)
        order = np.lexsort((listed, key), axis=1)                  # by distance, then number; those not compared stay behind
        order = np.where(np.take_along_axis(skip, order, 1), np.arange(most)[None, :], order)
        near[some, :most] = np.take_along_axis(listed, order, 1)
        exact = _down(np.take_along_axis(d, order, 1))
        reach[some, :most] = np.where(skip, reach[some, :most], exact)
        square[some] = np.take_along_axis(d, order, 1)[:, 0]
        reach = np.minimum.accumulate(reach[:, ::-1], 1)[:, ::-1]
    if width > b:                                                  # what falls off the list is under the outer bound
        lower, outer, near = reach[:, :b], reach[:, b], near[:, :b]
    else:
        pad = b - width
        lower, outer = np.concatenate([reach[:, :width], np.repeat(reach[:, width:], pad, 1)], 1), reach[:, width]
        near = np.concatenate([near, np.full((n, pad), len(book), np.uint8)], 1)
    lower, outer = (np.nextafter(v.astype(np.float32), np.float32(-np.inf)) for v in (lower, outer))
    todo = rows[full]
    if len(todo):
        d = squared(x[todo], book)
        near[todo], lower[todo], outer[todo] = _listed(d, b)
        square[todo] = d.min(1)
    return Cells(near, lower, outer, square, used.astype(np.int32), full)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim).astype(np.int64)


def _binaries(column: pa.Array, kind, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _assigner(names: list[str], books: np.ndarray, moved: np.ndarray | None, b: int):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                n = batch.num_rows
                x = _vectors(batch.column("__ints"), parts * width).reshape(n, parts, width)
                if moved is None:
                    cells = [assign_first(x[:, p], books[p], b) for p in range(parts)]
                else:
                    had = batch.column("__b")[0].as_py()
                    near = _binaries(batch.column("__near"), np.uint8, (parts, had))
                    lower = _binaries(batch.column("__lower"), "<f4", (parts, had))
                    outer = _binaries(batch.column("__outer"), "<f4", (parts,))
                    cells = [assign_again(x[:, p], books[p], moved[p], near[:, p], lower[:, p], outer[:, p], b)
                             for p in range(parts)]

                def packed(values: list[np.ndarray], kind, n=n) -> pa.Array:
                    table = np.stack(values, 1).astype(kind)
                    return pa.array([row.tobytes() for row in table.reshape(n, -1)], pa.binary())

                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names),
                     packed([c.near for c in cells], np.uint8), packed([c.lower for c in cells], "<f4"),
                     packed([c.outer for c in cells], "<f4"), pa.array([b] * n, pa.int32()),
                     pa.array(np.max([c.used for c in cells], 0), pa.int32()),
                     pa.array(np.sum([c.full for c in cells], 0).astype(np.int32), pa.int32()),
                     packed([c.near[:, 0] for c in cells], np.uint8),
                     pa.array(np.sum([c.square for c in cells], 0).astype(np.int64))],
                    [*names, *(f.name for f in STATE)])
    return run


def _adder(shape: tuple[int, int, int]):
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column(0), parts * width).reshape(-1, parts, width)
                code = _binaries(batch.column(1), np.uint8, (parts,))
                for p in range(parts):
                    np.add.at(sums[p], code[:, p], x[:, p])
                    counts[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]),
             pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
    return run


# ------------------------------------------------------------ in Spark

def _start(rows: DataFrame, entries: int, id: str) -> np.ndarray:
    """Vectors of the smallest ids, one each; at most ``entries`` rows reach the driver at a time."""
    got: list[tuple] = []
    left = rows.where(F.col(id).isNotNull()).select(id, "__ints")
    while len(got) < entries:
        more = left.orderBy(id, "__ints").limit(entries).collect()
        for r in more:
            if len(got) < entries and (not got or r[0] != got[-1][0]):
                got.append((r[0], r[1]))
        if len(more) < entries:
            break
        left = left.where(F.col(id) > F.lit(more[-1][0]))
    return np.array([v for _, v in got], np.int64)


def _assigned(rows: DataFrame, names: list[str], books: np.ndarray, moved: np.ndarray | None, b: int) -> tuple[DataFrame, str]:
    """The rows with lists and bounds as a table, and its folder."""
    schema = T.StructType([rows.schema[c] for c in names] + STATE)
    path = scratch_path(rows.sparkSession, "vector-codes")
    rows.mapInArrow(_assigner(names, books, moved, b), schema).write.parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path), path


def _improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    parts, _, width = books.shape
    sums = rows.select("__ints", "code").mapInArrow(_adder(books.shape), "part int, entry int, n long, sums array<long>")
    out = books.copy()
    added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    for r in added.collect():                                      # parts x entries rows at most
        out[r["part"], r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(width)]
    return out


def _next_b(rows: DataFrame, b: int, parts: int, entries: int) -> int:
    """The list length that the last assignment calls for."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("__full").alias("full"),
                    F.percentile_approx("__used", 0.99).alias("used")).first()
    if not seen["n"]:
        return b
    if seen["full"] > seen["n"] * parts / 8:
        return min(2 * b, max(entries - 1, 1))
    return min(max(2, min(b, seen["used"])), max(entries - 1, 1))


@dataclass
class Codes:
    rows: DataFrame                  # id, kept columns, code (binary: an entry number for each part), error
    books: np.ndarray                # (parts, entries, components of a part)
    listed: list[int]                # b of each assignment

    def digest(self) -> str:
        """sha256 of all entries' components in order, as decimal text."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, id: str = "vec_id", vector: str = "embedding", keep: Sequence[str] = (),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, bounds: int = BOUNDS) -> Codes:
    """Codes of all usable vectors of ``df``; see the module doc."""
    if not 1 <= entries <= 255:
        raise ValueError("an entry number takes one byte: 1 to 255 entries")
    importable(df.sparkSession)
    names = [id, *(c for c in keep if c != id)]
    if set(names) & {f.name for f in STATE}:
        raise ValueError("a kept column has the name of a result column")
    all_rows = df.where(usable(F.col(vector))).select(*names, integers(F.col(vector)).alias("__ints"))
    sizes = df.where(usable(F.col(vector))).groupBy(F.size(vector).alias("dim")).count()
    dim = sizes.where(f"dim > 0 AND dim % {parts} = 0").orderBy(F.desc("count"), F.desc("dim")).first()
    if dim is None:
        none = all_rows.select(*names, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return Codes(none, np.zeros((parts, 0, 0), np.int64), [])
    width = dim["dim"] // parts
    fits = F.size("__ints") == dim["dim"]
    rows = all_rows.where(fits)
    start = _start(rows, entries, id)
    if not len(start):                                             # no id at all: entries from any rows would be arbitrary
        none = all_rows.select(*names, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return Codes(none, np.zeros((parts, 0, width), np.int64), [])
    books = start.reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    b, listed, moved, folder, spark = min(bounds, max(len(start) - 1, 1)), [], None, None, df.sparkSession
    for last in [False] * rounds + [True]:
        rows, made = _assigned(rows, [*names, "__ints"], books, moved, b)
        if folder:
            drop_scratch(spark, folder)                            # the one before: this one is whole
        folder = made
        listed.append(b)
        if last:
            break
        if len(listed) > 1:
            b = _next_b(rows, b, parts, len(start))
        new = _improved(rows, books)
        moved, books = _up(((new - books) ** 2).sum(2)), new
    out = rows.select(*names, "code", "error")
    other = all_rows.where(~fits).select(*names, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return Codes(out.unionByName(other), books, listed)


def with_label_error(rows: DataFrame, label: str = "label") -> DataFrame:
    """``label_error``: the errors of all rows with the label (nulls together) added up."""
    total = rows.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(total, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")

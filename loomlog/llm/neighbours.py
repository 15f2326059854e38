"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is normalised, turned by a random rotation and projected on
``DIMS`` of its axes; a grid with a random shift maps the projection to a
position on a Hilbert curve.  ``CURVES`` such orderings exist.  Equal vectors
are one row there, under their smallest id, and come back as their smallest
``k + 1`` ids after the reranking.  For each ordering Spark range-partitions
all rows by curve position, numbers them, and cuts them into blocks of equally
many rows, so rows at one position fill several blocks instead of one task.  A query looks at
the blocks within ``REACH`` of the table on either side of its own place,
ranks their rows by an 8-bit code of the vector, and keeps the best few per
block.  The windows of all curves are merged per query and the best
``RERANK`` candidates are reranked by the exact cosine in double precision.

The rotation, shifts and grid come from ``seed`` and the dimension alone:
nothing is fitted, every row is indexed.  The share of a table that a query
looks at sets the recall; ``REACH`` is for the worst case, vectors without
any structure (isotropic noise), where no index can do with much less.

Rows: null vectors, zero vectors and vectors with null or non-finite
components take no part, as query or candidate.  A cosine needs equal lengths:
vectors of each number of components are searched among themselves, one length
after the other (``dims``: of that length only).  Rows with a null id take no part.  Repeated ids count
once (the largest vector).  Equal scores go to the smaller id.  With fewer
candidates than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import importable, written
from loomlog.session import input_partitions, shuffle_width

CURVES = 24
DIMS = 8
BITS = 6
REACH = 0.03
BLOCK = 1024                         # rows of a block
BEST = 8                             # candidates a query keeps from one block
RERANK = 40


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid coordinates (0 .. 2**bits-1)."""
    x = grid.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):                               # undo the turns of each level, top first
        low = np.uint64((1 << b) - 1)
        for i in range(dims):
            high = (x[i] >> np.uint64(b)) & one == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):                                       # Gray code across the axes
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one == 1, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


def curve_axes(dims: int, curves: int, width: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(axes, shift) of each curve; axes of one rotation are shared out until used up."""
    rng = np.random.default_rng(seed)
    out, turned, used = [], None, dims
    width = min(width, dims)
    for _ in range(curves):
        if used + width > dims:
            turned, used = np.linalg.qr(rng.normal(size=(dims, dims)))[0], 0
        out.append((turned[:, used:used + width], rng.uniform(0, 1, width)))
        used += width
    return out


def positions(unit: np.ndarray, axes: np.ndarray, shift: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of unit vectors: the grid spans +-4 standard deviations of an axis."""
    scaled = unit @ axes * np.sqrt(unit.shape[1])
    grid = (scaled + 4 + shift) / 9 * (1 << bits)
    return hilbert(np.clip(grid, 0, (1 << bits) - 1), bits).astype(np.int64)


def _matrix(column) -> np.ndarray:
    """A list column without nulls as a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, one per id."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.where(finite).where(F.exists(v, lambda x: x != 0))
    return rows.groupBy("id").agg(F.max("v").alias("v"))


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5,
            dims: int | None = None, curves: int = CURVES, width: int = DIMS, bits: int = BITS, reach: float = REACH,
            block: int = BLOCK, best: int = BEST, rerank: int = RERANK, seed: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on the column ``id``."""
    importable(vectors.sparkSession)
    rows = valid(vectors, vec_id, vector)
    lengths = [dims] if dims is not None else [r["d"] for r in rows.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    found = [_of_length(rows, is_query, k, d, curves, width, bits, reach, block, best, rerank, seed) for d in lengths or [1]]
    return reduce(DataFrame.unionByName, found)


def _of_length(rows: DataFrame, is_query: Column, k: int, dims: int, curves: int, width: int, bits: int, reach: float,
               block: int, best: int, rerank: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    twin = [F.xxhash64(F.lit(salt), "v").alias(f"f{salt}") for salt in (1, 2)]
    every = written(rows.where(F.size("v") == dims).select("id", "v", F.coalesce(is_query, F.lit(False)).alias("is_query"), *twin), "vectors")
    # one row a distinct vector, under its smallest id; `ids`: its smallest k + 1
    first_ids = every.select("id", "f1", "f2").withColumn("r", F.row_number().over(Window.partitionBy("f1", "f2").orderBy("id")))
    copies = written(first_ids.where(F.col("r") <= k + 1).groupBy("f1", "f2").agg(F.sort_array(F.collect_list("id")).alias("ids")), "copies")
    asked_for = every.where("is_query").select("f1", "f2").distinct().withColumn("is_query", F.lit(True))
    classes = copies.join(asked_for, ["f1", "f2"], "left").select(
        F.col("ids")[0].alias("id"), "ids", F.coalesce("is_query", F.lit(False)).alias("is_query"))
    classes = written(classes, "classes")
    rows = written(classes.join(every.select("id", "v"), "id").select("id", "v", "is_query"), "distinct-vectors")
    n = rows.count()
    axes = curve_axes(dims, curves, width, seed)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column("v"))
            unit = m / np.abs(m).max(1, keepdims=True)             # first to a safe range, then to length 1
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            largest = np.abs(unit).max(1, keepdims=True)
            code = pa.array([c.tobytes() for c in np.round(unit / largest * 127).astype(np.int8)], pa.binary())
            scale = pa.array(largest[:, 0] / 127)
            for c, (a, shift) in enumerate(axes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(m), c, np.int32)), pa.array(positions(unit, a, shift, bits)),
                     batch.column("id"), batch.column("is_query"), code, scale],
                    ["curve", "key", "id", "is_query", "code", "scale"])

    shape = "curve int, key long, id long, is_query boolean, code binary, scale double"
    placed = written(rows.mapInArrow(place, shape), "placed")
    parts = max(input_partitions(placed), shuffle_width(spark) or 1)
    ordered = placed.repartitionByRange(parts, "curve", "key", "id").sortWithinPartitions("curve", "key", "id")

    def number(batches):                                           # running number inside the partition
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            seq = np.arange(at, at + batch.num_rows)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(seq)],
                                             [*batch.schema.names, "part", "seq"])

    numbered = written(ordered.mapInArrow(number, shape + ", part int, seq long"), "ordered")
    # one number per file partition: place of its first row in the order of all curves
    before, at = [], 0
    for r in numbered.groupBy("part").count().orderBy("part").collect():
        before.append((r["part"], at))
        at += r["count"]
    first = spark.createDataFrame(before, "part int, before long")
    at = F.col("before") + F.col("seq") - F.col("curve") * n        # place on its curve: every curve has n rows
    ranked = numbered.join(F.broadcast(first), "part").withColumn("at", at)
    far = max(1, int(np.ceil(reach * n)))
    last = max(0, (n - 1) // block)
    index = ranked.select("curve", F.floor(F.col("at") / block).cast("long").alias("block"), "id", "code", "scale")
    asked = ranked.where("is_query").select(
        F.col("curve").alias("q_curve"), F.explode(F.sequence(
            F.greatest(F.floor((F.col("at") - far) / block), F.lit(0)).cast("long"),
            F.least(F.floor((F.col("at") + far) / block), F.lit(last)).cast("long"))).alias("q_block"),
        F.col("id").alias("query_id"), F.col("code").alias("q_code"), F.col("scale").alias("q_scale"))

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            unpack = lambda v: np.frombuffer(b"".join(v), np.int8).reshape(len(v), -1).astype(np.float32)
            m = unpack(rows["code"]) * rows["scale"].to_numpy(np.float32)[:, None]
            order = np.argsort(rows["id"].to_numpy(), kind="stable")
            m, ids = m[order], rows["id"].to_numpy()[order]
            for lo in range(0, len(queries), 512):
                part = queries.iloc[lo:lo + 512]
                score = unpack(part["q_code"]) @ m.T * part["q_scale"].to_numpy(np.float32)[:, None]
                mine = part["query_id"].to_numpy()
                score[mine[:, None] == ids[None]] = -np.inf
                few = min(best, len(ids))
                top = np.argpartition(-score, few - 1, axis=1)[:, :few]
                least = np.take_along_axis(score, top, 1).min(1)
                tied = np.flatnonzero((score >= least[:, None]).sum(1) > few)
                if len(tied):                                      # equal scores at the end: the smaller ids
                    top[tied] = np.argsort(-score[tied], axis=1, kind="stable")[:, :few]
                got = np.take_along_axis(score, top, 1)
                keep = np.isfinite(got)
                out.append(pd.DataFrame({"query_id": np.repeat(mine, few)[keep.ravel()], "id": ids[top][keep],
                                         "near": got[keep].astype(np.float64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "near": []})

    found = (index.groupBy("curve", "block").cogroup(asked.groupBy("q_curve", "q_block"))
             .applyInPandas(compare, "query_id long, id long, near double"))
    # a pair found on several curves counts once; a query has at most curves * blocks in reach * best
    merged = found.groupBy("query_id", "id").agg(F.max("near").alias("near"))
    by_near = Window.partitionBy("query_id").orderBy(F.desc("near"), "id")
    few = merged.withColumn("r", F.row_number().over(by_near)).where(F.col("r") <= rerank).select(
        F.col("query_id").alias("q_id"), F.col("id").alias("c_id"))
    own = rows.where("is_query").select(F.col("id").alias("q_id"), F.col("id").alias("c_id"))
    some = (few.unionByName(own).join(rows.select("id", "v"), F.col("c_id") == F.col("id")).select("q_id", "c_id", "v")
            .join(rows.where("is_query").select(F.col("id").alias("query_id"), F.col("v").alias("q")),
                  F.col("q_id") == F.col("query_id")).select("query_id", F.col("c_id").alias("id"), "v", "q"))

    def rescore(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column("q")), _matrix(batch.column("v"))
                a, b = (m / np.abs(m).max(1, keepdims=True) for m in (a, b))
                score = (a * b).sum(1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(score)],
                                                 ["query_id", "vec_id", "score"])

    exact = some.mapInArrow(rescore, "query_id long, vec_id long, score double")
    # every copy of a candidate has its score; the best k + 1 serve all queries of the class, each without itself
    spread = exact.join(classes.select(F.col("id").alias("c_id"), "ids"), F.col("vec_id") == F.col("c_id")).select(
        F.col("query_id").alias("class_id"), F.explode("ids").alias("vec_id"), "score")
    in_class = Window.partitionBy("class_id").orderBy(F.desc("score"), "vec_id")
    spread = spread.withColumn("r", F.row_number().over(in_class)).where(F.col("r") <= k + 1).drop("r")
    queries = every.where("is_query").select(F.col("id").alias("query_id"), "f1", "f2").join(copies, ["f1", "f2"]).select(
        "query_id", F.col("ids")[0].alias("c_id"))
    answers = queries.join(spread, F.col("c_id") == F.col("class_id")).where("query_id <> vec_id")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(by_score).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

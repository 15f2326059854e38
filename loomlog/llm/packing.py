"""Conflict-constrained best-fit packing of documents into training sequences.

Documents longer than a sequence are cut into pieces of ``length`` tokens
and a rest; every token is placed once.  Pieces, largest first, go to the
bin with the least room that still takes them: bins are kept in order of
residual room, the search starts at the first bin with enough room and goes
on to its successors until one is compatible, else a bin is opened.

Compatible means: the bin holds no piece of the same duplicate cluster, and
fewer than ``per_source`` pieces of the same source.  Bins carry both as
bitmaps, one bit per (source, level) and one per cluster.

Spark writes the pieces with a number each and deals them out by a hash of it
into shards of about ``SHARD`` pieces, whatever their ids: null or repeated ids,
a hot source or a large cluster are spread evenly.  Each shard is packed by
itself, so work and memory per task are bounded at any input size.  Bins belong
to one shard, so the constraints hold globally.

Edge cases: a null doc_id, source or cluster is a value of its own for
source and never conflicts as cluster; a null or negative size counts as 0;
empty documents take a place of size 0 (at most ``length`` places a bin);
equal sizes are taken in order of doc_id and piece; repeated rows are each
packed (with a cluster, into different bins); an empty table gives no bins.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import importable, written

LENGTH = 2048
PER_SOURCE = 3
SHARD = 4096


def best_fit(size: list[int], source: list, cluster: list, length: int, per_source: int) -> tuple[list[int], list[int]]:
    """(bin, start) of each piece; pieces must come largest first."""
    sources = {s: k for k, s in enumerate(dict.fromkeys(source))}
    counts = pd.Series(cluster, dtype=object).dropna().value_counts()
    clusters = {c: k for k, c in enumerate(counts.index[counts > 1])}  # a cluster of one cannot conflict
    order: list[tuple[int, int]] = []                              # (residual room, bin), ascending
    has_source: list[int] = []
    has_cluster: list[int] = []
    bins, starts = [], []
    for n, s, c in zip(size, source, cluster, strict=True):
        levels = [1 << (sources[s] * per_source + k) for k in range(per_source)]
        mark = 1 << clusters[c] if c in clusters else 0
        at = bisect.bisect_left(order, (n, -1))
        while at < len(order):
            b = order[at][1]
            if not has_cluster[b] & mark and not has_source[b] & levels[-1]:
                break
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = length, len(has_source)
            has_source.append(0)
            has_cluster.append(0)
        bins.append(b)
        starts.append(length - room)
        bisect.insort(order, (room - n, b))
        has_cluster[b] |= mark
        has_source[b] |= next(x for x in levels if not has_source[b] & x)
    return bins, starts


def pieces(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, source, cluster, piece, n_tokens: each document cut at ``length``."""
    n = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long"), F.lit(0))
    last = F.greatest(F.ceil(n / length) - 1, F.lit(0)).cast("int")
    return (docs.select("doc_id", "source", "cluster", n.alias("n"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
            .select("doc_id", "source", "cluster", "piece",
                    F.least(F.lit(length), F.col("n") - F.col("piece") * length).cast("long").alias("n_tokens")))


def pack(docs: DataFrame, length: int = LENGTH, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """doc_id, piece, bin_id, start, n_tokens for rows (doc_id, source, cluster, n_tokens)."""
    importable(docs.sparkSession)
    cut = written(pieces(docs, length).withColumn("row", F.monotonically_increasing_id()), "pieces")   # numbers stay what they are
    shards = max(1, -(-cut.count() // shard))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece", "cluster", "row"], ascending=[False, True, True, True, True],
                              na_position="first", kind="stable")
        none = lambda v: [None if x is None or x != x else x for x in v]
        bins, starts = best_fit(pdf["n_tokens"].tolist(), none(pdf["source"]), none(pdf["cluster"]), length, per_source)
        first = int(pdf["shard"].iloc[0]) << 32
        return pd.DataFrame({"doc_id": pdf["doc_id"], "piece": pdf["piece"], "bin_id": np.array(bins, np.int64) + first,
                             "start": np.array(starts, np.int64), "n_tokens": pdf["n_tokens"]})

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(
        place, f"doc_id {kind}, piece int, bin_id long, start long, n_tokens long")

"""Token-count rollups, packing and nearest neighbours."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlog.llm import neighbours, packing, tokencounts
from loomlog.session import scratch_path

CHANGE = "doc_id long, op string, source string, lang string, tokenizer_version string, n_tokens long, seq int, note string"


def test_rollup_follows_a_plain_ledger(spark):
    rnd = random.Random(2)
    rollup = tokencounts.TokenRollup(spark, scratch_path(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    live, batches = {}, []
    for b in range(4):
        rows = [(rnd.choice([None, *range(12)]), rnd.choice(["insert", "delete", "revise"]), rnd.choice(["s", None]), rnd.choice(["en", "de"]),
                 rnd.choice(["v1", "v2"]), rnd.choice([None, 0, 5, 7]), k, "x") for k in range(10)]
        rows += rows[:2]                                           # repeated rows
        batches.append(rows)
        last = {}
        for r in rows:
            if r[0] not in last or r[6] >= last[r[0]][6]:
                last[r[0]] = r
        for i, op, *key, n, _, _ in last.values():
            if op == "insert" or op == "revise" and i in live:
                live[i] = (*key, n or 0)
            elif op == "delete":
                live.pop(i, None)
        assert rollup.commit(b, spark.createDataFrame(rows, CHANGE))
        want = defaultdict(lambda: [0, 0])
        for *key, n in live.values():
            want[tuple(key)][0] += 1
            want[tuple(key)][1] += n
        assert {tuple(r)[:3]: list(r)[3:] for r in rollup.totals().collect()} == dict(want)
    before = sorted(map(str, rollup.totals().collect()))
    assert not rollup.commit(1, spark.createDataFrame(batches[0], CHANGE))      # replays change nothing
    assert rollup.commit(9, spark.createDataFrame([], CHANGE))                  # an empty batch commits
    assert sorted(map(str, rollup.totals().collect())) == before and rollup.committed() == [0, 1, 2, 3, 9]


def test_an_uncommitted_batch_is_not_read(spark):
    rollup = tokencounts.TokenRollup(spark, scratch_path(spark, "rollup-test"))
    one = spark.createDataFrame([(1, "insert", "s", "en", "v", 3, 0, "")], CHANGE)
    rollup.commit(1, one)
    one.selectExpr("doc_id", "source", "lang", "tokenizer_version", "1L AS docs", "9L AS tokens").write.parquet(rollup._folder("ledger", 2))
    assert rollup.totals().first()["n_tokens"] == 3 and rollup.live().first()["tokens"] == 3
    assert rollup.commit(2, one.withColumn("n_tokens", F.lit(4)))               # its next attempt replaces it
    assert rollup.totals().first()["n_tokens"] == 4


def test_counts(spark):
    df = spark.createDataFrame([("a b\tc d",), ("A-b 3é",), ("",), (None,)], "t string")
    got = df.select(tokencounts.words_v1(F.col("t")), tokencounts.alnum_v2(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(3, 3), (2, 3), (0, 0), (0, 0)]


def check_bins(rows, out, length, per_source):
    sizes, by_doc = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r[0]] += max(r[3] or 0, 0)
    source, cluster = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    bins = defaultdict(list)
    for r in out:
        bins[r["bin_id"]].append(r)
        by_doc[r["doc_id"]].append(r["n_tokens"])
    assert {k: sum(v) for k, v in by_doc.items()} == dict(sizes)
    for inside in bins.values():
        at = 0
        for r in sorted(inside, key=lambda r: (r["start"], r["n_tokens"])):
            assert r["start"] == at
            at += r["n_tokens"]
        assert at <= length
        named = [cluster[r["doc_id"]] for r in inside if cluster[r["doc_id"]] is not None]
        assert len(named) == len(set(named))
        assert all(sum(source[r["doc_id"]] == s for r in inside) <= per_source for s in {source[r["doc_id"]] for r in inside})
    return len(bins)


def test_packing(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.choice(["hot", "hot", "a", "b", None]), rnd.choice([None, 7, 8, 1000 + k]), rnd.choice([None, 0, 1, 30, 99, 100, 101, 350, -4]))
            for k in range(400)] + [(9000, "long", 1, 12_345)]
    schema = "doc_id long, source string, cluster long, n_tokens long"
    for shard in (10**6, 64):
        out = packing.pack(spark.createDataFrame(rows, schema).repartition(4), 100, 2, shard).collect()
        check_bins(rows, out, 100, 2)
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "a", 5, 10)] * 2, schema)).collect()
    assert len({r["bin_id"] for r in twice}) == 2                  # copies never share a bin


def test_best_fit_against_plain_search():
    rnd = random.Random(6)
    size = sorted((rnd.randrange(1, 60) for _ in range(300)), reverse=True)
    source, cluster = [rnd.randrange(3) for _ in size], [rnd.choice([None, 1, 2, 3]) for _ in size]
    bins = []                                                     # [room, sources, clusters]
    want = []
    for n, s, c in zip(size, source, cluster):
        fit = [(b[0], k) for k, b in enumerate(bins) if b[0] >= n and b[1].count(s) < 2 and (c is None or c not in b[2])]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([60, [], []])
        bins[k][0] -= n
        bins[k][1].append(s)
        bins[k][2].append(c)
        want.append(k)
    assert packing.best_fit(size, source, cluster, 60, 2)[0] == want


def brute_nearest(rows, ask, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good[i] = max(good.get(i, v), v)
    out = {}
    for q in good:
        if ask(q):
            a = np.array(good[q])
            near = sorted((-float(a @ np.array(v) / np.linalg.norm(a) / np.linalg.norm(v)), i) for i, v in good.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    rows = [(int(k), [float(x) for x in rng.normal(size=8)]) for k in range(900)]
    rows += [(2000 + k, [1.0] * 8) for k in range(300)]            # one common vector
    rows += [(3000, None), (3050, [0.0] * 8), (3100, [1.0, None] * 4), (3150, [float("nan")] * 8), (3200, [1.0] * 3), (None, [1.0] * 8),
             (3250, [float("inf")] + [0.0] * 7), (3300, []), (50, rows[50][1]), (3350, [1e200] * 8), (3400, [1e-200] + [0.0] * 6 + [1e-200])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, v int").repartition(3)
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.col("id") % 50 == 0, block=64).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = brute_nearest([(i, v) for i, v in rows if v is None or not any(x and 0 < abs(x) < 1e-100 or x and abs(x) > 1e100 for x in v if x is not None)],
                         lambda q: q % 50 == 0)
    assert set(want) | {3350, 3400} == set(got)
    plain = [q for q in want if q < 900]
    near = np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 5 for q in plain])
    assert near >= 0.9
    for q in want:
        assert all(abs(s - dict(want[q])[i]) < 1e-12 for i, s in got[q] if i in dict(want[q]))
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        if q >= 2000 and q < 3000:
            assert all(s > 1 - 1e-12 for _, s in got[q])


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(k * 50, [1.0, float(k)]) for k in range(n)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") % 50 == 0).collect()
    assert len(got) == n * (n - 1)


def test_hilbert_visits_every_cell_once_in_steps_of_one():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = neighbours.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()

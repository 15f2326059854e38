"""A vector with many copies: equal scores go to the smaller ids."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from loomlog.llm import neighbours
from test_rollup_packing_neighbours import brute_nearest


def test_ids_of_a_hot_group(spark):
    rng = np.random.default_rng(3)
    common = [1.0, 2.0, -1.0, 0.5, 0.0, 3.0, -2.0, 1.0]
    rows = [(k, common if k % 3 == 1 else [float(x) for x in rng.normal(size=8)]) for k in range(900)]
    rows += [(1000 + k, rows[0][1]) for k in range(3)]             # fewer copies than k: others follow
    rows += [(1100, [2 * x for x in common])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("id") % 50 < 2, block=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = brute_nearest(rows, lambda q: q % 50 < 2)
    hot = [q for q in want if dict(rows)[q] == common]
    assert len(hot) > 10 and set(got) == set(want)
    for q in hot:
        assert [i for i, _ in got[q]] == [i for i in (1, 4, 7, 10, 13, 16) if i != q][:5]
    assert [i for i, _ in got[0]][:3] == [1000, 1001, 1002]
    assert [i for i, _ in got[1000]][:3] == [0, 1001, 1002]
    assert all(len(got[q]) == 5 for q in want)


def test_each_length_by_itself(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(x) for x in rng.normal(size=(4, 7)[k % 3 == 0])]) for k in range(300)]
    rows += [(1000, [1.0]), (1001, [-2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("id") % 50 == 0, block=64, reach=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert set(got) == {*range(0, 300, 50), 1000} and got[1000] == [1001]
    for query in range(0, 300, 50):
        same = [(i, np.array(v)) for i, v in rows if len(v) == len(rows[query][1]) and i != query]
        q = np.array(rows[query][1])
        best = sorted(same, key=lambda r: (-(r[1] @ q) / np.linalg.norm(r[1]) / np.linalg.norm(q), r[0]))[:5]
        assert got[query] == [i for i, _ in best]

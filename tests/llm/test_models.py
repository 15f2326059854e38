"""Language ID, quality classifier and LM scoring: held-out accuracy and edge cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomlog.llm import langid, mixing, quality, textbytes
from loomlog.llm.common import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD = [(-1, None, "en"), (-2, "", "en"), (-3, "... 123 \n", None), (-4, "é", "fr"), (-5, "the and of " * 100_000, "en"), (None, "the of and", None),
       (-7, "the", "en"), (-7, "the", "en"), (-8, "日本語", "ja")]


def with_odd(spark, docs):
    odd = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.unionByName(odd)


def test_language_on_held_out(spark, docs):
    held = fold(F.col("doc_id")) == 0
    trees = langid.freeze(langid.count_runs(docs.where(~held), "text", "lang"))
    got = langid.identify(with_odd(spark, docs), trees, held_out=held)
    joined = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert joined.agg(F.avg("ok")).first()[0] > 0.98
    by = {r["doc_id"]: r for r in got.where("doc_id < 0 OR doc_id IS NULL").collect()}
    assert [by[k]["lang_pred"] for k in (-1, -2, -3)] == ["und"] * 3 and by[-1]["score"] == 0
    assert by[-5]["lang_pred"] == "en" and by[None]["lang_pred"] == "en" and by[-8]["lang_pred"] in trees.langs
    assert all(0 <= r["score"] <= 1 for r in by.values())


def test_trees_are_distributions_with_exact_code_lengths(spark):
    rows = [("ababab", "x"), ("abc", "x"), ("xyxy", "y"), (None, "y"), ("zz", None)]
    df = spark.createDataFrame(rows, "t string, l string")
    trees = langid.freeze(langid.count_runs(df, "t", "l"))
    assert trees.langs == ["x", "y"]
    a = int(trees.symbol.max()) + 1
    p = np.exp2(trees.cost.astype(np.float64)).reshape(-1, a, 2)
    unseen = 256 - (a - 1)                                        # bytes that share symbol 0
    total = p[:, 1:].sum(1) + unseen * p[:, 0]
    assert np.allclose(total, 1, atol=1e-3)

    def bits(text, lang):                                         # PPM with exclusion, straight from the counts
        counts = {}
        for t, name in rows:
            if t and name == lang:
                b = bytes(3) + t.encode()
                for k in range(3, len(b)):
                    for n in range(4):
                        counts.setdefault(b[k - n:k], Counter())[b[k]] += 1

        def prob(context, s):
            c = counts.get(context)
            lower = (lambda v: 1 / 256) if context == b"" else (lambda v: prob(context[1:], v))
            if not c:
                return lower(s)
            n, d = sum(c.values()), len(c)
            return c[s] / (n + d) if s in c else d / (n + d) * lower(s) / (1 - sum(lower(v) for v in c))
        b = bytes(3) + text.encode()
        return -sum(math.log2(prob(b[k - 3:k], b[k])) for k in range(3, len(b)))
    for text in ("ab", "abx", "cab", "q", "xyxyab"):
        s = textbytes.Slice(0, 1, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert np.allclose(langid.code_lengths(trees, s)[0], [bits(text, "x"), bits(text, "y")], atol=1e-3)


def test_no_training_text(spark, docs):
    assert langid.freeze(langid.count_runs(docs.where("false"), "text", "lang")) is None
    assert {r["lang_pred"] for r in langid.identify(docs.limit(3), None).collect()} == {"und"}


def test_quality_on_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels, usable=lambda i: fold(i) != 0)
    scored = quality.score(with_odd(spark, docs), model, keep=["doc_id"])
    rows = scored.join(labels, "doc_id").where(fold(F.col("doc_id")) == 0).select("quality", "__score").collect()
    right = np.mean([(r["__score"] >= 0.3) == (r["quality"] == 1) for r in rows])
    assert right > 0.93
    odd = scored.where("doc_id < 0 OR doc_id IS NULL").collect()
    assert len(odd) == len(ODD) and all(0 <= r["__score"] <= 1 for r in odd)
    again = quality.train(docs.repartition(5), labels, usable=lambda i: fold(i) != 0)
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(model.weights, again.weights, strict=True))
    assert quality.score(docs.where("false"), model).count() == 0
    none = quality.train(docs, labels.where("false"))
    assert {r["__score"] for r in quality.score(docs.limit(2), none).collect()} == {0.5}
    assert quality.score(docs.withColumn("x", F.lit(1)).limit(2), none).columns == [*docs.columns, "x", "__score"]


def test_gradients():
    rng = np.random.default_rng(0)
    x, row, label = rng.normal(size=(9, 4)), np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([1.0, 0, 1, 0])
    w = [rng.normal(size=s) for s in ((4, 3), (3,), (3, 2), (3, 2), (2,), (4,))]
    loss = lambda: -np.mean(np.log(np.where(label == 1, p := quality._forward(w, x, row, 4)[0], 1 - p)))
    for k, g in enumerate(quality._gradients(w, x, row, label)):
        for at in np.ndindex(g.shape):
            w[k][at] += 1e-5
            up = loss()
            w[k][at] -= 2e-5
            assert abs((up - loss()) / 2e-5 - g[at]) < 1e-4
            w[k][at] += 1e-5


def test_lm_scores(spark, docs):
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    rows = with_odd(spark, docs)
    got = mixing.score(rows, held, common=3000).collect()
    word, small = re.compile(r"[^\x20\x09-\x0D]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = [(r["doc_id"], [*word.findall((r["text"] or "").translate(small)), None]) for r in rows.select("doc_id", "text").collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    n = Counter(w for i, ws in text if not out(i) for w in ws)
    total = sum(n.values())
    want = sorted((str(i), out(i), len(ws), sum(n[w] > 0 for w in ws), total,
                   round(sum(math.log10((n[w] + 0.5) / (total + 0.5 * (len(n) + 1))) for w in ws), 4)) for i, ws in text)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(s < 0 for s in score.values()) and score[-1] == score[-2]
    base, model = (sum(r[c] for r in got if r["held_out"]) for c in ("base_score", "score"))
    assert model > 1.25 * base                                     # spelling unknown words costs more than the base's flat rate
    assert np.mean([r["bits_per_byte"] for r in got if r["held_out"]]) < 3.2
    empty = mixing.score(rows.where("false"), held)
    assert empty.count() == 0
    untrained = mixing.score(rows.where("doc_id = -7"), F.lit(True)).collect()
    assert [r["train_tokens"] for r in untrained] == [0, 0]


def test_bit_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    tables = mixing.Tables(rng.integers(0, 5, (mixing.ORDER + 1, 1 << mixing.TABLE_BITS, 2)).astype(np.float32),
                           rng.integers(0, 5, (1 << mixing.WORD_BITS, 2)).astype(np.float32), mixing.word_nodes([b"abc", b"abd"]))
    centre = np.tile(np.linspace(-8, 8, mixing.BUCKETS), (mixing.N_GATES, 1))
    model = mixing.Model(tables, rng.normal(0.2, 0.1, (mixing.N_GATES, mixing.INPUTS)), centre)
    for node in (-1, 1):
        run = np.arange(256) | (0x6162 << 8)
        assert abs(np.exp2(model.log2(run, np.full(256, node))).sum() - 1) < 1e-3

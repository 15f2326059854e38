"""Rows that share an id, null ids and texts, whole training texts, clashing names."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomlog.llm import neardup, packing, quality, queries
from loomlog.llm import textbytes as B

A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
X = "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12 x13 x14 x15 x16 x17 x18 x19 x20 x21 x22 x23 x24 x25 x26 x27 x28 x29 x30"


@pytest.mark.parametrize("seed", range(2))
def test_rows_of_one_id_are_linked_by_their_own_text(spark, seed):
    rows = [(1, A), (1, X), (2, X + " x31"), (3, A), (5, X), (5, "nothing like it at all in here"), (4, "4"), (4, None), (4, "")]
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1 + seed)
    found = neardup.near_duplicates(docs)
    assert sorted((r.doc_id, r.component_id, r.kept, r.n_shingles) for r in found.collect()) == sorted([
        (1, 1, True, 12), (1, 1, True, 26), (2, 1, False, 27), (3, 1, False, 12), (5, 1, False, 26), (5, 5, True, 3), (4, 4, True, 1),
        (4, 4, True, 0), (4, 4, True, 0)])
    texts = {r.h: r.text for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    assert {(r.doc_id, texts[r.text_hash]) for r in found.where("kept").collect()} == {
        (1, A), (1, X), (5, "nothing like it at all in here"), (4, "4"), (4, None), (4, "")}


@pytest.mark.parametrize("seed", range(2))
def test_pipeline_keeps_documents_that_share_an_id(spark, seed):
    rows = [(1, A, "en", "s", 1), (1, X, "en", "s", 1), (2, X + " x31", "en", "s", 1), (1, A, "de", "s", 1), (5, X, "en", "s", 1),
            (5, "nothing like it", "en", "s", 1), (None, A, "en", "s", 1)]
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(1 + seed)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([
        (1, A, "de", "s", 1), (1, X, "en", "s", 1), (5, "nothing like it", "en", "s", 1), (None, A, "en", "s", 1)], key=str)


def test_null_and_repeated_ids_are_dealt_over_all_shards(spark):
    rows = [(None, f"s{k % 50}", None, 5) for k in range(3000)] + [(7, f"s{k % 50}", None, 5) for k in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, source string, cluster long, n_tokens long"), 100, 2, 512).collect()
    assert len(out) == 6000
    shards = Counter(r.bin_id >> 32 for r in out)
    assert len(shards) == 12 and max(shards.values()) < 2 * 512


def test_null_texts_are_no_duplicates_of_each_other(spark, tmp_path):
    rows = [(k, None, f"s{k}") for k in range(40)] + [(100 + k, "", f"s{k}") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op9(spark, str(tmp_path)).collect(), corpus_pipeline.pack(spark, docs, "").collect()):
        nulls, empty = [[r.bin_id for r in out if (r.doc_id < 100) == none] for none in (True, False)]
        assert len(set(nulls)) < 10 and len(set(empty)) == 10      # empty texts are copies: a bin each


def test_training_takes_whole_documents(spark):
    words = " ".join(f"w{k}" for k in range(48 * 100))             # 100 passages
    docs = spark.createDataFrame([(k, words if k % 2 else "b a d") for k in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    try:
        quality.fit = lambda x, row, label: seen.append((len(x), Counter(np.bincount(row).tolist()))) or fit(x, row, label)
        quality.train(docs, labels)
        quality.train(docs, labels, passages=250)
    finally:
        quality.fit = fit
    assert seen[0] == (606, Counter({100: 6, 1: 6}))
    assert seen[1][0] <= 250 and set(seen[1][1]) <= {1, 100} and seen[1][0] > 50      # as many whole ones as fit


def test_passages_counted_as_they_are_encoded(spark):
    import pyarrow as pa
    texts = [None, "", " \n\x0b\t", "a", " ".join("w" * 48), " ".join("w" * 49) + "\r", "x\x1cy " * 100]
    want = np.bincount(quality.encode(next(B.slices(pa.array(texts))))[1]).tolist()
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n = F.greatest(F.ceil(F.coalesce(words, F.lit(0)) / quality.PASSAGE), F.lit(1))
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", n.alias("n")).orderBy("k").collect()
    assert [r.n for r in rows] == want


def test_stages_with_clashing_names(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    plain = {name: stage(spark, docs, sf).orderBy("doc_id", "text").collect() for name, stage in corpus_pipeline.STAGES[:-1]}
    odd = ["n_hit", "n_words", "items", "spans", "__scan", "__score", "__host", "__pages", "__lines", "__kept", "__drop", "__p", "__t",
           "rest", "row", "id", "hash", "label", "kept", "component_id", "text_hash", "rep"]
    more = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(odd)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, sf)
        assert out.columns == more.columns
        assert out.orderBy("doc_id", "text").select(*docs.columns).collect() == plain[name]
        assert {tuple(r) for r in out.select(*odd).distinct().collect()} <= {tuple(range(len(odd)))}
    assert corpus_pipeline.pack(spark, more, sf).count() > 0

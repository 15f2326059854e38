"""The pipeline's stages, each against a brute-force version, and the query contract."""

import importlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontam import brute as brute_decontam
from test_linededup import brute as brute_lines
from test_neardup import brute as brute_near

SF = "/root/testdata/sf0.001"
ODD = [(-1, None, None, None, None), (-2, "", "en", "src0", 0), (None, "no id", "en", None, 5), (-3, "one two three four five six", "en", "src1", 27),
       (-3, "one two three four five six", "en", "src1", 27), (-4, "ONE two three four five six", "en", "src1", 27)]


@pytest.fixture(scope="module")
def docs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.unionByName(spark.createDataFrame(ODD, docs.schema)).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_and_their_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_quality_keeps_rows_as_they_are(spark, docs):
    kept = rows(corpus_pipeline.keep_quality(spark, docs, SF))
    every = rows(docs)
    assert set(kept) <= set(every) and 0.7 * len(every) < len(kept)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in every if labels.get(r[0]) == 1]
    assert sum(r in kept for r in good) > 0.95 * len(good)


def test_lines(spark, docs):
    got = corpus_pipeline.drop_lines(spark, docs, SF)
    want = brute_lines([(r["source"], r["text"]) for r in docs.collect()])
    assert sorted(((r["source"], r["text"]) for r in got.collect()), key=str) == sorted(((h, t) for h, _, t in want), key=str)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got.collect())


def test_near_duplicates(spark, docs):
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    kept = {i for i, _, _, keep in brute_near([(r["doc_id"], r["text"]) for r in docs.where("doc_id IS NOT NULL").collect()]) if keep}
    want = {r for r in rows(docs) if r[0] in kept or r[0] is None}
    assert rows(got) == sorted(want, key=str)


def test_decontamination(spark, docs):
    got = corpus_pipeline.drop_contaminated(spark, docs, SF)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    every = docs.collect()
    found = brute_decontam([(k, r["text"]) for k, r in enumerate(every)], bench)
    dirty = {r[0] for r in found if r[-1]}
    assert rows(got) == sorted((tuple(r) for k, r in enumerate(every) if k not in dirty), key=str)


def test_packing_places_every_word(spark, docs):
    out = corpus_pipeline.pack(spark, docs, SF)
    words = docs.select("doc_id", (F.coalesce(F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")), F.lit(0)) + 1).alias("n"))
    want = {r["doc_id"]: r["n"] for r in words.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    assert {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == want


def test_registered(spark):
    entry = importlib.import_module("__spark_entry__")
    names = list(entry.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert corpus_pipeline.run(spark, SF).count() > 0

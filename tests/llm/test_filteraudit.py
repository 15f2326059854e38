"""The incremental audit against a plain pass over all documents."""

import random
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from loomlog.llm import filteraudit as A
from loomlog.llm import queries
from loomlog.session import scratch_path

LONG = " ".join(f"w{k}" for k in range(220))
TEXTS = ["", None, LONG, LONG + " #", "AB c", "same same same same", LONG.replace(" ", " "), "x\x1cy\tz\x0bq", "ÄÖÜ Straße", "a|b", " " * 50,
         "long " * 30_000, "İI" * 300]
ROW = "doc_id long, text string, lang string, source string, mask int, n long, digest string"


def fails(text: str) -> dict[str, bool]:
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text)}


def brute(docs, labels):
    """{(part, order, step): numbers} by running every order over every document."""
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, lang, *_ in docs:
        f = fails(text or "") | {"E": i is not None and i > least[text or ""]}
        parts[lang or ""].append((f, i in good, i in toxic))
    out, shapley = {}, defaultdict(int)
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                earlier = [any(f[y] for y in order[:k]) for f, _, _ in rows]
                gone = [f[x] and not e for (f, _, _), e in zip(rows, earlier, strict=True)]
                out[part, "".join(order), k + 1] = [
                    sum(not f[x] and not e for (f, _, _), e in zip(rows, earlier, strict=True)), sum(gone),
                    sum(f[x] and e for (f, _, _), e in zip(rows, earlier, strict=True)),
                    sum(f[x] and sum(f.values()) == 1 for f, _, _ in rows),
                    sum(g and r[1] for g, r in zip(gone, rows, strict=True)), sum(g and r[2] for g, r in zip(gone, rows, strict=True)), (part, x)]
                shapley[part, x] += sum(gone)
    return {key: (*v[:-1], shapley[v[-1]]) for key, v in out.items()}


def reported(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in rows}
    assert len(got) == len(rows)
    return got


def some_docs(seed: int, n: int = 90):
    rnd = random.Random(seed)
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(TEXTS), rnd.choice(["en", "de", "", None]), "s", 1, 2, "x") for _ in range(n)]
    docs += docs[:5]                                               # repeated rows
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None]), "m") for _ in range(50)]
    return docs, labels


@pytest.fixture
def label_frame(spark):
    return lambda labels: spark.createDataFrame(labels, "doc_id long, quality int, toxic int, mask string")


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order(spark, workdir, label_frame, seed):
    docs, labels = some_docs(seed)
    docs.sort(key=lambda r: -(r[0] or 0))                          # larger ids come first: places are retracted later
    src = f"{workdir}/docs"
    for k in range(6):
        spark.createDataFrame(docs[k::6] if seed == 1 else docs[16 * k:16 * (k + 1)], ROW).coalesce(1).write.mode("append").parquet(src)
    audit = A.FilterAudit(spark, scratch_path(spark, "audit"))
    audit.process(src, label_frame([r[:4] for r in labels]), batches=6)
    want = brute([r[:3] for r in docs], [r[:3] for r in labels])
    assert reported(audit.report()) == want
    logged = spark.read.parquet(f"{audit.folder}/counters")
    assert logged.select("batch").distinct().count() == 6 and logged.where("n < 0").count() > 0
    again = A.FilterAudit(spark, scratch_path(spark, "audit"))     # all files in one batch give the same
    again.process(src, label_frame([r[:4] for r in labels]), batches=None)
    assert reported(again.report()) == want


def test_goes_on_with_new_files_and_replays(spark, workdir, label_frame):
    docs, labels = some_docs(7)
    src, folder = f"{workdir}/docs", scratch_path(spark, "audit")
    frame = label_frame(labels)
    spark.createDataFrame(docs[40:], ROW).coalesce(1).write.parquet(src)
    A.FilterAudit(spark, folder).process(src, frame)
    spark.createDataFrame(docs[:40], ROW).coalesce(1).write.mode("append").parquet(src)
    audit = A.FilterAudit(spark, folder)
    audit.process(src, frame)
    audit.process(src, frame)                                      # nothing new
    want = brute([r[:3] for r in docs], [r[:3] for r in labels])
    assert reported(audit.report()) == want
    # the last batch once more, as after a crash before its commit
    per_doc = frame.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(o) for c, o in (("quality", "good"), ("toxic", "toxic"))])
    audit.take(A.masked(spark.createDataFrame(docs[:40], ROW)), per_doc, 1)
    assert reported(audit.report()) == want


def test_a_hot_text_over_many_files(spark, workdir, label_frame):
    docs = [(k, "the same" if k % 3 else f"{k} words", "en", "s", 1, 2, "x") for k in range(600, 0, -1)]
    src = f"{workdir}/docs"
    spark.createDataFrame(docs, ROW).repartition(8).write.parquet(src)
    audit = A.FilterAudit(spark, scratch_path(spark, "audit"))
    audit.process(src, label_frame([]))
    assert reported(audit.report()) == brute([r[:3] for r in docs], [])
    most = spark.read.parquet(f"{audit.folder}/state").groupBy("digest").count().agg(F.max("count")).first()[0]
    assert most <= A.BATCHES                                       # one state row per batch at most


def test_no_documents(spark, workdir, label_frame):
    spark.createDataFrame([], ROW).write.parquet(f"{workdir}/docs")
    audit = A.FilterAudit(spark, scratch_path(spark, "audit"))
    audit.process(f"{workdir}/docs", label_frame([]))
    assert audit.report().collect() == [] and A.FilterAudit(spark, scratch_path(spark, "audit")).report().collect() == []


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = queries.REGISTRY["op12_filter_audit"][0](spark, sf)
    assert reported(got) == brute(docs, labels)

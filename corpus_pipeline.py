"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``:

1. quality: documents that the attention classifier rejects go;
2. lines: boilerplate lines of a source (its site here) are taken out of the
   texts, and passages (lines of over 50 words) on four documents or more of
   the whole corpus out of all but one; every document stays, its text and n_chars are the cleaned ones;
3. near_duplicates: one document of each group (Jaccard 0.8 or more) stays;
4. decontamination: documents with too much benchmark text go;
5. packing: the rest as pieces in training sequences.

All but the last return the columns of ``documents``.

Edge rows: a null or empty text is scored, has no lines, is near nothing, is
clean and packs as its end token; a null id stays where ids decide (it is no
copy of anything) and its text is judged like any other; a null source is a site
of its own; of rows that repeat a kept (id, text) the smallest stays, while rows
of one id with different texts are documents of their own; equal rows tie by all
their columns; empty tables pass through all stages; other columns, whatever
their names, travel untouched.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.llm import decontam, linededup, neardup, packing, quality, tokencounts
from loomlog.llm.common import fold, table, written

REJECT_BELOW = 0.3
NEAR_PERCENT = 80                    # of the near_duplicates stage; op3's own contract is 85


def _carried(docs: DataFrame, *read: str) -> DataFrame:
    """The columns a stage reads, and all others as one struct ``rest``: whatever
    they are called, they meet no name of an operator."""
    rest = [c for c in docs.columns if c not in read]
    return docs.select(*read, F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_")).alias("rest"))


def _restored(rows: DataFrame, docs: DataFrame, *read: str, **changed) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    return rows.select(*[changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed
                         else F.col(c) if c in read else F.col("rest").getField(c).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), usable=lambda i: fold(i) != 0)
    scored = quality.score(_carried(docs, "text"), model)
    return _restored(scored.where(F.col("__score") >= REJECT_BELOW), docs, "text")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.drop_boilerplate(_carried(docs, "doc_id", "source", "text"), F.col("source"), F.col("text"))
    out = out.select("doc_id", "source", F.array_join("__kept", "\n").alias("text"), "rest")
    out = linededup.drop_passages(written(out, "site-lines"), "doc_id", "text")
    return _restored(out, docs, "doc_id", "source", "text", n_chars=F.length("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = neardup.PERCENT) -> DataFrame:
    found = neardup.near_duplicates(docs.select("doc_id", "text"), percent=percent).where("kept AND doc_id IS NOT NULL")
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.join(found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct(), ["id", "hash"], "left_semi")
    once = rows.groupBy("id", "hash").agg(F.min("row").alias("row")).select("row.*")
    return once.unionByName(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanned = decontam.scan(_carried(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _restored(scanned.where(~decontam.contaminated()), docs, "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sized = docs.select("doc_id", "source", (tokencounts.words_v1(F.col("text")) + 1).alias("n_tokens"),
                        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cluster"))
    return packing.pack(written(sized, "sized"))


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_duplicates", partial(drop_near_duplicates, percent=NEAR_PERCENT)),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier, Jaccard links and a best-fit search have no SQL form;
#: tests/llm/test_pipeline.py holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

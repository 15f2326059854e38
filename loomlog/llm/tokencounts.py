"""Token counts as delta-maintained rollups.

A rollup folder holds, per committed batch, the signed ledger rows of that
batch (one per document and count that appears or disappears) and their sums
by (source, lang, tokenizer_version).  Totals are the sums over committed
batches, so inserts, deletes and revised counts are additive and no batch
rereads old text.

    path/ledger/batch=<id>   doc_id, source, lang, tokenizer_version, docs +-1, tokens +-n
    path/totals/batch=<id>   source, lang, tokenizer_version, docs, tokens

A batch is committed when its totals folder holds ``_SUCCESS``.  Committing
an id again is a no-op, whatever its rows; a batch that failed half-way is
overwritten by its next attempt, and its ledger is not read until committed.

Changes are rows (doc_id, op, source, lang, tokenizer_version, n_tokens, seq)
with op ``insert``, ``delete`` or ``revise``.  Of several changes to one
document in a batch the last by ``seq`` counts (then the largest row), so
repeated rows change nothing.  ``insert`` replaces a live count; ``delete``
and ``revise`` of a document that is not live do nothing.  Null keys are
values of their own (all rows with a null doc_id are one document); a null
n_tokens counts as 0; an empty batch commits and changes nothing.

All steps are aggregates and one join on doc_id; a hot source is
pre-aggregated by each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ["source", "lang", "tokenizer_version"]
ENTRY = "doc_id long, source string, lang string, tokenizer_version string, docs long, tokens long"
TOTAL = "source string, lang string, tokenizer_version string, docs long, tokens long"

#: tokenizer versions and the expression each counts with
WORDS_V1 = r"[^\x20\x09-\x0D]+"
ALNUM_V2 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_v1(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS_V1)), F.lit(0)).cast("long")


def alnum_v2(text: Column) -> Column:
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_count(small, F.lit(ALNUM_V2)), F.lit(0)).cast("long")


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={int(batch)}"

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p))

    def committed(self) -> list[int]:
        """Ids of committed batches, ascending."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals/batch=*/_SUCCESS")
        found = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
        return sorted(int(str(x.getPath().getParent().getName()).split("=")[1]) for x in found)

    def _read(self, kind: str, schema: str) -> DataFrame:
        done = self.committed()
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._folder(kind, b) for b in done])

    def live(self) -> DataFrame:
        """The counts that stand: one row per live document."""
        return (self._read("ledger", ENTRY).groupBy("doc_id", *KEY)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs > 0"))

    def totals(self) -> DataFrame:
        return (self._read("totals", TOTAL).groupBy(*KEY)
                .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0"))

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply one batch; False if this id was committed before."""
        if self._exists(f"{self._folder('totals', batch)}/_SUCCESS"):
            return False
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        new = changes.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.struct(
            seq.alias("seq"), "op", *KEY, F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("tokens"))).alias("c"))
        new = new.select("doc_id", "c.op", *[f"c.{k}" for k in KEY], "c.tokens")
        if self.committed():
            old = self.live().select(F.col("doc_id").alias("old_id"), *[F.col(k).alias(f"old_{k}") for k in KEY],
                                     F.col("docs").alias("old_docs"), F.col("tokens").alias("old_tokens"))
            both = new.join(old, F.col("doc_id").eqNullSafe(F.col("old_id")), "left")
        else:                                                      # nothing can be live yet
            both = new.withColumns({"old_docs": F.lit(None).cast("long"), "old_tokens": F.lit(None).cast("long"),
                                    **{f"old_{k}": F.lit(None).cast("string") for k in KEY}})
        gone = F.when(F.col("old_docs").isNotNull(), F.struct(
            *[F.col(f"old_{k}").alias(k) for k in KEY], (-F.col("old_docs")).alias("docs"), (-F.col("old_tokens")).alias("tokens")))
        comes = F.when((F.col("op") == "insert") | ((F.col("op") == "revise") & F.col("old_docs").isNotNull()), F.struct(
            *KEY, F.lit(1).cast("long").alias("docs"), F.col("tokens")))
        rows = (both.select("doc_id", F.explode(F.array(gone, comes)).alias("e")).where("e IS NOT NULL")
                .select("doc_id", "e.*"))
        rows.write.mode("overwrite").parquet(self._folder("ledger", batch))
        ledger = self.spark.read.schema(ENTRY).parquet(self._folder("ledger", batch))
        (ledger.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(self._folder("totals", batch)))
        return True

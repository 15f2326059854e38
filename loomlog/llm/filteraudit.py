"""What each of five filters removes, in every order, as an incremental job.

The filters: A too few words, B too repetitive, C too many capitals, D marks,
E a copy of a smaller id's text anywhere in the table.  A document's outcome
under any order follows from the set of filters it fails (its mask), so the
audit keeps counters of documents by (part, mask, labels) and derives all 120
orders from them.

A to D depend on the text alone; E depends on documents that may not have
come yet.  Files are processed as available-now micro-batches of a file
stream.  Of each batch

1. every row is counted as failing E (aggregated before the shuffle);
2. each distinct text's smallest id in the batch is looked up in the keyed
   state (text digest -> smallest id so far).  A new or smaller id passes E:
   its own count is taken back and put down without E, and the rows that held
   the place so far are retracted: their count without E goes, one with E
   comes.  Rows that share the smallest id share the place.

State and counters are signed change logs, one folder per batch, so a text of
the state is one row per batch that lowered its minimum.  A batch reads the
folders of the batches before it and overwrites its own: when a batch is
replayed after a failure, it does the same again.  Progress is the stream's
checkpoint beside them; ``FilterAudit`` on the same folder goes on with files
it has not seen.  Only digests, ids and masks are kept or shuffled, never
texts; a text held by a third of all rows is one row per task after the first
aggregation by (digest, id).

Edge cases: null text counts as empty (fails A); a null part is the empty
string; a null id is smaller than nothing and nothing is smaller than it, so
it neither fails E nor makes others fail; rows repeated with their id do not
make each other fail; a document is good (toxic) if any of its label rows says
so; an empty table gives an empty report; documents and labels may hold any
other columns, of any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.llm.common import importable
from loomlog.session import drop_scratch, scratch_path

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
BATCHES = 4                          # micro-batches a folder of files is dealt into, at any size

_CAPITALS = bytes(range(0x41, 0x5B))
_INNER = bytes(range(0x80, 0xC0))    # UTF-8 bytes that begin no character
_MARKS = b"#$%&*|"

MASKED = "doc_id long, part string, mask int, digest binary"
CHANGES = "part string, mask int, good int, toxic int, n long"
HELD = "array<struct<part:string,good:int,toxic:int,n:bigint>>"
STATE = f"digest binary, doc_id long, mask int, held {HELD}, went {HELD}"


def own_mask(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()                                           # ASCII white space only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * capitals > 3 * len(text.translate(None, _INNER)), len(text.translate(None, _MARKS)) < len(text))
    return sum(1 << k for k, f in enumerate(fails) if f)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).cast(pa.large_string()).cast(pa.large_binary())
        masks, digests = [], []
        for text in texts:
            raw = text.as_py() or b""
            masks.append(own_mask(raw))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "part", "mask", "digest"])


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask of A to D, digest of the text) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(_masks, MASKED)


def _signed(rows: DataFrame, mask: Column, n: Column) -> DataFrame:
    return rows.select("part", mask.alias("mask"), "good", "toxic", n.alias("n"))


class FilterAudit:
    """Counters of a growing folder of documents, kept under ``folder`` (shared by the cluster)."""

    def __init__(self, spark: SparkSession, folder: str):
        importable(spark)
        self.spark, self.folder = spark, folder.rstrip("/")

    def process(self, path: str, labels: DataFrame, batches: int | None = BATCHES, schema=None) -> None:
        """Take in the Parquet files under ``path`` that are new, as micro-batches
        (``batches`` of about equal file numbers; None: one for all)."""
        files = self.spark.read.parquet(path)
        reader = self.spark.readStream.schema(schema or files.schema)
        if batches:
            reader = reader.option("maxFilesPerTrigger", max(1, -(-len(files.inputFiles()) // batches)))
        per_doc = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("of")).agg(
            *[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(out)
              for c, out in (("quality", "good"), ("toxic", "toxic"))])
        if not self._fs(path)[0].getFileStatus(self._fs(path)[1]).isDirectory():   # a stream reads folders
            path, name = path.rsplit("/", 1)
            reader = reader.option("pathGlobFilter", name)
        query = (masked(reader.parquet(path)).writeStream.trigger(availableNow=True)
                 .option("checkpointLocation", f"{self.folder}/checkpoint")
                 .foreachBatch(lambda rows, k: self.take(rows, per_doc, k)).start())
        query.awaitTermination()
        if query.exception():
            raise query.exception()

    # ------------------------------------------------------------ one batch

    def _log(self, kind: str, schema: str, before: int | None = None) -> DataFrame:
        """The change log, or its folders of the batches before one."""
        log = self.spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.folder}/{kind}")
        seen = log.parquet(f"{self.folder}/{kind}") if self._any(kind) else self.spark.createDataFrame([], f"{schema}, batch long")
        return (seen if before is None else seen.where(F.col("batch") < before)).drop("batch")

    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _any(self, kind: str) -> bool:
        fs, at = self._fs(f"{self.folder}/{kind}")
        return fs.exists(at)

    def _write(self, rows: DataFrame, kind: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={batch}")

    def take(self, rows: DataFrame, per_doc: DataFrame, batch: int) -> None:
        """One micro-batch: ``rows`` of ``masked``, labels one row per document."""
        path = scratch_path(self.spark, "audited-rows")            # masks are needed twice
        rows.join(per_doc, rows["doc_id"] == per_doc["of"], "left").select(
            "doc_id", "part", "mask", "digest", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]).write.parquet(path)
        rows = self.spark.read.schema(f"{MASKED}, good int, toxic int").parquet(path)
        apart = F.col("doc_id").isNull().alias("apart")
        counted = rows.groupBy("part", "mask", "good", "toxic", apart).agg(F.count(F.lit(1)).alias("n"))
        everything = _signed(counted, F.when(F.col("apart"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(COPY)), F.col("n"))

        # the rows of each text's smallest id in this batch, as (part, labels, count) entries
        same = rows.where(F.col("doc_id").isNotNull()).groupBy("digest", "doc_id", "mask", "part", "good", "toxic").agg(
            F.count(F.lit(1)).alias("n"))
        same = same.groupBy("digest", "doc_id", "mask").agg(F.collect_list(F.struct("part", "good", "toxic", "n")).alias("held"))
        least = same.groupBy("digest").agg(F.min(F.struct("doc_id", "mask", "held")).alias("new"))
        log = self._log("state", STATE, batch)
        both = least.select("digest", "new", F.lit(None).cast(f"struct<doc_id:bigint,held:{HELD}>").alias("old")).unionByName(
            log.select("digest", F.lit(None).cast(least.schema["new"].dataType).alias("new"), F.struct("doc_id", "held").alias("old")))
        # a text has one new row and at most one old row per earlier batch
        met = both.groupBy("digest").agg(F.max("new").alias("new"), F.collect_list("old").alias("old")).where("new IS NOT NULL")
        met = met.withColumn("least", F.array_min(F.transform("old", lambda o: o["doc_id"])))
        passing = met.where(F.col("least").isNull() | (F.col("new.doc_id") <= F.col("least")))
        held_so_far = F.flatten(F.transform(F.filter("old", lambda o: o["doc_id"] == F.col("least")), lambda o: o["held"]))
        self._write(passing.select("digest", "new.doc_id", "new.mask", "new.held", F.when(
            F.col("new.doc_id") < F.col("least"), held_so_far).alias("went")), "state", batch)
        changes = self.spark.read.schema(STATE).parquet(f"{self.folder}/state/batch={batch}")

        def entries(column: str, sign: int) -> DataFrame:
            one = changes.select("mask", F.explode(column).alias("e")).select("mask", "e.*")
            return _signed(one, F.col("mask"), F.col("n") * sign).unionByName(
                _signed(one, F.col("mask").bitwiseOR(COPY), F.col("n") * -sign))

        deltas = everything.unionByName(entries("held", 1)).unionByName(entries("went", -1))
        total = deltas.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
        self._write(total.coalesce(1), "counters", batch)
        drop_scratch(self.spark, path)

    # ------------------------------------------------------------ results

    def counters(self) -> DataFrame:
        """Documents by (part, mask, good, toxic) after all batches."""
        return self._log("counters", CHANGES).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")

    def report(self) -> DataFrame:
        return report(self.counters())


def orders() -> Column:
    """Every order of the filters and step in it, as an array of structs: its filter's bit and those of the filters before."""
    steps = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(f) for f in order]
        steps += [F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bits[k]).alias("bit"),
                           F.lit(sum(bits[:k])).alias("before")) for k in range(len(bits))]
    return F.array(*steps)


def report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step, zeros included."""
    at = counters.select("*", F.explode(orders()).alias("s")).select("part", "mask", "good", "toxic", "n", "s.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    out = at.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~earlier & (F.col("toxic") == 1)).alias("toxic_lost"))
    each = Window.partitionBy("part", "bit")                       # 120 rows
    return out.withColumn("shapley", F.sum("removed").over(each)).drop("bit")

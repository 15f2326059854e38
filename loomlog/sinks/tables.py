"""Keyed tables on Parquet.

Parquet has no upsert, so a keyed table keeps exactly one row per key and
every write merges, one partition at a time:

* hourly table (K3/K4): partitioned by (date_utc, hour_utc), files sorted
  by (created_at, ev_id);
* default event table (K1/K2) and (id, type) table (K9): partitioned by id
  block (ids grow with time, so an import touches the newest blocks only);
* any other key, the table by type and tables that change together:
  ``sinks.snapshots``, files by key range.

A merge (``upsert_partitioned``) stages the deduplicated batch, takes the
bounds of its partition values as literal predicates on the table (so the
scan lists only partitions in that range, whatever the batch was made of),
narrows them exactly with a semi join, drops the old rows whose key comes
again (anti join) and writes old + new back with dynamic partition
overwrite.  Only the batch is aggregated: old rows are unique already.
Other partitions are neither read nor written.

Rows whose key or partition value is null have no place in a keyed table.
By default they fail the write; with ``rejects`` they are appended there
(JSON lines) and the rest is written.  So no row vanishes, and no row can
reach the null partition.

Crashes: a failed task or job leaves the table as it was (new files wait in
the job's staging folder).  A driver lost inside the final commit, which
replaces one touched partition after the other, can leave some of them new
and some old; every partition is whole, and running the same import again
completes it, since an import is idempotent.

One row per key is chosen with a grouped ``max(struct(columns…))``: the
largest row of the batch wins, so the choice does not depend on task order;
a key repeated a billion times shuffles one row per map task.  That shuffle
carries the batch's rows at the session's ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.session import drop_scratch, input_partitions, scratch_path


# ---------------------------------------------------------------- filesystem

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table by name, or a table folder by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def partitions_present(spark: SparkSession, path: str, wanted: DataFrame, column: str) -> DataFrame:
    """S11/A8 for many values at once: ``wanted(column)`` with ``exists``,
    whether the table folder has rows in that partition."""
    if not table_exists(spark, path):
        return wanted.select(column, F.lit(False).alias("exists"))
    have = spark.read.parquet(path).select(F.col(column).alias("_have")).distinct()
    return wanted.join(have, wanted[column] == have["_have"], "left").select(
        column, F.col("_have").isNotNull().alias("exists"))


# ------------------------------------------------------------------ rejects

def split_rejects(df: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every ``needed`` column, rows with a null in one of them)."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    return df.where(~bad), df.where(bad)


def _checked(df: DataFrame, needed: Sequence[str], rejects: str | None) -> DataFrame:
    """Rows that may be written: others are appended to ``rejects``, or fail the job."""
    if rejects is not None:
        good, bad = split_rejects(df, needed)
        bad.write.mode("append").json(rejects)
        return good
    return df.select(*[F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in key column {c}")))
                       .otherwise(F.col(c)).alias(c) if c in needed else F.col(c) for c in df.columns])


# ------------------------------------------------------------------- upsert

def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep one row per key: the largest (all non-key columns, descending)."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    best = F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)])).alias("_best")
    return df.groupBy(*key).agg(best).select(
        *key, *[F.col(f"_best._{i}").alias(c) for i, c in enumerate(rest)])


def write_tasks(df: DataFrame) -> int:
    """Number of write tasks: one per input split's worth of bytes read by
    ``df`` (``session.input_partitions``).  Given explicitly, so AQE does
    not fold a write into hundreds of hour folders into a few tasks."""
    return input_partitions(df)


def _layout(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    # Range partitioning on partition + clustering keys: a hot partition
    # value is cut into several tasks by the sampled bounds, and every file
    # holds a contiguous, sorted slice of the clustering order.
    keys = list(partition_by) + [c for c in cluster_by if c not in partition_by]
    return df.repartitionByRange(write_tasks(df), *keys).sortWithinPartitions(*keys)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like``; a table without
    rows (no file to infer from) reads as empty."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def upsert_partitioned(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str],
                       partition_by: Sequence[str], cluster_by: Sequence[str],
                       rejects: str | None = None) -> DataFrame:
    """Create-or-merge a table partitioned by ``partition_by`` (a function
    of ``key``), files sorted by ``cluster_by``; see the module doc.
    Returns a fresh read."""
    key, partition_by, cluster_by = list(key), list(partition_by), list(cluster_by)
    cols = df.columns
    rows = _checked(df, list(dict.fromkeys(key + partition_by)), rejects)
    if not path_exists(spark, path):
        (_layout(one_row_per_key(rows, key).select(*cols), partition_by, cluster_by)
         .write.mode("errorifexists").partitionBy(*partition_by).parquet(path))
        return read_table(spark, path, df)
    staged = scratch_path(spark, "batch")
    one_row_per_key(rows, key).select(*cols).write.parquet(staged)
    try:
        new = spark.read.schema(df.schema).parquet(staged).select(*cols)
        bounds = new.agg(*[f(c).alias(f"{n}_{c}") for c in partition_by for n, f in (("lo", F.min), ("hi", F.max))]).first()
        if bounds[0] is None:                                  # an empty batch
            return read_table(spark, path, df)
        old = read_table(spark, path, df)
        for c in partition_by:
            old = old.where(F.col(c).between(F.lit(bounds[f"lo_{c}"]), F.lit(bounds[f"hi_{c}"])))
        old = old.join(new.select(*partition_by).distinct(), partition_by, "left_semi")
        # a table key holds no null, so an equality anti join is exact
        kept = old.join(new.select(*key), key, "left_anti").select(*cols)
        (_layout(kept.unionByName(new), partition_by, cluster_by)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
    finally:
        drop_scratch(spark, staged)
    return read_table(spark, path, df)


def upsert_hourly(spark: SparkSession, df: DataFrame, path: str,
                  key: Sequence[str] | None = None, rejects: str | None = None) -> DataFrame:
    """K3/K4/K5: the hourly table keyed ((date_utc, hour_utc), created_at,
    ev_id): partitioned by (date_utc, hour_utc), files sorted by
    (created_at, ev_id).  Creates it when absent, otherwise rewrites only
    the touched hours.  Returns a fresh read of the table."""
    key = list(key or (S.HOURLY_PARTITION + S.HOURLY_CLUSTERING))
    rows = df.select(*S.EVENT_LOG_COLUMNS)                       # K3: chosen columns
    return upsert_partitioned(spark, rows, path, key, S.HOURLY_PARTITION, S.HOURLY_CLUSTERING, rejects)


def _id_block(column: str, block: int):
    return F.floor(F.col(column) / F.lit(block)).cast("bigint")


def upsert_events_by_id(spark: SparkSession, df: DataFrame, path: str,
                        block: int = S.ID_BLOCK_SIZE, rejects: str | None = None) -> DataFrame:
    """K1/K2: the default event table, one row per ``ev_id``.  Event ids
    grow with time, so the table is partitioned by ``id_block =
    ev_id div block``: a new import touches only the newest blocks and
    rewrites just those.  Returns a fresh read (with the ``id_block`` column)."""
    rows = df.select(*S.EVENT_LOG_COLUMNS).withColumn("id_block", _id_block("ev_id", block))
    return upsert_partitioned(spark, rows, path, ["id_block", "ev_id"], ["id_block"], ["ev_id"], rejects)


def upsert_by_id_block(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str],
                       block: int = S.ID_BLOCK_SIZE, rejects: str | None = None) -> DataFrame:
    """K9: a composite key that starts with a numeric id, partitioned by its block."""
    rows = df.withColumn("id_block", _id_block(key[0], block))
    return upsert_partitioned(spark, rows, path, ["id_block", *key], ["id_block"], key, rejects).drop("id_block")


def import_event_log(spark: SparkSession, event_log: DataFrame, table_path: str,
                     rejects: str | None = None) -> tuple[DataFrame, DataFrame]:
    """L1/K7: one input, two tables (default by ev_id, hourly).  The input
    is persisted once for both writes and released afterwards.  A row that
    either table cannot key goes to ``rejects`` once and into neither."""
    cached = event_log.persist()
    try:
        needed = ["ev_id", *S.HOURLY_PARTITION, "created_at"]
        rows = _checked(cached, needed, rejects).select(*S.EVENT_LOG_COLUMNS)
        default = upsert_events_by_id(spark, rows, table_path)
        hourly = upsert_hourly(spark, rows, table_path + S.HOURLY_SUFFIX)
    finally:
        cached.unpersist()
    return default, hourly


def ingest_with_stats(spark: SparkSession, event_log: DataFrame, path: str,
                      rejects: str | None = None) -> DataFrame:
    """Batch import into the hourly table with statistics: records
    (counted on the write itself through an Observation), seconds and
    records per second."""
    obs = Observation("ingest")
    observed = event_log.observe(obs, F.count(F.lit(1)).alias("records"))
    start = time.time()
    upsert_hourly(spark, observed, path, rejects=rejects)
    seconds = time.time() - start
    records = int(obs.get["records"])
    rate = records / seconds if seconds > 0 else float("nan")
    return spark.createDataFrame([(records, float(seconds), float(rate))],
                                 "records bigint, seconds double, records_per_second double")

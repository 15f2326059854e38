"""Keyed tables: create, upsert, idempotence, hourly layout."""

import glob
import os

from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.plans import corpora as C
from loomlog.sinks import snapshots, tables

SF = "/root/testdata/sf0.001"


def test_upsert_default_and_idempotence(spark, workdir):
    e = C.event_log(spark, SF)
    path = f"{workdir}/logs"
    assert not tables.table_exists(spark, path)
    t1 = snapshots.upsert_table(spark, e, path, ["ev_id"])
    assert tables.table_exists(spark, path)
    n = e.count()
    assert t1.count() == n
    t2 = snapshots.upsert_table(spark, e, path, ["ev_id"])          # same import again
    assert t2.count() == n and t2.exceptAll(e.select(*t2.columns)).count() == 0
    changed = e.limit(5).withColumn("repo", F.lit("changed"))
    t3 = snapshots.upsert_table(spark, changed, path, ["ev_id"])
    assert t3.count() == n and t3.where("repo = 'changed'").count() == 5


def test_duplicate_keys_in_one_batch_pick_stably(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, type string")
    t = snapshots.upsert_table(spark, df, f"{workdir}/dups", ["id"])
    assert sorted(tuple(r) for r in t.collect()) == [(1, "b"), (2, "c")]


def test_composite_key(spark, workdir):
    df = spark.createDataFrame([(1, "Push"), (1, "Create"), (2, "Push")], "id long, type string")
    path = f"{workdir}/id_type"
    snapshots.upsert_table(spark, df, path, ["id", "type"])
    t = snapshots.upsert_table(spark, df.union(spark.createDataFrame([(2, "Fork")], df.schema)),
                            path, ["id", "type"])
    assert t.count() == 4


def test_hourly_upsert_touches_only_its_hours(spark, workdir):
    e = C.event_log(spark, SF)
    path = f"{workdir}/logs" + S.HOURLY_SUFFIX
    t = tables.upsert_hourly(spark, e, path)
    n = e.count()
    assert t.count() == n
    parts = sorted(glob.glob(f"{path}/date_utc=*/hour_utc=*"))
    before = {p: sorted(os.listdir(p)) for p in parts}
    day, hour = "20240102Z", 5
    batch = e.where((F.col("date_utc") == day) & (F.col("hour_utc") == hour)) \
        .withColumn("repo", F.lit("v2"))
    t2 = tables.upsert_hourly(spark, batch, path)
    assert t2.count() == n
    assert t2.where("repo = 'v2'").count() == batch.count() > 0
    after = {p: sorted(os.listdir(p)) for p in parts}
    changed = [p for p in parts if before[p] != after[p]]
    assert changed == [f"{path}/date_utc={day}/hour_utc={hour}"]
    # again: idempotent
    assert tables.upsert_hourly(spark, batch, path).count() == n


def test_ingest_stats(spark, workdir):
    e = C.event_log(spark, SF)
    r = tables.ingest_with_stats(spark, e, f"{workdir}/ingest").collect()[0]
    assert r.records == e.count() and r.seconds > 0


def test_catalog_table_exists(spark):
    spark.range(3).createOrReplaceTempView("probe_view")
    assert tables.table_exists(spark, "probe_view")
    assert not tables.table_exists(spark, "no_such_table_here")


def test_import_into_both_tables(spark, workdir):
    e = C.event_log(spark, SF)
    default, hourly = tables.import_event_log(spark, e, f"{workdir}/event_logs")
    n = e.count()
    assert default.count() == n and hourly.count() == n
    assert tables.table_exists(spark, f"{workdir}/event_logs" + S.HOURLY_SUFFIX)
    assert not e.is_cached


def test_default_table_rewrites_only_touched_id_blocks(spark, workdir):
    e = C.event_log(spark, SF)                     # ev_id 0..999
    path = f"{workdir}/by_id"
    t = tables.upsert_events_by_id(spark, e, path, block=100)
    assert t.count() == e.count()
    blocks = sorted(glob.glob(f"{path}/id_block=*"))
    assert len(blocks) == 10
    before = {b: sorted(os.listdir(b)) for b in blocks}
    batch = e.where("ev_id BETWEEN 300 AND 349").withColumn("repo", F.lit("v2"))
    t2 = tables.upsert_events_by_id(spark, batch, path, block=100)
    assert t2.count() == e.count() and t2.where("repo = 'v2'").count() == 50
    changed = [b for b in blocks if sorted(os.listdir(b)) != before[b]]
    assert changed == [f"{path}/id_block=3"]


def test_write_tasks_follow_bytes_read_not_join_estimates(spark):
    e = C.event_log(spark, SF)
    joined = e.join(e.select(F.col("ev_id").alias("x")), F.col("ev_id") == F.col("x"))
    floor = spark.sparkContext.defaultParallelism
    assert tables.write_tasks(e) == floor                    # tiny input
    assert tables.write_tasks(joined) == floor               # not the product estimate
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert tables.write_tasks(e) > floor                 # follows the bytes read
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_failed_merge_leaves_the_table_as_it_was(spark, workdir):
    # The merge is written straight back; partitions are replaced only at
    # job commit, so a job that fails mid-way changes nothing.
    import pytest
    e = C.event_log(spark, SF)
    path = f"{workdir}/hourly-fail"
    tables.upsert_hourly(spark, e, path)
    files = sorted(glob.glob(f"{path}/*/*/*.parquet"))
    before = sorted(spark.read.parquet(path).collect())
    bad = e.withColumn("repo", F.when(F.col("ev_id") % 2 == 0, F.raise_error(F.lit("boom")))
                                .otherwise(F.col("repo")))
    with pytest.raises(Exception):
        tables.upsert_hourly(spark, bad, path)
    assert sorted(glob.glob(f"{path}/*/*/*.parquet")) == files
    assert sorted(spark.read.parquet(path).collect()) == before


def test_composite_key_rewrites_touched_blocks_only(spark, workdir):
    df = spark.range(1000).select("id", F.lit("Push").alias("type"))
    path = f"{workdir}/by_block"
    assert tables.upsert_by_id_block(spark, df, path, ["id", "type"], block=100).count() == 1000
    files = {b: sorted(os.listdir(b)) for b in glob.glob(f"{path}/id_block=*")}
    t = tables.upsert_by_id_block(spark, df.where("id = 250").withColumn("type", F.lit("Fork")), path, ["id", "type"], block=100)
    assert t.count() == 1001
    assert [b for b in files if sorted(os.listdir(b)) != files[b]] == [f"{path}/id_block=2"]


def test_merges_leave_no_scratch(spark, workdir):
    from loomlog.session import checkpoint_root
    e = C.event_log(spark, SF)
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/loomlog-scratch/*"))
    for _ in range(2):
        tables.upsert_events_by_id(spark, e, f"{workdir}/t")
    assert set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/loomlog-scratch/*")) == before

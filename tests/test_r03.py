"""Work that grows with the input is shared by tasks and done once (findings of round 3)."""

from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.sinks import snapshots
from loomlog.sources import records
from loomlog.streaming import case_stream
from textfiles import write_text


def test_a_change_is_written_by_several_tasks(spark, workdir, monkeypatch):
    # below the target size too, one file a task; a change leaves as many; the manifest has each file's bounds
    monkeypatch.setattr(snapshots, "LEAST_BYTES", 4096)
    store = snapshots.SnapshotStore(spark, f"{workdir}/store")
    for lo, hi in ((0, 6000), (3000, 9000)):
        change = store.begin()
        rows = spark.range(lo, hi).select((F.col("id") * 7919 % 10007).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        change.merge("t", rows, ["k"])
        change.commit()
    files = store.manifest("t").collect()
    assert len(files) > 1
    held = spark.read.parquet(*[f"{store.root}/{f['file']}" for f in files]).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    assert {f["file"].split("/")[-1]: (f["rows"], f["lo"]["k"], f["hi"]["k"]) for f in files} == {h["f"]: (h["n"], h["lo"], h["hi"]) for h in held}
    want = {i * 7919 % 10007 for i in range(9000)}
    assert sorted(r["k"] for r in store.read("t").collect()) == sorted(want)


def test_an_index_looks_at_the_ends_of_files_only(spark, workdir):
    # no aggregate over all keys; rows that repeat a batch's column count all the same
    store = snapshots.SnapshotStore(spark, f"{workdir}/store")
    change = store.begin()
    change.put("t", spark.range(5000, numPartitions=3), "a")
    change.put("t", spark.range(0, numPartitions=1), "b")
    change.put("t", spark.range(10, numPartitions=1), "c")
    change.commit()
    got = store.manifest("t").groupBy("lo", "hi").agg(F.sum("rows").alias("n")).collect()
    assert sorted((r["lo"]["batch"], r["hi"]["batch"], r["n"]) for r in got) == [("a", "a", 5000), ("c", "c", 10)]


def test_lines_go_to_python_twice(spark, workdir):
    # whose record a split begins in comes from a count in the scan
    write_text(f"{workdir}/in/a.txt", 'V,9,1\nC,"1",1\nV,2,1\nC,"2",2\nV,3,1\n')
    write_text(f"{workdir}/in/b.txt", "V,8,1\nV,7,1\n")
    grouped = records.group_records(spark, f"{workdir}/in", S.CASE_VOTE_HEADER_REGEX, leading="keep")
    assert grouped._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    assert sorted(r["lines"] for r in grouped.collect()) == [
        ['C,"1",1', "V,2,1"], ['C,"2",2', "V,3,1"], ["V,8,1", "V,7,1"], ["V,9,1"]]
    out = case_stream.run_case_votes(spark, f"{workdir}/in")
    assert sorted((r["case_id"], r["attr_ids"]) for r in out.collect()) == [(1, [2]), (2, [3])]

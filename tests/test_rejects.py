"""No row is lost at a keyed write: rows without a key fail it, or go to the rejects."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textfiles import write_text
from loomlog import schemas as S
from loomlog.plans import corpora as C
from loomlog.plans import reports
from loomlog.sinks import snapshots, tables

SF = "/root/testdata/sf0.001"


def line(i, at="2015-01-01T00:00:00Z"):
    return json.dumps({"id": i, "type": "PushEvent", "created_at": at, "actor": {"login": "a"}, "repo": {"name": "r"},
                       "payload": {"ref": f"x{i}"}})


def test_corrupt_lines_fail_the_import_or_are_set_aside(spark, workdir):
    bad = ["{broken", "not json", '{"id": ']
    src = write_text(f"{workdir}/in/a.json", "\n".join([line("1"), bad[0], line("2"), *bad[1:]]) + "\n")
    with pytest.raises(PySparkException, match="null in key column"):
        reports.import_logs(spark, src, f"{workdir}/strict")
    default, hourly = reports.import_logs(spark, src, f"{workdir}/logs", quarantine_path=f"{workdir}/bad")
    assert default.count() == hourly.count() == 2
    assert sorted(r.value for r in spark.read.text(f"{workdir}/bad").collect()) == sorted(bad)


def test_ids_that_are_no_numbers(spark, workdir):
    lines = [line(f"x{k}") for k in range(3)]
    src = write_text(f"{workdir}/in/a.json", "\n".join(lines) + "\n")
    with pytest.raises(PySparkException, match="ev_id"):
        reports.import_logs(spark, src, f"{workdir}/strict")
    default, _ = reports.import_logs(spark, src, f"{workdir}/logs", quarantine_path=f"{workdir}/bad")
    assert default.count() == 0
    assert sorted(r.value for r in spark.read.text(f"{workdir}/bad").collect()) == lines     # payload and all


def test_unreadable_times_never_replace_each_other(spark, workdir):
    first = write_text(f"{workdir}/in/a.json", "\n".join(line(str(k), "soon") for k in range(5)) + "\n")
    then = write_text(f"{workdir}/in/b.json", "\n".join(line(str(k)) for k in (10, 11)) + "\n")
    for src in (first, then):
        default, hourly = reports.import_logs(spark, src, f"{workdir}/logs", quarantine_path=f"{workdir}/bad")
    assert hourly.count() == default.count() == 2 and spark.read.text(f"{workdir}/bad").count() == 5


def test_an_import_without_rows_makes_a_table(spark, workdir):
    empty = write_text(f"{workdir}/in/a.json", "\n")
    default, hourly = reports.import_logs(spark, empty, f"{workdir}/logs")
    assert default.count() == hourly.count() == 0
    src = write_text(f"{workdir}/in/b.json", line("1") + "\n")
    default, hourly = reports.import_logs(spark, src, f"{workdir}/logs")
    assert default.count() == hourly.count() == 1
    default, hourly = reports.import_logs(spark, empty, f"{workdir}/logs")
    assert default.count() == hourly.count() == 1


def test_rejects_of_any_keyed_table(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "id long, word string")
    with pytest.raises(PySparkException):
        snapshots.upsert_table(spark, df, f"{workdir}/t", ["id"])
    t = snapshots.upsert_table(spark, df, f"{workdir}/u", ["id"], rejects=f"{workdir}/r")
    assert t.count() == 1 and spark.read.json(f"{workdir}/r").count() == 2


def test_a_merge_reads_touched_hours_and_aggregates_only_the_batch(spark, workdir, monkeypatch):
    e = C.event_log(spark, SF)
    path = f"{workdir}/hourly"
    tables.upsert_hourly(spark, e, path)
    plans, files = [], []
    layout = tables._layout

    def spy(df, *a):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        old = spark.read.parquet(path).where("date_utc BETWEEN '20240102Z' AND '20240102Z' AND hour_utc BETWEEN 5 AND 5")
        files.extend(r.f for r in old.select(F.input_file_name().alias("f")).distinct().collect())
        return layout(df, *a)
    monkeypatch.setattr(tables, "_layout", spy)
    one = e.where("date_utc = '20240102Z' AND hour_utc = 5").withColumn("repo", F.lit("again")).collect()
    batch = spark.createDataFrame(one, e.schema)                   # no filter in the batch's own plan
    t = tables.upsert_hourly(spark, batch, path)
    assert t.count() == e.count() and t.where("repo = 'again'").count() == len(one)
    plan = plans[0]
    assert len(plans) == 1 and "SortAggregate" not in plan and "LeftAnti" in plan
    old = next(x for x in plan.split("FileScan") if "PartitionFilters: [isnotnull(date_utc" in x)
    assert ">= 20240102Z)" in old and "<= 20240102Z)" in old and ">= 5)" in old and "<= 5)" in old
    assert files and all("/hour_utc=5/" in f for f in files)       # what these bounds let through


def test_full_record_keeps_the_payload(spark, workdir):
    from loomlog.sources import events as ev
    src = write_text(f"{workdir}/in/a.json", line("7") + "\n")
    r = ev.read_records(spark, src).first()
    assert json.loads(r.full_record)["payload"] == {"ref": "x7"} and json.loads(r.payload) == {"ref": "x7"}
    assert json.loads(ev.read_events_json(spark, src).first().payload) == {"ref": "x7"}
    assert "payload" in ev.read_events_json(spark, src, infer=True).columns
    assert set(S.EVENT_LOG_COLUMNS) <= set(ev.to_event_log(ev.read_records(spark, src), ["full_record"]).columns)

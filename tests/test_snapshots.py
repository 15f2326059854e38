"""Snapshot stores: merges, places, commits, readers, killed writers."""

import os
import random
import signal
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from loomlog.sinks.snapshots import SnapshotStore

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = "type string, actor string, id long, body string"
KEY = ["type", "actor", "id"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def places_do_not_overlap(store, name):
    rows = sorted((tuple(r["lo"]), tuple(r["hi"]), r["rows"]) for r in store.manifest(name).collect())
    assert all(lo <= hi for lo, hi, _ in rows) and all(a[1] < b[0] for a, b in zip(rows, rows[1:], strict=False))
    return rows


def test_merges_equal_a_dictionary(spark, workdir):
    rnd = random.Random(3)
    store, want = SnapshotStore(spark, f"{workdir}/s", target_bytes=3000), {}
    for step in range(6):
        n = [150, 3, 0, 40, 1, 80][step]
        batch = [(rnd.choice("abc"), f"u{rnd.randint(0, 40):02d}", rnd.randint(0, 60), f"{step}-{k}" + "x" * 30) for k in range(n)]
        batch += batch[:3]
        best = {}
        for *k, body in batch:
            best[tuple(k)] = max(best.get(tuple(k), ""), body)
        want |= best
        change = store.begin()
        change.merge("events", frame(spark, batch), KEY)
        assert change.commit() == step + 1
        got = {tuple(r)[:3]: r.body for r in store.read("events").collect()}
        assert got == want and sum(r[2] for r in places_do_not_overlap(store, "events")) == len(want)
    assert store.manifest("events").count() > 3
    for key in random.Random(1).sample(sorted(want), 10):
        assert [r.body for r in store.read("events", type=key[0], actor=key[1], id=key[2]).collect()] == [want[key]]
        assert store.read("events", type=key[0], actor=key[1]).count() == sum(k[:2] == key[:2] for k in want)


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """20,000 rows in files of about 20 kB: a third of one type."""
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("grown")), target_bytes=20_000)
    change = store.begin()
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "push").otherwise(F.concat(F.lit("t"), F.col("id") % 7)).alias("type"),
        F.format_string("u%04d", F.col("id") % 500).alias("actor"), "id", F.sha2(F.col("id").cast("string"), 256).alias("body"))
    change.merge("events", rows, KEY)
    change.commit()
    return store


def files(store):
    return {r["file"] for r in store.manifest("events").collect()}


def test_a_batch_of_one_actor_touches_few_files(spark, grown):
    before = files(grown)
    assert len(before) > 20
    change = grown.begin()
    change.merge("events", frame(spark, [("push", "u0003", k, "new") for k in (3, 1503, 999_999)]), KEY)
    change.commit()
    after = files(grown)
    assert len(before - after) <= 2 and len(after - before) <= 3
    point = grown.read("events", type="push", actor="u0003")
    assert len(point.inputFiles()) <= 2 < len(after) and point.where("body = 'new'").count() == 3
    places_do_not_overlap(grown, "events")


def test_scattered_keys_leave_the_files_between_alone(spark, grown):
    before = files(grown)
    change = grown.begin()
    change.merge("events", frame(spark, [("a", "u", 1, "x"), ("push", "u0100", 7, "x"), ("push", "u0400", 8, "x"), ("zz", "u", 9, "x")]), KEY)
    change.commit()
    after = files(grown)
    assert len(before - after) <= 4 and len(before & after) >= len(before) - 4
    places_do_not_overlap(grown, "events")
    assert grown.read("events", type="zz").count() == 1


def test_a_table_grown_a_hundredfold_keeps_its_file_size(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s", target_bytes=20_000)

    def words(lo, hi):
        return spark.range(lo, hi).select(F.sha2(F.col("id").cast("string"), 256).alias("word"), F.col("id").alias("count"))

    for lo, hi in ((0, 200), (200, 2_000), (2_000, 20_000)):
        change = store.begin()
        change.merge("words", words(lo, hi), ["word"])
        change.commit()
    sizes = [r["bytes"] for r in store.manifest("words").collect()]
    assert len(sizes) > 30 and max(sizes) < 4 * 20_000 and store.read("words").count() == 20_000
    before = {r["file"] for r in store.manifest("words").collect()}
    change = store.begin()
    change.merge("words", words(20_000, 20_005), ["word"])
    change.commit()
    assert len(before - {r["file"] for r in store.manifest("words").collect()}) <= 5


def test_readers_see_old_or_new_never_a_mix(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s", target_bytes=2000)
    change = store.begin()
    change.merge("a", frame(spark, [("t", "u", k, "old") for k in range(50)]), KEY)
    change.put("b", spark.createDataFrame([("old",)], "v string"), "first")
    change.commit()
    early = store.read("a")
    change = store.begin()
    change.merge("a", frame(spark, [("t", "u", k, "new") for k in range(50)]), KEY)
    assert {r.body for r in store.read("a").collect()} == {"old"}          # half of the change is made
    change.put("b", spark.createDataFrame([("new",)], "v string"), "first")
    assert {r.v for r in store.read("b").collect()} == {"old"}
    change.commit()
    assert {r.body for r in store.read("a").collect()} == {"new"} == {r.v for r in store.read("b").collect()}
    assert {r.body for r in early.collect()} == {"old"} and early.count() == 50
    assert {r.body for r in store.read("a", version=1).collect()} == {"old"} and store.tables() == ["a", "b"]
    store.expire()
    assert store.versions() == [2] and store.read("a").count() == 50 and store.read("b").count() == 1
    left = {p for p in os.listdir(f"{workdir}/s/data/a")}
    assert len(left) == 1 and len(os.listdir(f"{workdir}/s/manifest")) == 2


def test_second_writer_fails(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s")
    one, two = store.begin(), store.begin()
    for change in (one, two):
        change.merge("a", frame(spark, [("t", "u", 1, "x")]), KEY)
    one.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()
    assert store.versions() == [1] and len(os.listdir(f"{workdir}/s/_commits")) <= 2


def test_refusals_and_empty_tables(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s")
    assert store.version() == 0 and store.tables() == []
    change = store.begin()
    change.merge("none", frame(spark, []), KEY)
    change.put("empty", spark.createDataFrame([], "v string"), 1)
    change.commit()
    assert store.read("none").collect() == [] and store.read("none", type="x").collect() == [] and store.read("empty").columns == ["batch", "v"]
    change = store.begin()
    with pytest.raises(ValueError, match="has key"):
        change.merge("none", frame(spark, []), ["id"])
    with pytest.raises(Exception, match="null in key column"):
        change.merge("none", frame(spark, [("t", None, 1, "x")]), KEY)
    with pytest.raises(ValueError, match="letters, digits"):
        change.merge("../x", frame(spark, []), KEY)
    with pytest.raises(ValueError, match="first columns"):
        store.read("none", actor="x")


def test_a_batch_delivered_again_takes_its_own_place(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s")
    for batch, rows in (("a", 3), ("b", 2), ("a", 1), ("a", 4)):
        change = store.begin()
        change.put("lines", spark.range(rows), batch)
        change.commit()
    assert {r["batch"]: r["count"] for r in store.read("lines").groupBy("batch").count().collect()} == {"a": 4, "b": 2}


KILLED = """
import os, signal, sys
sys.path.insert(0, {root!r})
from loomlog.session import build_session
from loomlog.sinks import snapshots
spark = build_session(master="local[2]")
store = snapshots.SnapshotStore(spark, {store!r})
change = store.begin()
change.merge("a", spark.createDataFrame([("t", "u", k, "new") for k in range(20)], {schema!r}), {key!r})
change.put("b", spark.createDataFrame([("new",)], "v string"), "first")
def killed(path, *_):
    os.kill(spark.sparkContext._gateway.proc.pid, signal.SIGKILL)
    os.kill(os.getpid(), signal.SIGKILL)
change.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
real = snapshots._fs
class Fs:
    def __init__(self, fs): self.fs = fs
    def __getattr__(self, name): return killed if name == "rename" else getattr(self.fs, name)
snapshots._fs = lambda s, p: (Fs(real(s, p)[0]), real(s, p)[1])
change.commit()
"""


def test_a_writer_killed_in_its_commit_changes_nothing(spark, workdir):
    store = SnapshotStore(spark, f"{workdir}/s")
    change = store.begin()
    change.merge("a", frame(spark, [("t", "u", k, "old") for k in range(10)]), KEY)
    change.put("b", spark.createDataFrame([("old",)], "v string"), "first")
    change.commit()
    code = KILLED.format(root=ROOT, store=f"{workdir}/s", schema=SCHEMA, key=KEY)
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, timeout=300, check=False)
    assert done.returncode == -signal.SIGKILL, done.stderr[-2000:]
    assert store.versions() == [1] and len(os.listdir(f"{workdir}/s/data/a")) == 2     # its files are there, unnamed
    assert {r.body for r in store.read("a").collect()} == {"old"} == {r.v for r in store.read("b").collect()}
    change = store.begin()
    change.merge("a", frame(spark, [("t", "u", k, "new") for k in range(20)]), KEY)
    assert change.commit() == 2 and store.read("a").where("body = 'new'").count() == 20
    store.expire()
    assert len(os.listdir(f"{workdir}/s/data/a")) == 1

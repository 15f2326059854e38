"""Existence by catalog name, listing, saved and registered tables; the command line."""

import json
import uuid

import pytest
from pyspark.errors import AnalysisException

from textfiles import write_text
from loomlog import __main__ as cli
from loomlog.sinks import catalog, tables
from test_records import SMALL


@pytest.fixture
def space(spark, workdir):
    name = f"logs_{uuid.uuid4().hex[:8]}"
    catalog.create_namespace(spark, name, f"{workdir}/space")
    yield name
    catalog.drop_namespace(spark, name)


def test_saved_and_registered_tables_are_listed(spark, workdir, space):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, kind string")
    assert catalog.save_table(df, space, "events", ["kind"]).count() == 2
    with pytest.raises(AnalysisException):
        catalog.save_table(df, space, "events", ["kind"])
    assert catalog.save_table(df, space, "events", ["kind"], mode="append").count() == 4
    df.write.parquet(f"{workdir}/a folder's")
    assert catalog.register_folder(spark, space, "plain", f"{workdir}/a folder's").count() == 2
    df.write.partitionBy("kind").parquet(f"{workdir}/parts")
    assert {r.kind for r in catalog.register_folder(spark, space, "parts", f"{workdir}/parts").collect()} == {"a", "b"}
    df.createOrReplaceTempView("only_a_view")
    assert {(r.namespace, r.name) for r in catalog.listing(spark, [space, "no_such_space"]).collect()} == {
        (space, "events"), (space, "plain"), (space, "parts")}
    assert (space, "events") in {(r.namespace, r.name) for r in catalog.listing(spark).collect()}
    assert tables.table_exists(spark, f"{space}.events") and not tables.table_exists(spark, f"{space}.nothing")


def test_many_names_at_once(spark, space):
    catalog.save_table(spark.range(1), space, "events")
    wanted = [(space, "events", 1), (space.upper(), "Events", 2), (space, "other", 3), ("no_such_space", "events", 4), (None, "events", 5), (space, None, 6)]
    got = catalog.tables_present(spark, spark.createDataFrame(wanted, "namespace string, name string, k int")).collect()
    assert {r.k: r.exists for r in got} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False}
    none = spark.createDataFrame([], "namespace string, name string")
    assert catalog.tables_present(spark, none).collect() == []
    assert [r.exists for r in catalog.tables_present(spark, spark.createDataFrame([("x_", "y")], "namespace string, name string")).collect()] == [False]


def test_names_are_names(spark):
    with pytest.raises(ValueError, match="letters, digits"):
        catalog.create_namespace(spark, "a; DROP")
    with pytest.raises(ValueError, match="letters, digits"):
        catalog.save_table(spark.range(1), "a", "b`c")


# ------------------------------------------------------------ K8: console output

def event(k, at="2015-01-01T05:00:00Z"):
    return json.dumps({"id": str(k), "type": "PushEvent" if k % 2 else "ForkEvent", "created_at": at, "actor": {"login": f"a{k % 3}"},
                       "repo": {"name": "r"}})


@pytest.fixture
def no_stop(spark, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)


def test_import_and_query_print_whole_results(spark, workdir, no_stop, capsys):
    src = write_text(f"{workdir}/in/a.json", "\n".join(event(k) for k in range(7)) + "\n")
    cli.main(["import", "--input", src, "--table", f"{workdir}/logs"])
    assert "default table rows: 7, hourly table rows: 7" in capsys.readouterr().out
    cli.main(["query", "--table", f"{workdir}/logs_hourly_by_ts_id", "--date", "20150101Z"])
    out = capsys.readouterr().out
    assert "ForkEvent\t4" in out and "PushEvent\t3" in out and "20150101Z\t5\tactor\ta0\t3" in out
    assert len([line for line in out.splitlines() if line.startswith("20150101Z\t")]) == 24 * 4


def test_import_into_a_store(spark, workdir, no_stop, capsys):
    src = write_text(f"{workdir}/in/a.json", "\n".join([*(event(k) for k in range(7)), "{broken"]) + "\n")
    for version in (1, 2):
        cli.main(["import", "--input", src, "--store", f"{workdir}/store", "--batch", "a"])
        assert capsys.readouterr().out.strip() == f"version {version}: batch a, 8 records, 7 imported, 1 rejected"
    cli.main(["query", "--store", f"{workdir}/store", "--date", "20150101Z"])
    assert "ForkEvent\t4" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["import", "--input", src, "--store", f"{workdir}/store"])


def test_casevotes_prints_attributes_and_counts(spark, workdir, no_stop, capsys):
    src = write_text(f"{workdir}/cases/a.txt", SMALL)
    cli.main(["casevotes", "--input", src, "--top", "2"])
    out = capsys.readouterr().out
    assert "-- votes_per_attribute" in out and "41\t3" in out and out.split("-- top_attributes\n")[1].splitlines() == [
        "id\ttitle\tcnt", "2100\tGarden Tools\t0", "2210\tTea, Coffee\t0"]

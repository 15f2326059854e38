"""The program-level functions (L1-L3)."""

import pytest

from textfiles import write_text
from loomlog.plans import reports
from loomlog.sinks.snapshots import SnapshotStore
from test_events import github_lines
from test_records import SMALL


def test_import_and_event_report(spark, workdir):
    p = write_text(f"{workdir}/g/events-a.json", "\n".join(github_lines()) + "\n")
    default, hourly = reports.import_logs(spark, p, f"{workdir}/logs")
    assert default.count() == 10 and hourly.count() == 10
    default, hourly = reports.import_logs(spark, p, f"{workdir}/logs")      # re-import: upsert
    assert default.count() == 10 and hourly.count() == 10
    rep = reports.event_report(spark, hourly, ["20150101Z"])
    assert {r.ev_type: r.cnt for r in rep["count_by_type"].collect()} == {"PushEvent": 8, "CreateEvent": 2}
    top = rep["top_per_hour"]
    assert top.count() == 72
    h0 = {r.field: (r.value, r.cnt) for r in top.where("hour_utc = 0").collect()}
    assert h0 == {"actor": ("user0", 1), "ev_type": ("PushEvent", 8), "repo": ("user0/project0", 1)}
    assert rep["top_row_per_hour"].count() == 24


def test_case_vote_report(spark, workdir):
    p = write_text(f"{workdir}/m/cases.txt", SMALL)
    rep = reports.case_vote_report(spark, p, k=2)
    assert rep["cases"].count() == 5 and rep["attributes"].count() == 3
    assert {r.attr_id: r.cnt for r in rep["votes_per_attribute"].collect()} == \
        {40: 1, 41: 3, 42: 1, 43: 2, 44: 1}
    assert [r.cnt for r in rep["attribute_votes"].collect()] == [None, None, None]
    assert [(r.id, r.cnt) for r in rep["top_attributes"].collect()] == [(2100, 0), (2210, 0)]
    # active cases from vote rows (no gathered records) = from the case arrays
    from loomlog.operators import votes
    assert sorted(rep["active_cases"].collect()) == sorted(votes.active_cases(rep["cases"]).collect())


def test_import_with_quarantine(spark, workdir):
    lines = github_lines()
    p = write_text(f"{workdir}/q/events-b.json", "\n".join(lines[:3] + ["{broken"] + lines[3:]) + "\n")
    default, hourly = reports.import_logs(spark, p, f"{workdir}/qlogs", lenient=True,
                                          quarantine_path=f"{workdir}/bad")
    assert default.count() == 10 and hourly.count() == 10
    assert [r.value for r in spark.read.text(f"{workdir}/bad").collect()] == ["{broken"]


def test_duplicate_summary_of_nothing(spark):
    from loomlog.operators import counts
    r = counts.duplicate_summary(spark.range(0).select("id")).collect()[0]
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (0, 0, 0)


def test_an_import_that_is_repeated_changes_nothing(spark, workdir):
    """Tables, rejected lines and statistics move in one commit; a second delivery takes the first one's place."""
    good = [f'{{"id": "{k}", "type": "PushEvent", "created_at": "2015-01-01T0{k % 5}:00:00Z", "actor": {{"login": "a"}}, '
            f'"repo": {{"name": "r{k}"}}}}' for k in range(20)]
    a = write_text(f"{workdir}/a.json", "\n".join([*good[:12], "{broken", good[3].replace('"3"', '"x"')]) + "\n")
    b = write_text(f"{workdir}/b.json", "\n".join(x.replace('"name": "r', '"name": "new-r') for x in good[8:]) + "\n")
    store = SnapshotStore(spark, f"{workdir}/store")

    def state():
        logs = [sorted((r.ev_id, r.repo) for r in store.read(t).collect()) for t in (reports.DEFAULT_TABLE, reports.HOURLY_TABLE)]
        stats = {r.batch: (r.records, r.imported, r.rejected) for r in store.read(reports.STATS_TABLE).collect()}
        return logs, sorted(r.value for r in store.read(reports.REJECTS_TABLE).collect()), stats

    assert reports.import_batch(store, "a", a) == 1 and reports.import_batch(store, "b", b) == 2
    logs, rejects, stats = state()
    want = [(k, f"new-r{k}" if k >= 8 else f"r{k}") for k in range(20)]
    assert logs == [want, want] and len(rejects) == 2 and stats == {"a": (14, 12, 2), "b": (12, 12, 0)}
    reports.import_batch(store, "b", b)
    assert state() == (logs, rejects, stats)
    reports.import_batch(store, "a", a)
    assert state()[1:] == (rejects, stats) and [len(x) for x in state()[0]] == [20, 20]
    with pytest.raises(ValueError, match="2 of 14 lines"):
        reports.import_batch(store, "c", a, quarantine=False)
    assert store.version() == 4

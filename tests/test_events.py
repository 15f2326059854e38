"""Event-log import and queries on small GitHub-shaped inputs (FIXTURES F-1)."""

import json

import pytest
from pyspark.sql import functions as F

from textfiles import write_text
from loomlog.operators import counts, joins, ranking
from loomlog.sources import events as ev


def github_lines():
    """Ten events of one hour: 8 pushes, 2 creates, ten actors and repos,
    only the fourth has an ``org``."""
    out = []
    for i in range(10):
        e = {
            "id": str(3000000000 + i),
            "type": "CreateEvent" if i in (2, 7) else "PushEvent",
            "public": True,
            "created_at": f"2015-01-01T00:00:0{i // 2}Z",
            "actor": {"id": 100 + i, "login": f"user{i}", "gravatar_id": "",
                      "url": f"https://example.invalid/u/{i}", "avatar_url": ""},
            "repo": {"id": 500 + i, "name": f"user{i}/project{i}", "url": ""},
            "payload": {"size": i, "commits": [{"sha": "x" * 8, "distinct": True}]},
        }
        if i == 3:
            e["org"] = {"id": 1, "login": "someorg"}
        out.append(json.dumps(e))
    return out


@pytest.fixture
def glog(workdir):
    return write_text(f"{workdir}/events/events-a.json", "\n".join(github_lines()) + "\n")


def test_json_to_event_log(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    rows = log.orderBy("ev_id").collect()
    assert len(rows) == 10
    assert {(r.date_utc, r.hour_utc) for r in rows} == {("20150101Z", 0)}
    assert rows[0].ev_id == 3000000000 and rows[0].actor == "user0" and rows[0].repo == "user0/project0"
    by_type = {r.ev_type: r.cnt for r in counts.count_by(log, "ev_type").collect()}
    assert by_type == {"PushEvent": 8, "CreateEvent": 2}
    assert log.schema["created_at"].dataType.typeName() == "timestamp_ntz"


def test_fields_by_name_not_position(spark, workdir):
    # No ``org`` anywhere and a login with a comma: fields come by name.
    lines = [json.dumps({"id": "1", "type": "PushEvent", "created_at": "2015-01-01T01:00:00Z",
                         "actor": {"login": "a,b"}, "repo": {"name": "r,1"}})]
    p = write_text(f"{workdir}/noorg.json", "\n".join(lines) + "\n")
    r = ev.to_event_log(ev.read_events_json(spark, p)).collect()[0]
    assert (r.actor, r.repo, r.hour_utc) == ("a,b", "r,1", 1)


def test_utc_date_hour_independent_of_session_zone(spark, workdir):
    p = write_text(f"{workdir}/late.json",
                   json.dumps({"id": "9", "type": "X", "created_at": "2015-01-01T23:59:59Z",
                               "actor": {"login": "a"}, "repo": {"name": "r"}}) + "\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = ev.to_event_log(ev.read_events_json(spark, p)).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.date_utc, r.hour_utc) == ("20150101Z", 23)
    assert str(r.created_at) == "2015-01-01 23:59:59"


def test_lenient_defaults_and_bad_lines(spark, workdir):
    good = json.dumps({"id": "5", "type": "PushEvent", "created_at": "2015-01-02T03:00:00Z",
                       "actor": {"login": "a"}, "repo": {"name": "r"}})
    p = write_text(f"{workdir}/lenient/a.json", good + "\n{}\n")
    rows = ev.read_events_lenient(spark, p).orderBy("ev_id").collect()
    assert [(r.ev_id, r.ev_type, r.actor, r.repo, r.date_utc, r.hour_utc) for r in rows] == [
        (0, "NONE", "NONE", "NONE", "19700101Z", 0), (5, "PushEvent", "a", "r", "20150102Z", 3)]
    bad = write_text(f"{workdir}/lenient2/a.json", good + "\n{not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        ev.read_events_lenient(spark, bad, on_error="fail").collect()
    q = ev.read_events_lenient(spark, bad, on_error="quarantine").collect()
    assert sorted((r.ev_id is None, r.bad_line) for r in q) == [(False, None), (True, "{not json")]


def test_top_per_hour_dense_grid_and_tie_break(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    top = ranking.top_per_hour(log, "actor", dates="20150101Z").orderBy("hour_utc").collect()
    assert len(top) == 24
    assert (top[0].actor, top[0].cnt) == ("user0", 1)          # ten-way tie → smallest
    assert all(r.actor is None and r.cnt is None for r in top[1:])
    one = ranking.top_at_hour(log, "ev_type", "20150101Z", 0).collect()
    assert [(r.ev_type, r.cnt) for r in one] == [("PushEvent", 8)]
    assert ranking.top_at_hour(log, "ev_type", "20150101Z", 5).count() == 0


def test_top_row_over_several_columns(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    top = ranking.top_per_hour(log, ["ev_type", "actor"], dates=["20150101Z", "20150102Z"])
    assert top.count() == 48
    r = top.where("date_utc = '20150101Z' AND hour_utc = 0").collect()[0]
    assert (r.ev_type, r.actor, r.cnt) == ("CreateEvent", "user2", 1)


def test_counts_family(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    assert counts.count_all(log).collect()[0].cnt == 10
    assert sorted(r.ev_type for r in counts.distinct_values(log, "ev_type").collect()) == \
        ["CreateEvent", "PushEvent"]
    log.createOrReplaceTempView("glog_view")
    assert counts.count_where(spark, "glog_view", "ev_type", "CreateEvent").collect()[0].cnt == 2
    # a value with a quote is bound, not pasted
    assert counts.count_where(spark, "glog_view", "ev_type", "x' OR '1'='1").collect()[0].cnt == 0
    dup = counts.duplicate_summary(log.select("ev_type")).collect()[0]
    assert (dup.n_rows, dup.n_distinct, dup.n_duplicates) == (10, 2, 8)


def test_interest_joins(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    nested = joins.nested_events(log)
    names = joins.interest_frame(spark, ["user2", "user3", "nobody"])
    fork = joins.interest_type_activity(spark, names, nested, "CreateEvent").collect()
    assert [(r.login, r.type, r.cnt) for r in fork] == [("user2", "CreateEvent", 1)]
    act = {r.name: (r.login, r.type, r.cnt, r.matched)
           for r in joins.interest_activity(names, nested).collect()}
    assert act == {"user2": ("user2", "CreateEvent", 1, 1), "user3": ("user3", "PushEvent", 1, 1),
                   "nobody": (None, None, 1, 0)}


def test_interest_names_listed_twice(spark, glog):
    log = ev.to_event_log(ev.read_events_json(spark, glog))
    nested = joins.nested_events(log).union(joins.nested_events(log))
    names = joins.interest_frame(spark, ["user2", "user2", "nobody", "nobody"])
    act = sorted((r.name, r.cnt, r.matched) for r in joins.interest_activity(names, nested).collect())
    assert act == [("nobody", 2, 0), ("user2", 4, 4)]


def test_union_of_json_files_with_filter(spark, workdir):
    lines = github_lines()
    write_text(f"{workdir}/many/a.json", "\n".join(lines[:4]) + "\n")
    write_text(f"{workdir}/many/b.json", "\n".join(lines[4:]) + "\n")
    write_text(f"{workdir}/many/notes.txt", "not json at all\n")
    df = ev.read_events_json(spark, f"{workdir}/many", path_glob="*.json")
    rows = df.select("id", "_corrupt_record").collect()
    assert len(rows) == 10 and all(r._corrupt_record is None for r in rows)


def test_daylight_saving_gap_in_session_zone(spark):
    from loomlog.functions.scalar import date_utc, hour_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t") \
            .select(date_utc(F.col("t")).alias("d"), hour_utc(F.col("t")).alias("h")).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.d, r.h) == ("20240310Z", 2)


def test_utc_instant_in_session_zone_gap(spark, workdir):
    p = write_text(f"{workdir}/gap.json", json.dumps(
        {"id": "1", "type": "X", "created_at": "2024-03-10T02:30:00Z",
         "actor": {"login": "a"}, "repo": {"name": "r"}}) + "\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = ev.to_event_log(ev.read_events_json(spark, p)).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (str(r.created_at), r.date_utc, r.hour_utc) == ("2024-03-10 02:30:00", "20240310Z", 2)


def test_bad_id_and_time_give_nulls(spark, workdir):
    p = write_text(f"{workdir}/badvals.json", json.dumps(
        {"id": "abc", "type": "X", "created_at": "not a time",
         "actor": {"login": "a"}, "repo": {"name": "r"}}) + "\n")
    r = ev.to_event_log(ev.read_events_json(spark, p)).collect()[0]
    assert (r.ev_id, r.created_at, r.date_utc, r.hour_utc, r.ev_type) == (None, None, None, None, "X")

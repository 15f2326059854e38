"""The registered queries: one per operator family of the reference, each
with its DuckDB oracle SQL (None where only a row count can be checked).

Every query reads the driver's tables under ``sf_dir`` — directly, or
through a corpus Spark derives from them (plans.corpora) — so its work
grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.operators import counts, joins, prep, ranking, votes
from loomlog.plans import corpora as C
from loomlog.plans import reports
from loomlog.plans.reports import import_logs
from loomlog.session import scratch_path
from loomlog.sinks import catalog as catalog_sink
from loomlog.sinks import snapshots, tables
from loomlog.sources import events as ev_src
from loomlog.sources import records, text
from loomlog.streaming import case_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# Fixed parameters of the registered queries.
DAY = "20240102Z"
HOUR = 5
EVENT_TYPE = "purchase"
INTEREST = ["3", "7", "11", "nobody", "3", "nobody"]     # names may be listed twice
MAX_RECORD_BYTES = 48
TOP_ATTRIBUTES = 20
FIRST_ATTRIBUTES = 10

E_CTE = ("e AS (SELECT event_id AS ev_id, ts AS created_at, event_type AS ev_type, "
         "CAST(user_id AS VARCHAR) AS actor, json_extract_string(props, '$.k') AS repo, "
         "strftime(ts, '%Y%m%d') || 'Z' AS date_utc, CAST(hour(ts) AS INTEGER) AS hour_utc "
         "FROM events)")
E_COLS = "date_utc, hour_utc, created_at, ev_id, actor, ev_type, repo"
INTEREST_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in INTEREST) + ") AS wanted(name)"


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# =========================================================== event log: counts

@query("count_by_type", f"WITH {E_CTE} SELECT ev_type, count(*) AS cnt FROM e GROUP BY ev_type")
def count_by_type(spark, sf):
    """A1 (flagship): events per type."""
    return counts.count_by(C.event_log(spark, sf), "ev_type")


@query("count_all", "SELECT count(*) AS cnt FROM events")
def count_all(spark, sf):
    """A3."""
    return counts.count_all(C.event_log(spark, sf))


@query("count_one_type", f"SELECT count(*) AS cnt FROM events WHERE event_type = '{EVENT_TYPE}'")
def count_one_type(spark, sf):
    """SQL with a bound parameter."""
    view = f"event_log_{uuid.uuid4().hex[:8]}"
    C.event_log(spark, sf).createOrReplaceTempView(view)
    return counts.count_where(spark, view, "ev_type", EVENT_TYPE)


@query("count_per_distinct_type", f"WITH {E_CTE} SELECT ev_type, count(*) AS cnt FROM e GROUP BY ev_type")
def count_per_distinct_type(spark, sf):
    """A4: count for every distinct value, one pass."""
    return counts.counts_for_values(C.event_log(spark, sf), "ev_type")


@query("distinct_types", "SELECT DISTINCT event_type AS ev_type FROM events")
def distinct_types(spark, sf):
    """A11."""
    return counts.distinct_values(C.event_log(spark, sf), "ev_type")


@query("project_field", "SELECT CAST(user_id AS VARCHAR) AS actor FROM events")
def project_field(spark, sf):
    """One named column, as string."""
    return C.event_log(spark, sf).select(F.col("actor").cast("string"))


@query("event_log_hourly", f"WITH {E_CTE} SELECT {E_COLS} FROM e")
def event_log_hourly(spark, sf):
    """The event log with derived UTC date and hour."""
    return C.event_log(spark, sf)


def _hourly_table(spark, sf) -> DataFrame:
    return spark.read.parquet(C.hourly_table(spark, sf))


@query("events_at_hour", f"WITH {E_CTE} SELECT {E_COLS} FROM e WHERE date_utc = '{DAY}' AND hour_utc = {HOUR}")
def events_at_hour(spark, sf):
    """Partition-key equality on the hourly table (PartitionFilters)."""
    t = _hourly_table(spark, sf)
    return t.where((F.col("date_utc") == DAY) & (F.col("hour_utc") == HOUR)).select(*S.EVENT_LOG_COLUMNS)


@query("day_fields", f"WITH {E_CTE} SELECT hour_utc, actor FROM e WHERE date_utc = '{DAY}'")
def day_fields(spark, sf):
    """One field for all 24 hours of a day: one pruned scan instead of
    a union of 24."""
    t = _hourly_table(spark, sf)
    return t.where(F.col("date_utc") == DAY).select("hour_utc", "actor")


# =========================================================== event log: top-1

def _top_sql(fields: list[str], where: str = "") -> str:
    f = ", ".join(fields)
    order = ", ".join(f"{x} ASC NULLS LAST" for x in fields)
    return (f"WITH {E_CTE}, "
            f"c AS (SELECT date_utc, hour_utc, {f}, count(*) AS cnt FROM e {where} GROUP BY date_utc, hour_utc, {f}), "
            f"w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date_utc, hour_utc "
            f"ORDER BY cnt DESC, {order}) AS rn FROM c) WHERE rn = 1), "
            "g AS (SELECT date_utc, CAST(unnest(range(24)) AS INTEGER) AS hour_utc "
            "FROM (SELECT DISTINCT date_utc FROM e)) "
            f"SELECT g.date_utc, g.hour_utc, {', '.join('w.' + x for x in fields)}, w.cnt "
            "FROM g LEFT JOIN w ON g.date_utc = w.date_utc AND g.hour_utc = w.hour_utc")


@query("top_at_hour",
       f"WITH {E_CTE}, c AS (SELECT date_utc, hour_utc, actor, count(*) AS cnt FROM e "
       f"WHERE date_utc = '{DAY}' AND hour_utc = {HOUR} GROUP BY ALL) "
       "SELECT date_utc, hour_utc, actor, cnt FROM c ORDER BY cnt DESC, actor ASC NULLS LAST LIMIT 1")
def top_at_hour(spark, sf):
    """T1 on the hourly table (partition pruned)."""
    return ranking.top_at_hour(_hourly_table(spark, sf), "actor", DAY, HOUR)


@query("top_actor_per_hour", _top_sql(["actor"], f"WHERE ev_type = '{EVENT_TYPE}'"))
def top_actor_per_hour(spark, sf):
    """Most active buyer per hour of every day (empty hours → null)."""
    e = C.event_log(spark, sf)
    return ranking.top_per_hour(e.where(F.col("ev_type") == EVENT_TYPE), "actor", all_dates_from=e)


@query("top_type_per_hour", _top_sql(["ev_type"]))
def top_type_per_hour(spark, sf):
    """Most frequent event type per hour."""
    return ranking.top_per_hour(C.event_log(spark, sf), "ev_type")


@query("top_repo_per_hour", _top_sql(["repo"]))
def top_repo_per_hour(spark, sf):
    """Most active repo per hour."""
    return ranking.top_per_hour(C.event_log(spark, sf), "repo")


@query("top_row_per_hour", _top_sql(["actor", "ev_type"]))
def top_row_per_hour(spark, sf):
    """Whole (projected) row as key, per hour."""
    return ranking.top_per_hour(C.event_log(spark, sf), ["actor", "ev_type"])


@query("top_row",
       f"WITH {E_CTE} SELECT actor, ev_type, count(*) AS cnt FROM e GROUP BY actor, ev_type "
       "ORDER BY cnt DESC, actor ASC NULLS LAST, ev_type ASC NULLS LAST LIMIT 1")
def top_row(spark, sf):
    """A10: count by whole row, the top one (ties: smallest row)."""
    c = counts.count_rows(C.event_log(spark, sf).select("actor", "ev_type"))
    return ranking.top_k(c, 1, F.desc("cnt"), F.asc_nulls_last("actor"), F.asc_nulls_last("ev_type"))


@query("top_fields_per_hour",
       f"WITH {E_CTE}, "
       "l AS (SELECT date_utc, hour_utc, 'actor' AS field, actor AS value FROM e UNION ALL "
       "SELECT date_utc, hour_utc, 'ev_type', ev_type FROM e UNION ALL "
       "SELECT date_utc, hour_utc, 'repo', repo FROM e), "
       "c AS (SELECT date_utc, hour_utc, field, value, count(*) AS cnt FROM l GROUP BY ALL), "
       "w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date_utc, hour_utc, field "
       "ORDER BY cnt DESC, value ASC NULLS LAST) AS rn FROM c) WHERE rn = 1), "
       "g AS (SELECT date_utc, CAST(unnest(range(24)) AS INTEGER) AS hour_utc FROM (SELECT DISTINCT date_utc FROM e)), "
       "gf AS (SELECT date_utc, hour_utc, unnest(['actor', 'ev_type', 'repo']) AS field FROM g) "
       "SELECT gf.date_utc, gf.hour_utc, gf.field, w.value, w.cnt FROM gf LEFT JOIN w "
       "ON gf.date_utc = w.date_utc AND gf.hour_utc = w.hour_utc AND gf.field = w.field")
def top_fields_per_hour(spark, sf):
    """The query program's report — top actor, type and repo per
    hour of every day — in one scan and one shuffle for all fields."""
    from loomlog.plans.reports import top_fields_per_hour as report
    return report(C.event_log(spark, sf))


# =========================================================== interest joins

@query("interest_fork_activity",
       f"WITH {E_CTE} SELECT e.actor AS login, e.ev_type AS type, count(*) AS cnt "
       f"FROM {INTEREST_SQL} LEFT JOIN e ON wanted.name = e.actor WHERE e.ev_type = '{EVENT_TYPE}' "
       "GROUP BY e.actor, e.ev_type")
def interest_fork_activity(spark, sf):
    """SQL over temp views with struct paths."""
    nested = joins.nested_events(C.event_log(spark, sf))
    return joins.interest_type_activity(spark, joins.interest_frame(spark, INTEREST), nested, EVENT_TYPE)


@query("interest_activity",
       f"WITH {E_CTE} SELECT wanted.name, e.actor AS login, e.ev_type AS type, count(*) AS cnt, "
       f"count(e.actor) AS matched FROM {INTEREST_SQL} LEFT JOIN e ON wanted.name = e.actor "
       "GROUP BY wanted.name, e.actor, e.ev_type")
def interest_activity(spark, sf):
    """Keeps names without events."""
    nested = joins.nested_events(C.event_log(spark, sf))
    return joins.interest_activity(joins.interest_frame(spark, INTEREST), nested)


# The two literal rows inserted into the ``words`` table.
LITERAL_WORDS = [("abacus", 12), ("cirrus", 23)]


@query("literal_rows",
       "SELECT event_type AS word, CAST(count(*) AS INTEGER) AS count FROM events GROUP BY event_type "
       "UNION ALL SELECT * FROM (VALUES " + ", ".join(f"('{w}', {c})" for w, c in LITERAL_WORDS)
       + ") AS v(word, count)")
def literal_rows(spark, sf):
    """Keyed ``words(word, count)`` table filled from the data (events
    per type), then the literal rows inserted; read back whole."""
    e = C.event_log(spark, sf)
    words = e.groupBy(F.col("ev_type").alias("word")).agg(F.count(F.lit(1)).cast("int").alias("count"))
    path = scratch_path(spark, "words")
    snapshots.upsert_table(spark, words, path, ["word"])
    literal = spark.createDataFrame(LITERAL_WORDS, "word string, count int")
    return snapshots.upsert_table(spark, literal, path, ["word"])


# =========================================================== JSON sources

SPARSE_SQL = (
    "s AS (SELECT CASE WHEN value < 1 THEN 0 ELSE event_id END AS ev_id, "
    "CASE WHEN value < 1 THEN 'NONE' ELSE event_type END AS ev_type, "
    "CASE WHEN value < 1 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE ts END AS created_at, "
    "CASE WHEN event_type = 'error' THEN 'NONE' ELSE CAST(user_id AS VARCHAR) END AS actor, "
    "CASE WHEN event_type = 'signup' THEN 'NONE' ELSE json_extract_string(props, '$.k') END AS repo, "
    "value FROM events)")


@query("json_roundtrip_events", f"WITH {E_CTE} SELECT {E_COLS} FROM e")
def json_roundtrip_events(spark, sf):
    """GitHub JSON lines → event log, declared schema."""
    raw = ev_src.read_events_json(spark, C.github_json(spark, sf))
    return ev_src.to_event_log(raw)


@query("json_defaults",
       f"WITH {SPARSE_SQL} SELECT strftime(created_at, '%Y%m%d') || 'Z' AS date_utc, "
       "CAST(hour(created_at) AS INTEGER) AS hour_utc, created_at, ev_id, actor, ev_type, repo FROM s")
def json_defaults(spark, sf):
    """Per-line parse with literal defaults for absent fields."""
    return ev_src.read_events_lenient(spark, C.github_json(spark, sf, sparse=True))


@query("regex_type_counts",
       "SELECT CASE WHEN value < 1 THEN '{NONE}' ELSE event_type END AS ev_type, count(*) AS cnt "
       "FROM events GROUP BY 1")
def regex_type_counts(spark, sf):
    """First regex match of ``"type":"(\\w*)"`` per line,
    ``{NONE}`` when absent, counted."""
    from loomlog.functions.scalar import first_regex_group
    lines = text.read_lines(spark, C.github_json(spark, sf, sparse=True))
    t = first_regex_group(F.col("value"), S.TYPE_FIELD_REGEX, missing=S.NO_TYPE)
    return counts.count_by(lines.select(t.alias("ev_type")), "ev_type")


@query("json_type_counts",
       "SELECT CASE WHEN value < 1 THEN '{NONE}' ELSE event_type END AS ev_type, count(*) AS cnt "
       "FROM events GROUP BY 1")
def json_type_counts(spark, sf):
    """JSON field by name (``get_json_object``), counted."""
    from loomlog.functions.scalar import json_field
    lines = text.read_lines(spark, C.github_json(spark, sf, sparse=True))
    return counts.count_by(lines.select(json_field(F.col("value"), "type", S.NO_TYPE).alias("ev_type")),
                           "ev_type")


@query("full_record_json",
       "SELECT event_id AS id, event_type AS type, CAST(user_id AS VARCHAR) AS login, "
       "json_extract_string(props, '$.k') AS repo_name, event_id AS event, value AS amount FROM events")
def full_record_json(spark, sf):
    """(id, type) pair plus the whole record as JSON text, payload
    included; compared by parsing the text back."""
    rec = ev_src.read_records(spark, C.github_json(spark, sf)).select(
        F.col("id").cast("bigint").alias("id"), "type", "full_record", "payload")
    return rec.select("id", "type",
                      F.get_json_object("full_record", "$.actor.login").alias("login"),
                      F.get_json_object("full_record", "$.repo.name").alias("repo_name"),
                      F.get_json_object("payload", "$.event").cast("bigint").alias("event"),
                      F.get_json_object("full_record", "$.payload.detail.amount").cast("double").alias("amount"))


@query("json_inferred_counts", "SELECT event_type AS type, count(*) AS cnt FROM events GROUP BY 1")
def json_inferred_counts(spark, sf):
    """S1 with the schema taken from the data (an option; the default is declared)."""
    return counts.count_by(ev_src.read_events_json(spark, C.github_json(spark, sf), infer=True), "type")


@query("union_files",
       f"WITH {E_CTE} SELECT date_utc, ev_type, count(*) AS cnt FROM e GROUP BY date_utc, ev_type")
def union_files(spark, sf):
    """All ``*.json`` files of a folder (other files skipped) in
    one scan."""
    raw = ev_src.read_events_json(spark, C.github_json(spark, sf, with_decoy=True), path_glob="*.json")
    return counts.count_by(ev_src.to_event_log(raw), "date_utc", "ev_type")


# =========================================================== text lines

DOC_LINES = "d AS (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)"


@query("lines_containing",
       f"WITH {DOC_LINES} SELECT count(*) FILTER (WHERE contains(line, 'a')) AS lines_with_a, "
       "count(*) FILTER (WHERE contains(line, 'b')) AS lines_with_b, count(*) AS n_lines FROM d")
def lines_containing(spark, sf):
    """Text lines containing 'a' / 'b' (case-sensitive), one pass."""
    lines = text.read_lines(spark, C.document_text(spark, sf))
    return lines.agg(F.count(F.when(F.col("value").contains("a"), 1)).alias("lines_with_a"),
                     F.count(F.when(F.col("value").contains("b"), 1)).alias("lines_with_b"),
                     F.count(F.lit(1)).alias("n_lines"))


@query("prefix_filter",
       f"WITH {DOC_LINES} SELECT upper(substr(line, 1, 1)) AS letter, count(*) AS cnt FROM d "
       "WHERE upper(substr(line, 1, 1)) IN ('A', 'C') GROUP BY 1")
def prefix_filter(spark, sf):
    """Lines starting with A or C, case-insensitive."""
    from loomlog.functions.scalar import starts_with_any
    lines = text.read_lines(spark, C.document_text(spark, sf))
    hit = lines.where(starts_with_any(F.col("value"), ["A", "C"]))
    return counts.count_by(hit.select(F.upper(F.substring("value", 1, 1)).alias("letter")), "letter")


# =========================================================== delimited prep

DELIMITED = ", ".join(C.DELIMITED_COLUMNS)
DELIMITED_ROWS = (f"(SELECT {DELIMITED} FROM lineitem UNION ALL "
                  f"SELECT {DELIMITED} FROM lineitem WHERE l_orderkey % 10 = 0)")


@query("delimited_duplicates",
       f"SELECT count(*) AS n_rows, count(DISTINCT ({DELIMITED})) AS n_distinct, "
       f"count(*) - count(DISTINCT ({DELIMITED})) AS n_duplicates FROM {DELIMITED_ROWS}")
def delimited_duplicates(spark, sf):
    """``;`` file(s) with header → count − distinct count."""
    df = text.read_delimited(spark, C.delimited_table(spark, sf), C.DELIMITED_SCHEMA)
    return prep.duplicate_rows(df)


@query("labeled_points",
       "SELECT CAST(l_linenumber AS DOUBLE) AS label, "
       + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(C.DELIMITED_COLUMNS[:-1]))
       + f" FROM {DELIMITED_ROWS}")
def labeled_points(spark, sf):
    """P10: last column → label, others → double features."""
    df = text.read_delimited(spark, C.delimited_table(spark, sf), C.DELIMITED_SCHEMA)
    pts = prep.labeled_points(df)
    return pts.select("label", *[F.col("features")[i].alias(f"f{i}") for i in range(len(df.columns) - 1)])


@query("duplicate_texts",
       "SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct, "
       "count(*) - count(DISTINCT text) AS n_duplicates FROM documents")
def duplicate_texts(spark, sf):
    """A7 on documents: surplus exact copies of a text."""
    return counts.duplicate_summary(C.table(spark, sf, "documents").select("text"),
                                    digest_column="text")


# =========================================================== case/vote log

CASES_SQL = (
    "SELECT CAST(o.o_orderkey AS INTEGER) AS case_id, count(l.l_partkey) AS n_votes, "
    "coalesce(string_agg(CAST(l.l_partkey AS VARCHAR), ',' ORDER BY l.l_linenumber, l.l_partkey), '') AS votes "
    "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey")
PARTS = ("(SELECT p_partkey, p_name, p_brand FROM part UNION ALL "
         f"SELECT p_partkey + {C.UNVOTED}, p_name, p_brand FROM part WHERE p_partkey % 10 = 0) AS part")
ATTR_LINE_SQL = "'A,' || p_partkey || ',1,\"' || p_name || '\",\"' || p_brand || '\"'"
CASE_LINE_SQL = "'C,\"' || o.o_orderkey || '\",' || o.o_orderkey"
VOTE_LINES_SQL = "string_agg('V,' || l.l_partkey || ',1', {sep} ORDER BY l.l_linenumber, l.l_partkey)"
RECORDS_SQL = (
    f"r AS (SELECT {ATTR_LINE_SQL} AS header, CAST(1 AS BIGINT) AS n_lines, '' AS body FROM {PARTS} "
    f"UNION ALL SELECT {CASE_LINE_SQL}, 1 + count(l.l_partkey), "
    f"coalesce({VOTE_LINES_SQL.format(sep='chr(10)')}, '') FROM orders o "
    "LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey)")


def _corpus_records(spark, sf, max_bytes=None) -> DataFrame:
    return records.group_records(spark, C.case_vote_text(spark, sf), S.CASE_VOTE_HEADER_REGEX,
                                 max_bytes=max_bytes)


def _record_rows(recs: DataFrame) -> DataFrame:
    return recs.select("header", F.size("lines").cast("bigint").alias("n_lines"),
                       F.array_join(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))),
                                    "\n").alias("body"))


def _cases(spark, sf) -> DataFrame:
    return votes.cases_from_records(_corpus_records(spark, sf))


def _cut_cases(spark, sf) -> DataFrame:
    """Cases cut at the delimiter: no shuffle of the text."""
    return votes.cases_by_delimiter(spark, C.case_vote_text(spark, sf))


@query("attributes_parsed",
       f"SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_brand AS url FROM {PARTS}")
def attributes_parsed(spark, sf):
    """``A`` lines → (id, title, url), CSV quoting honoured."""
    return votes.parse_attributes(text.read_lines(spark, C.case_vote_text(spark, sf)))


@query("first_attributes",
       f"SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_brand AS url FROM {PARTS} "
       f"ORDER BY id LIMIT {FIRST_ATTRIBUTES}")
def first_attributes(spark, sf):
    """T5: take(n) with an order."""
    attrs = votes.parse_attributes(text.read_lines(spark, C.case_vote_text(spark, sf)))
    return ranking.top_k(attrs, FIRST_ATTRIBUTES, "id")


@query("case_votes", CASES_SQL)
def case_votes(spark, sf):
    """P7/X9 over S7 records: (case id, votes in file order)."""
    return votes.case_summary(_cases(spark, sf))


@query("case_votes_by_delimiter", CASES_SQL)
def case_votes_by_delimiter(spark, sf):
    """Chunks cut at ``\\nC``; no shuffle at all."""
    return votes.case_summary(_cut_cases(spark, sf))


@query("case_votes_regex", CASES_SQL)
def case_votes_regex(spark, sf):
    """Record text ``header,{…}`` → all matches of ``V,(\\d*),\\d*``."""
    recs = records.with_record_text(_corpus_records(spark, sf))
    return votes.case_summary(votes.cases_from_record_text(recs))


@query("record_groups", f"WITH {RECORDS_SQL} SELECT header, n_lines, body FROM r")
def record_groups(spark, sf):
    """Header-regex grouping at any split."""
    return _record_rows(_corpus_records(spark, sf))


@query("record_groups_capped",
       f"WITH {RECORDS_SQL} SELECT header, n_lines, body FROM r "
       f"WHERE strlen(header || CASE WHEN n_lines > 1 THEN chr(10) || body ELSE '' END) <= {MAX_RECORD_BYTES}")
def record_groups_capped(spark, sf):
    """records over MAX_RECORD_BYTES skipped."""
    return _record_rows(_corpus_records(spark, sf, max_bytes=MAX_RECORD_BYTES))


@query("record_groups_skipped",
       f"WITH {RECORDS_SQL}, s AS (SELECT strlen(header || CASE WHEN n_lines > 1 THEN chr(10) || body ELSE '' END) "
       f"AS n_bytes FROM r) SELECT n_bytes, count(*) AS cnt FROM s WHERE n_bytes > {MAX_RECORD_BYTES} GROUP BY 1")
def record_groups_skipped(spark, sf):
    """F11's trace: the records skipped for their size, counted by size."""
    lines = records.positioned_lines(spark, C.case_vote_text(spark, sf))
    return counts.count_by(records.skipped_records(lines, S.CASE_VOTE_HEADER_REGEX, MAX_RECORD_BYTES), "n_bytes")


@query("record_pieces",
       f"WITH {RECORDS_SQL} SELECT n_lines, strlen(header || CASE WHEN n_lines > 1 THEN chr(10) || body ELSE '' END) "
       "AS n_bytes, count(*) AS cnt FROM r GROUP BY 1, 2")
def record_pieces(spark, sf):
    """S6/S7 in rows of bounded size: records of any length by lines and bytes, from
    pieces of at most MAX_RECORD_BYTES (and the line that goes over it)."""
    lines = records.positioned_lines(spark, C.case_vote_text(spark, sf))
    pieces = records.record_pieces(lines, S.CASE_VOTE_HEADER_REGEX, MAX_RECORD_BYTES)
    whole = pieces.groupBy("file", "rec_block", "rec_pos").agg(
        F.sum(F.size("lines")).alias("n_lines"), (F.sum(F.octet_length(F.array_join("lines", "\n")) + 1) - 1).alias("n_bytes"))
    return counts.count_by(whole, "n_lines", "n_bytes")


@query("record_text",
       f"SELECT {ATTR_LINE_SQL} AS record_text FROM {PARTS} UNION ALL "
       f"SELECT {CASE_LINE_SQL} || coalesce(',{{' || {VOTE_LINES_SQL.format(sep=chr(39) + ';' + chr(39))} || '}}', '') "
       "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey")
def record_text_q(spark, sf):
    """``header,{l1;l2;…}`` serialisation."""
    return records.with_record_text(_corpus_records(spark, sf)).select("record_text")


@query("line_kind_counts",
       f"SELECT 'A' AS kind, count(*) AS cnt FROM {PARTS} UNION ALL SELECT 'C', count(*) FROM orders "
       "UNION ALL SELECT 'V', count(*) FROM lineitem "
       "UNION ALL SELECT 'C|V', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)")
def line_kind_counts(spark, sf):
    """lines per record letter, and the V-or-C disjunction."""
    lines = text.read_lines(spark, C.case_vote_text(spark, sf))
    kind = votes.line_kind(F.col("value"))
    either = F.when(kind.isin("V", "C"), F.array(kind, F.lit("C|V"))).when(kind == "A", F.array(kind))
    return counts.count_by(lines.select(F.explode(either).alias("kind")), "kind")     # one scan for all rows


@query("votes_exploded",
       "SELECT CAST(l_orderkey AS INTEGER) AS case_id, CAST(l_partkey AS INTEGER) AS attr_id FROM lineitem")
def votes_exploded(spark, sf):
    """Flatten votes."""
    return votes.votes_exploded(_cut_cases(spark, sf))


@query("active_cases",
       "SELECT CAST(o.o_orderkey AS INTEGER) AS case_id, count(*) AS n_votes, "
       "CAST((list(l.l_partkey ORDER BY l.l_linenumber, l.l_partkey))[-1] AS INTEGER) AS last_vote "
       "FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey")
def active_cases(spark, sf):
    """Cases with votes; size and last vote."""
    return votes.active_cases(_cut_cases(spark, sf))


@query("votes_per_attribute",
       "SELECT CAST(l_partkey AS INTEGER) AS attr_id, count(*) AS cnt FROM lineitem GROUP BY l_partkey")
def votes_per_attribute(spark, sf):
    """A6."""
    return votes.votes_per_attribute(_cut_cases(spark, sf))


ATTR_VOTES_SQL = (
    f"SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_brand AS url, v.cnt FROM {PARTS} "
    "LEFT JOIN (SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey) v "
    "ON v.l_partkey = p_partkey")


@query("attribute_votes_left", ATTR_VOTES_SQL)
def attribute_votes_left(spark, sf):
    """Every attribute, optional vote count."""
    attrs = votes.parse_attributes(text.read_lines(spark, C.case_vote_text(spark, sf)))
    return votes.attribute_votes(attrs, cases=_cut_cases(spark, sf))


@query("attribute_votes_ranked",
       f"SELECT id, title, coalesce(cnt, 0) AS cnt FROM ({ATTR_VOTES_SQL}) "
       f"ORDER BY coalesce(cnt, 0) DESC, id LIMIT {TOP_ATTRIBUTES}")
def attribute_votes_ranked(spark, sf):
    """By count with missing = 0, top 20."""
    attrs = votes.parse_attributes(text.read_lines(spark, C.case_vote_text(spark, sf)))
    return votes.attribute_votes_ranked(attrs, k=TOP_ATTRIBUTES, cases=_cut_cases(spark, sf))


# =========================================================== streams

@query("stream_case_votes", CASES_SQL)
def stream_case_votes(spark, sf):
    """S12/St1/St2/St5: file stream → records per micro-batch → cases,
    run to completion (availableNow) into a Parquet sink, read back."""
    out = case_stream.run_case_votes(spark, C.case_vote_text(spark, sf))
    return votes.case_summary(out)


@query("stream_file_batches", CASES_SQL)
def stream_file_batches(spark, sf):
    """St1: one file per micro-batch gives the same cases."""
    out = case_stream.run_to_completion(spark, C.case_vote_text(spark, sf), case_stream.case_groups, "file-batches",
                                        max_files_per_trigger=1)
    return votes.case_summary(out)


@query("stream_archive", CASES_SQL)
def stream_archive(spark, sf):
    """St6: finished files go to the archive; archive and source together
    still hold the input (read again here)."""
    src, archive = scratch_path(spark, "stream-source"), scratch_path(spark, "stream-archive")
    C.write_case_votes(spark, sf, src)
    case_stream.run_to_completion(spark, src, case_stream.case_groups, "archive", max_files_per_trigger=1,
                                  clean_source="archive", archive_dir=archive)
    left = [p for p in (src, archive) if tables.path_exists(spark, p)]
    lines = spark.read.option("recursiveFileLookup", "true").text(left, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return votes.case_summary(votes.cases_from_records(records.group_lines(lines, S.CASE_VOTE_HEADER_REGEX)))


@query("stream_progress",
       f"SELECT 0 AS batch_id, count(*) AS rows, 0 AS cases FROM {PARTS} UNION ALL "
       "SELECT CASE WHEN o.o_orderkey % 2 = 1 THEN 1 ELSE 2 END, count(DISTINCT o.o_orderkey) + count(l.l_orderkey), "
       "count(DISTINCT o.o_orderkey) FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1")
def stream_progress(spark, sf):
    """St1/St4: a running 1 s stream whose files arrive in three steps (attributes,
    odd cases, even cases): rows in each micro-batch, from the progress listener,
    and the cases it wrote."""
    blocks = C.case_vote_blocks(spark, sf)
    steps = [blocks.where(w).select("value") for w in ("section = 0", "section = 1 AND k % 2 = 1", "section = 1 AND k % 2 = 0")]
    cases, progress = case_stream.run_in_steps(spark, steps, "steps")
    made = cases.groupBy(F.col("batch").cast("bigint").alias("batch_id")).agg(F.count(F.lit(1)).alias("cases"))
    return progress.join(made, "batch_id", "left").select("batch_id", "rows", F.coalesce("cases", F.lit(0)).alias("cases"))


@query("stream_restart", CASES_SQL)
def stream_restart(spark, sf):
    """St7: the query dies after its first batch is written and before its checkpoint;
    a second start replays that batch and goes on: every case once."""
    source, store = C.case_vote_text(spark, sf), snapshots.SnapshotStore(spark, scratch_path(spark, "stream-restart"))

    def dies(batch_id: int) -> None:
        raise RuntimeError(f"lost after batch {batch_id}")

    run = dict(sink=(store, "cases"), trigger={"availableNow": True}, max_files_per_trigger=1)
    try:
        case_stream.start(spark, source, case_stream.case_groups, after_emit=dies, **run).awaitTermination()
    except StreamingQueryException:
        pass
    case_stream.start(spark, source, case_stream.case_groups, **run).awaitTermination()
    return votes.case_summary(store.read("cases"))


@query("prefixed_groups",
       f"SELECT '# ' || {ATTR_LINE_SQL} AS line FROM {PARTS} UNION ALL "
       f"SELECT '# ' || {CASE_LINE_SQL} || coalesce(chr(10) || {VOTE_LINES_SQL.format(sep='chr(10)')}, '') "
       "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey")
def prefixed_groups(spark, sf):
    """St2/St3/X11: groups at lines starting with A or C (any case), text
    joined by newline, prefixed with ``# ``."""
    return case_stream.run_prefixed_groups(spark, C.case_vote_text(spark, sf))


# =========================================================== tables (sinks)

UPSERT_SQL = (
    f"WITH {E_CTE}, u AS ("
    "SELECT date_utc, hour_utc, created_at, ev_id, actor, ev_type, "
    f"CASE WHEN ev_type = '{EVENT_TYPE}' THEN repo || '-v2' ELSE repo END AS repo FROM e "
    "UNION ALL SELECT date_utc, hour_utc, created_at, ev_id + 1000000000, actor, ev_type, 'new-' || repo "
    "FROM e WHERE ev_type = 'signup') ")


def _second_batch(e: DataFrame) -> DataFrame:
    """Overlapping import: every purchase again with a changed repo (same
    key → replaced), every signup under a new id (→ inserted)."""
    changed = e.where(F.col("ev_type") == EVENT_TYPE).withColumn("repo", F.concat("repo", F.lit("-v2")))
    added = e.where(F.col("ev_type") == "signup").select(
        *[(F.col("ev_id") + 1000000000).alias("ev_id") if c == "ev_id"
          else F.concat(F.lit("new-"), "repo").alias("repo") if c == "repo" else F.col(c)
          for c in e.columns])
    return changed.unionByName(added)


@query("upsert_default", UPSERT_SQL + f"SELECT {E_COLS} FROM u")
def upsert_default(spark, sf):
    """K1/K2/K5: create-or-merge keyed by ev_id (two imports); the table is
    partitioned by id block, so the second import rewrites touched blocks."""
    e = C.event_log(spark, sf)
    path = scratch_path(spark, "event-log")
    tables.upsert_events_by_id(spark, e, path)
    return tables.upsert_events_by_id(spark, _second_batch(e), path).select(*S.EVENT_LOG_COLUMNS)


@query("upsert_hourly", UPSERT_SQL + f"SELECT {E_COLS} FROM u")
def upsert_hourly(spark, sf):
    """K3/K4/K5: hourly table; the second import rewrites touched hours only."""
    e = C.event_log(spark, sf)
    path = scratch_path(spark, "event-log" + S.HOURLY_SUFFIX)
    tables.upsert_hourly(spark, e, path)
    return tables.upsert_hourly(spark, _second_batch(e), path).select(*S.EVENT_LOG_COLUMNS)


@query("upsert_composite_key",
       "SELECT event_id AS id, event_type AS type FROM events UNION ALL "
       f"SELECT event_id, event_type || '-refund' FROM events WHERE event_type = '{EVENT_TYPE}'")
def upsert_composite_key(spark, sf):
    """K9: table keyed (id, type) saved with two columns; re-importing all
    pairs changes nothing, new pairs are added."""
    e = C.event_log(spark, sf).select(F.col("ev_id").alias("id"), F.col("ev_type").alias("type"))
    path = scratch_path(spark, "events-id-type")
    tables.upsert_by_id_block(spark, e, path, ["id", "type"])
    refunds = e.where(F.col("type") == EVENT_TYPE).withColumn("type", F.concat("type", F.lit("-refund")))
    return tables.upsert_by_id_block(spark, e.unionByName(refunds), path, ["id", "type"])


def _records(spark, sf) -> DataFrame:
    return ev_src.read_records(spark, C.github_json(spark, sf)).select(
        "type", F.col("actor.login").alias("actor"), F.col("id").cast("bigint").alias("id"), "full_record")


def _amounts(rows: DataFrame) -> DataFrame:
    return rows.select("type", "actor", "id", F.get_json_object("full_record", "$.payload.detail.amount").cast("double").alias("amount"))


@query("records_by_type",
       "SELECT event_type AS type, CAST(user_id AS VARCHAR) AS actor, event_id AS id, value AS amount FROM events")
def records_by_type(spark, sf):
    """Table keyed by type, clustered by (actor, id), the full record a regular column."""
    return _amounts(snapshots.upsert_records_by_type(spark, _records(spark, sf), scratch_path(spark, "records-by-type")))


BUSIEST_SQL = ("(SELECT CAST(user_id AS VARCHAR) AS actor FROM events WHERE event_type = '" + EVENT_TYPE + "' "
               "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


@query("records_of_actor",
       "SELECT event_type AS type, CAST(user_id AS VARCHAR) AS actor, event_id AS id, "
       "CASE WHEN event_id % 2 = 0 THEN value ELSE 0 END AS amount FROM events "
       f"WHERE event_type = '{EVENT_TYPE}' AND CAST(user_id AS VARCHAR) = {BUSIEST_SQL}")
def records_of_actor(spark, sf):
    """K4: the table by type after a second import of one actor's records (odd ids
    without their payload), read by (type, actor): the actor with most purchases.
    Merge and read open the files of that actor only."""
    rec = _records(spark, sf)
    path = scratch_path(spark, "records-by-type")
    table = snapshots.upsert_records_by_type(spark, rec, path, target_bytes=1024 * 1024)
    busiest = ranking.top_k(counts.count_by(table.where(F.col("type") == EVENT_TYPE), "actor"), 1, F.desc("cnt"), F.asc("actor"))
    again = rec.join(busiest.select("actor"), "actor", "left_semi").where("id % 2 = 1").select(
        "type", "actor", "id", F.lit('{"payload":{"detail":{"amount":0}}}').alias("full_record"))
    snapshots.upsert_records_by_type(spark, again, path, target_bytes=1024 * 1024)
    actor = busiest.first()["actor"]
    return _amounts(snapshots.records_of(spark, path, type=EVENT_TYPE, actor=actor))


@query("keyed_table_growth",
       "SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS state, "
       "CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS INTEGER) AS imports FROM orders")
def keyed_table_growth(spark, sf):
    """K2: a table on one key that grows from a hundredth of the orders to all of
    them, its files splitting as they fill; finished orders come a second time."""
    path, size = scratch_path(spark, "orders-by-key"), 256 * 1024
    o = C.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    first = o.select("k", F.lit("open").alias("state"), F.lit(1).alias("imports"))
    for part in (F.col("k") % 100 == 0, F.col("k") % 10 == 0, F.col("k") % 10 != 0):
        snapshots.upsert_table(spark, first.where(part), path, ["k"], target_bytes=size)
    done = o.where(F.col("s") == "F").select("k", F.lit("done").alias("state"), F.lit(2).alias("imports"))
    return snapshots.upsert_table(spark, done, path, ["k"], target_bytes=size)


REJECTED = "(value < 1 OR event_type IN ('error', 'signup'))"


@query("import_batches",
       "SELECT 'default' AS kind, event_id AS event FROM events UNION ALL SELECT 'hourly', event_id FROM events "
       f"UNION ALL SELECT 'rejected', event_id FROM events WHERE {REJECTED} "
       "UNION ALL SELECT 'a records', count(*) FROM events UNION ALL SELECT 'b records', count(*) FROM events "
       f"UNION ALL SELECT 'a imported', count(*) FROM events WHERE NOT {REJECTED} UNION ALL SELECT 'b imported', count(*) FROM events "
       f"UNION ALL SELECT 'a rejected', count(*) FROM events WHERE {REJECTED} UNION ALL SELECT 'b rejected', 0")
def import_batches(spark, sf):
    """Two imports into a snapshot store, the first one repeated:
    both tables, the rejected lines and the statistics of each batch."""
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "imports"))
    some, all_lines = C.github_json_unusable(spark, sf), C.github_json(spark, sf)
    for batch, path in (("a", some), ("b", all_lines), ("a", some)):
        reports.import_batch(store, batch, path)
    out = [store.read(name).select(F.lit(kind).alias("kind"), F.col("ev_id").alias("event"))
           for kind, name in (("default", reports.DEFAULT_TABLE), ("hourly", reports.HOURLY_TABLE))]
    out.append(store.read(reports.REJECTS_TABLE).select(
        F.lit("rejected").alias("kind"), F.get_json_object("value", "$.payload.event").cast("bigint").alias("event")))
    stats = store.read(reports.STATS_TABLE)
    out += [stats.select(F.concat("batch", F.lit(f" {c}")).alias("kind"), F.col(c).alias("event")) for c in ("records", "imported", "rejected")]
    return reduce(DataFrame.unionByName, out)


@query("import_rejects",
       "SELECT CASE WHEN value < 1 OR event_type IN ('error', 'signup') THEN 'rejected' ELSE 'imported' END AS kind, "
       "event_id AS event FROM events")
def import_rejects(spark, sf):
    """K1 with lines that cannot be keyed: table rows + rejected lines = input."""
    path, bad = scratch_path(spark, "checked-import"), scratch_path(spark, "rejected-lines")
    table, _ = import_logs(spark, C.github_json_unusable(spark, sf), path, quarantine_path=bad)
    event = F.get_json_object("value", "$.payload.event").cast("bigint").alias("event")
    return table.select(F.lit("imported").alias("kind"), F.col("ev_id").alias("event")).unionByName(
        spark.read.text(bad).select(F.lit("rejected").alias("kind"), event))


@query("ingest_stats", "SELECT count(*) AS records FROM events")
def ingest_stats(spark, sf):
    """Import with statistics (records counted on the write)."""
    stats = tables.ingest_with_stats(spark, C.event_log(spark, sf),
                                     scratch_path(spark, "ingest" + S.HOURLY_SUFFIX))
    return stats.select("records")


@query("table_exists_probe",
       f"WITH {E_CTE}, d AS (SELECT DISTINCT date_utc FROM e) SELECT 'events' AS \"table\", date_utc, true AS \"exists\" "
       "FROM d UNION ALL SELECT 'events', '19000101Z', false "
       "UNION ALL SELECT 'missing', date_utc, false FROM d UNION ALL SELECT 'missing', '19000101Z', false")
def table_exists_probe(spark, sf):
    """For each day of the events and one more, whether the
    imported table, and a table that was never made, have it."""
    present = C.hourly_table(spark, sf)
    days = C.event_log(spark, sf).select("date_utc").distinct().unionByName(
        spark.createDataFrame([("19000101Z",)], "date_utc string"))
    found = [tables.partitions_present(spark, path, days, "date_utc").select(F.lit(name).alias("table"), "date_utc", "exists")
             for name, path in (("events", present), ("missing", present + "-missing"))]
    return found[0].unionByName(found[1])


@query("catalog_tables",
       "SELECT 'events_' || event_type AS name, 'log' AS space, "
       f"event_type IN ('{EVENT_TYPE}', 'signup') AS \"exists\" FROM (SELECT DISTINCT event_type FROM events) "
       "UNION ALL SELECT 'events_' || event_type, 'missing', false FROM (SELECT DISTINCT event_type FROM events) "
       "UNION ALL SELECT 'event_log_hourly', 'log', true UNION ALL SELECT 'event_log_hourly', 'missing', false")
def catalog_tables(spark, sf):
    """Tables saved into a namespace for two of the event types, the
    hourly table registered from its folder; for every type and two namespaces,
    whether the catalog has the table."""
    space = f"log_{uuid.uuid4().hex[:8]}"
    e = C.event_log(spark, sf)
    catalog_sink.create_namespace(spark, space, scratch_path(spark, "namespace"))
    try:
        for kind in (EVENT_TYPE, "signup"):
            catalog_sink.save_table(e.where(F.col("ev_type") == kind), space, f"events_{kind}")
        catalog_sink.register_folder(spark, space, "event_log_hourly", C.hourly_table(spark, sf))
        names = counts.distinct_values(e, "ev_type").select(F.concat(F.lit("events_"), "ev_type").alias("name")).unionByName(
            spark.createDataFrame([("event_log_hourly",)], "name string"))
        wanted = names.select("name", F.explode(F.array(F.lit(space), F.lit(f"{space}_missing"))).alias("namespace"))
        found = catalog_sink.tables_present(spark, wanted)       # the listing is taken here
    finally:
        catalog_sink.drop_namespace(spark, space)
    return found.select("name", F.when(F.col("namespace") == space, "log").otherwise("missing").alias("space"), "exists")


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}

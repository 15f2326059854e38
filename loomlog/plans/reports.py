"""The reference's programs as functions (query lifecycles L1-L4).

* ``import_logs``      L1/L5: JSON lines → event log → default + hourly table
* ``import_batch``     L1 into a snapshot store: both tables, rejected lines and
                       statistics in one commit; repeatable
* ``event_report``     L2: counts by type, total, and the top value of several
                       fields per hour of given dates — one job for all fields
* ``case_vote_report`` L3: attributes, cases, votes per attribute, attributes
                       left join votes, top attributes
* streams (L4) are in ``loomlog.streaming.case_stream``.

Each returns DataFrames; nothing is collected.  ``python -m loomlog`` wraps
them for the command line.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomlog import schemas as S
from loomlog.operators import counts, ranking, votes
from loomlog.session import drop_scratch, scratch_path
from loomlog.sinks import tables
from loomlog.sinks.snapshots import SnapshotStore
from loomlog.sources import events, records, text

REPORT_FIELDS = ("actor", "ev_type", "repo")


def import_logs(spark: SparkSession, json_path: str | list[str], table_path: str,
                lenient: bool = False, quarantine_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """L1: import GitHub JSON into ``table_path`` (key ev_id) and
    ``table_path + '_hourly_by_ts_id'``; re-importing is an upsert.

    A line that is not JSON, or whose id or time cannot be read, fails the
    import, unless ``quarantine_path`` is given: such lines are appended
    there as they are and the rest is imported.  ``lenient`` reads literal
    defaults for absent fields (an unusable value is still no key).
    """
    if lenient:
        log = events.read_events_lenient(spark, json_path, on_error="quarantine", extra=["full_record"])
    else:
        log = events.to_event_log(events.read_records(spark, json_path), extra=["full_record"])
    good, bad = tables.split_rejects(log, ["ev_id", "created_at"])
    if quarantine_path is None:
        return tables.import_event_log(spark, log.select(*S.EVENT_LOG_COLUMNS), table_path)
    bad.select(F.col("full_record").alias("value")).write.mode("append").text(quarantine_path)
    return tables.import_event_log(spark, good.select(*S.EVENT_LOG_COLUMNS), table_path)


# Tables of an import into a snapshot store.
DEFAULT_TABLE, HOURLY_TABLE, REJECTS_TABLE, STATS_TABLE = "event_log", "event_log_hourly", "rejected_lines", "import_stats"


def import_batch(store: SnapshotStore, batch: str, json_path: str | list[str], lenient: bool = False,
                 quarantine: bool = True) -> int:
    """L1/K7 with K6/A9: import a batch of GitHub JSON into ``store``; returns the version made.

    The lines are parsed once.  Rows go to the default and the hourly table
    (upserts), lines that cannot be keyed to the rejected lines, records read,
    imported and rejected with the seconds taken to the statistics, all in one
    commit.  Rejects and statistics are kept by batch, so an import that is
    repeated replaces its own.  Without ``quarantine`` a line that cannot be
    keyed fails the import and nothing changes."""
    spark = store.spark
    begun = time.time()
    if lenient:
        log = events.read_events_lenient(spark, json_path, on_error="quarantine", extra=["full_record"])
    else:
        log = events.to_event_log(events.read_records(spark, json_path), extra=["full_record"])
    unkeyed = F.col("ev_id").isNull() | F.col("created_at").isNull()
    seen = Observation(f"import {batch}")
    staged = scratch_path(spark, "import")
    log.select(*S.EVENT_LOG_COLUMNS, F.when(unkeyed, F.col("full_record")).alias("value")).observe(
        seen, F.count(F.lit(1)).alias("records"), F.count("value").alias("rejected")).write.parquet(staged)
    try:
        rows = spark.read.parquet(staged)
        records, rejected = seen.get["records"], seen.get["rejected"]
        if rejected and not quarantine:
            raise ValueError(f"{rejected} of {records} lines cannot be keyed: nothing was imported")
        good = rows.where(F.col("value").isNull()).select(*S.EVENT_LOG_COLUMNS)
        change = store.begin()
        change.merge(DEFAULT_TABLE, good, ["ev_id"])
        change.merge(HOURLY_TABLE, good, S.HOURLY_PARTITION + S.HOURLY_CLUSTERING)
        change.put(REJECTS_TABLE, rows.where(F.col("value").isNotNull()).select("value"), batch)
        stats = [(records, records - rejected, rejected, time.time() - begun)]
        change.put(STATS_TABLE, spark.createDataFrame(stats, "records long, imported long, rejected long, seconds double"), batch)
        return change.commit()
    finally:
        drop_scratch(spark, staged)


def top_fields_per_hour(df: DataFrame, fields: Sequence[str] = REPORT_FIELDS,
                        dates: Sequence[str] | str | None = None) -> DataFrame:
    """T2 for several fields at once: (date_utc, hour_utc, field, value, cnt),
    24 rows per date and field, nulls for empty hours.

    Each row is exploded into one (field, value) pair per field before the
    partial count, so one scan and one shuffle serve all fields (the
    reference runs a job per field, date and hour)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"),
                                         F.col(f).cast("string").alias("value"))
                                for f in fields])).alias("p")
    if dates is not None:
        df = df.where(F.col("date_utc").isin(list([dates] if isinstance(dates, str) else dates)))
    long = df.select("date_utc", "hour_utc", pairs).select("date_utc", "hour_utc", "p.field", "p.value")
    keys = ["date_utc", "hour_utc", "field"]
    best = ranking.winner(counts.count_by(long, *keys, "value"), keys, ["value"])
    if dates is None:
        return ranking.fill_hours(best, ["value", "cnt"], ["field"])
    day_list = df.sparkSession.createDataFrame([(d,) for d in ([dates] if isinstance(dates, str) else dates)],
                                               "date_utc string")
    grid = ranking.hour_grid(day_list).select(
        "*", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
    return grid.join(best, keys, "left")


def event_report(spark: SparkSession, hourly: DataFrame, dates: Sequence[str] | str,
                 fields: Sequence[str] = REPORT_FIELDS) -> dict[str, DataFrame]:
    """L2: what the query program prints, as DataFrames."""
    return {
        "count_by_type": counts.count_by(hourly, "ev_type"),
        "count_all": counts.count_all(hourly),
        "top_per_hour": top_fields_per_hour(hourly, fields, dates),
        "top_row_per_hour": ranking.top_per_hour(hourly, list(fields), dates=dates),
    }


def case_vote_report(spark: SparkSession, path: str | list[str], k: int = 20) -> dict[str, DataFrame]:
    """L3: the case/vote analysis program."""
    lines = text.read_lines(spark, path)
    attrs = votes.parse_attributes(lines)
    recs = records.group_records(spark, path, S.CASE_VOTE_HEADER_REGEX)
    cases = votes.cases_from_records(recs)
    cut = votes.cases_by_delimiter(spark, path)       # counts need no shuffle of the text
    vote_counts = votes.votes_per_attribute(cut)
    return {
        "attributes": attrs,
        "cases": cases,
        "active_cases": votes.active_cases(cut),
        "votes_per_attribute": vote_counts,
        "attribute_votes": votes.attribute_votes(attrs, vote_counts=vote_counts),
        "top_attributes": votes.attribute_votes_ranked(attrs, k=k, vote_counts=vote_counts),
    }

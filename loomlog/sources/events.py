"""Event-log sources: GitHub JSON lines and the canonical event log.

S1  read_events_json      JSON lines with a declared schema (path, glob, list)
S2  read_events_lenient   per-line parse with literal defaults, bad lines
                          either fail the job or go to a quarantine column
P2  to_event_log          JSON row → the seven event-log columns, by name
P3  (inside)              derived UTC date and hour
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog import schemas as S
from loomlog.functions.scalar import date_utc, hour_utc, utc_wallclock


def _with_corrupt_column(schema: T.StructType) -> T.StructType:
    # StructType.add mutates in place; build a new schema instead.
    return T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])


def read_events_json(spark: SparkSession, path: str | list[str],
                     path_glob: str | None = None, recursive: bool = False, infer: bool = False) -> DataFrame:
    """One scan over a path, glob or list of paths.

    ``path_glob`` (e.g. ``"*.json"``) keeps only matching file names (F12);
    ``recursive`` descends into sub-folders.  Malformed lines become rows
    of nulls plus ``_corrupt_record`` (PERMISSIVE mode).  ``infer`` takes the
    schema from the data instead of the declared one.
    """
    schema = _with_corrupt_column(S.GITHUB_EVENT)
    reader = spark.read.option("mode", "PERMISSIVE")
    if infer:                      # an extra pass over the input; columns in alphabetical order
        reader = reader.option("primitivesAsString", "true")
    else:
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path)


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The declared fields of each line, its ``_corrupt_record`` (null for
    good lines) and ``full_record``: the line itself, whatever it holds."""
    lines = spark.read.text(path, lineSep="\n").where(F.trim("value") != "")
    schema = _with_corrupt_column(S.GITHUB_EVENT)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.select(F.from_json("value", schema, opts).alias("j"), F.col("value").alias("full_record")) \
        .select("j.*", "full_record")


def to_event_log(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """GitHub-shaped rows → event log, fields taken by name.
    ``extra`` names input columns carried through unchanged."""
    extra = extra or []
    created = utc_wallclock(F.col("created_at"))
    return (raw
            .select(created.alias("created_at"),
                    F.col("id").try_cast("bigint").alias("ev_id"),   # non-numeric id → null
                    F.col("actor.login").alias("actor"),
                    F.col("type").alias("ev_type"),
                    F.col("repo.name").alias("repo"), *extra)
            .select(date_utc(F.col("created_at")).alias("date_utc"),
                    hour_utc(F.col("created_at")).alias("hour_utc"),
                    "created_at", "ev_id", "actor", "ev_type", "repo", *extra))


def _lenient_fields(parsed: Column) -> list[Column]:
    return [
        F.coalesce(parsed["id"], F.lit(S.DEFAULT_ID)).alias("id"),
        F.coalesce(parsed["type"], F.lit(S.DEFAULT_TYPE)).alias("type"),
        F.coalesce(parsed["created_at"], F.lit(S.DEFAULT_CREATED_AT)).alias("created_at"),
        F.struct(F.coalesce(parsed["actor"]["login"], F.lit(S.DEFAULT_LOGIN)).alias("login")).alias("actor"),
        F.struct(F.coalesce(parsed["repo"]["name"], F.lit(S.DEFAULT_REPO)).alias("name")).alias("repo"),
    ]


def read_events_lenient(spark: SparkSession, path: str | list[str],
                        on_error: str = "fail", extra: list[str] | None = None) -> DataFrame:
    """Text lines → ``from_json`` → literal defaults for absent fields.

    ``on_error='fail'`` stops the job at the first unparsable line (FAILFAST);
    ``'quarantine'`` keeps going and adds ``bad_line``: the raw text of an
    unparsable line (its event columns are then null), null otherwise.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    schema = _with_corrupt_column(S.GITHUB_EVENT)
    opts = {"mode": "FAILFAST"} if on_error == "fail" else \
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    lines = spark.read.text(path, lineSep="\n").where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", schema, opts).alias("j"), F.col("value").alias("full_record"))
    extra = extra or []            # "full_record": the line itself
    log = to_event_log(rows.select(*_lenient_fields(F.col("j")),
                                   F.col("j._corrupt_record").alias("bad_line"), "full_record"),
                       extra=["bad_line", *extra])
    if on_error == "fail":
        return log.drop("bad_line")
    ok = F.col("bad_line").isNull()
    return log.select(*[F.when(ok, F.col(c)).alias(c) for c in S.EVENT_LOG_COLUMNS], "bad_line", *extra)


def event_log_from_events(events: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The event log over the driver's ``events`` table (``ts`` is already
    UTC wall clock, TIMESTAMP_NTZ): id, time, type, user as actor, the
    ``k`` property as repo.  ``extra`` columns are carried through."""
    return events.select(
        date_utc(F.col("ts")).alias("date_utc"),
        hour_utc(F.col("ts")).alias("hour_utc"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("ev_id"),
        F.col("user_id").cast("string").alias("actor"),
        F.col("event_type").alias("ev_type"),
        F.get_json_object("props", "$.k").alias("repo"),
        *(extra or []),
    )

"""Inputs in the reference's file formats, derived by Spark from the
driver's tables and written once per session under the checkpoint root.

* GitHub JSON lines  ← events (event log in GitHub shape)
* case/vote text     ← part (attributes), orders (cases), lineitem (votes)
* ``;`` table         ← all numeric lineitem columns, header line per file
* plain text lines   ← documents.text

All of them grow with the tables and use whole tables.  Rules over the data
(stated where they are applied) add what the tables lack: absent and
unusable fields, repeated rows, attributes without votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.session import scratch_path
from loomlog.sources.events import event_log_from_events

_CACHE: dict[tuple, str] = {}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``E``: the event log over the driver's events table."""
    return event_log_from_events(table(spark, sf_dir, "events"))


def _cached(spark: SparkSession, key: tuple, build) -> str:
    """Build once per session; rebuild if the folder has gone (a new
    session, or a cleaned scratch area)."""
    from loomlog.sinks.tables import path_exists
    k = (id(spark.sparkContext), *key)
    if k not in _CACHE or not path_exists(spark, _CACHE[k]):
        _CACHE[k] = build()
    return _CACHE[k]


# ------------------------------------------------------------ GitHub JSON

def github_frame(event_log_df: DataFrame, drop: dict[str, Column] | None = None,
                 payload: Column | None = None) -> DataFrame:
    """Event log → GitHub-shaped columns; a field whose ``drop`` condition
    holds is null and therefore absent from the written JSON line."""
    drop = drop or {}

    def keep(name: str, value: Column) -> Column:
        cond = drop.get(name)
        return value if cond is None else F.when(~cond, value)

    # NTZ → text by cast (zone-free), in ISO form with the zone letter.
    ts_text = F.concat(F.regexp_replace(F.col("created_at").cast("string"), " ", "T"), F.lit("Z"))
    return event_log_df.select(
        keep("id", F.col("ev_id").cast("string")).alias("id"),
        keep("type", F.col("ev_type")).alias("type"),
        F.lit(True).alias("public"),
        keep("created_at", ts_text).alias("created_at"),
        keep("actor", F.struct(F.col("actor").alias("login"))).alias("actor"),
        keep("repo", F.struct(F.col("repo").alias("name"))).alias("repo"),
        *([] if payload is None else [payload.alias("payload")]))


def _payload() -> Column:
    """The event's own number and value, nested as GitHub nests what differs by type."""
    return F.struct(F.col("ev_id").alias("event"), F.struct(F.col("_value").alias("amount")).alias("detail"))


def sparse_rule() -> dict[str, Column]:
    """Which fields a line leaves out (exercises the lenient reader):
    events with value < 1 are stubs without id, type and time; signups
    name no repo; errors name no actor."""
    stub = F.col("_value") < 1
    return {"id": stub, "type": stub, "created_at": stub,
            "actor": F.col("ev_type") == "error", "repo": F.col("ev_type") == "signup"}


def github_json(spark: SparkSession, sf_dir: str, sparse: bool = False,
                with_decoy: bool = False) -> str:
    """Folder of ``part-*.json`` files (and, with ``with_decoy``, non-JSON
    ``.txt`` files next to them that a ``*.json`` filter must skip)."""
    def build() -> str:
        path = scratch_path(spark, "github-json")
        log = event_log_from_events(table(spark, sf_dir, "events").withColumnRenamed("value", "_value"), ["_value"])
        frame = github_frame(log, sparse_rule() if sparse else None, _payload())
        frame.write.mode("errorifexists").json(path)
        if with_decoy:
            # Same folder, other format: one line per event type, not JSON.
            (table(spark, sf_dir, "events").select(
                F.concat(F.lit("not json: "), "event_type").alias("value")).distinct()
             .write.mode("append").text(path))
        return path
    return _cached(spark, ("github", sf_dir, sparse, with_decoy), build)


def github_json_unusable(spark: SparkSession, sf_dir: str) -> str:
    """GitHub JSON in which some lines cannot be keyed: events with value < 1
    have no id, errors an id that is no number, and signups no usable time."""
    def build() -> str:
        path = scratch_path(spark, "github-json-unusable")
        log = event_log_from_events(table(spark, sf_dir, "events").withColumnRenamed("value", "_value"), ["_value"])
        frame = github_frame(log, {"id": F.col("_value") < 1}, _payload())
        frame = frame.withColumns({
            "id": F.when(F.col("type") == "error", F.concat(F.lit("x"), "id")).otherwise(F.col("id")),
            "created_at": F.when(F.col("type") == "signup", F.lit("soon")).otherwise(F.col("created_at"))})
        frame.write.mode("errorifexists").json(path)
        return path
    return _cached(spark, ("github-unusable", sf_dir), build)


# ------------------------------------------------------------ case/vote text

#: Attributes from this number on are parts again, which no line item votes for.
UNVOTED = 10_000_000


def case_vote_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text block per attribute and per case, with a sort key.

    Attribute ``A,<p_partkey>,1,"<p_name>","<p_brand>"``, and for every tenth
    part a second one numbered ``UNVOTED`` higher, which has no votes; case
    ``C,"<o_orderkey>",<o_orderkey>`` then ``V,<l_partkey>,1`` per line item
    ordered by (l_linenumber, l_partkey).  Orders without items are cases
    without votes."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    part = part.unionByName(part.where("p_partkey % 10 = 0").withColumn("p_partkey", F.col("p_partkey") + UNVOTED))
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem")
    attrs = part.select(
        F.lit(0).alias("section"), F.col("p_partkey").alias("k"),
        F.concat(F.lit("A,"), F.col("p_partkey").cast("string"), F.lit(',1,"'),
                 F.col("p_name"), F.lit('","'), F.col("p_brand"), F.lit('"')).alias("value"))
    votes = items.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("v"))
    vote_text = F.array_join(F.transform("v", lambda x: F.concat(
        F.lit("\nV,"), x["l_partkey"].cast("string"), F.lit(",1"))), "")
    cases = orders.join(votes, orders["o_orderkey"] == votes["l_orderkey"], "left").select(
        F.lit(1).alias("section"), F.col("o_orderkey").alias("k"),
        F.concat(F.lit('C,"'), F.col("o_orderkey").cast("string"), F.lit('",'),
                 F.col("o_orderkey").cast("string"),
                 F.coalesce(vote_text, F.lit(""))).alias("value"))
    return attrs.unionByName(cases)


def write_case_votes(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Text files: attributes first, then cases by key; range partitioned,
    so every file holds a contiguous run of blocks."""
    (case_vote_blocks(spark, sf_dir).repartitionByRange("section", "k")
     .sortWithinPartitions("section", "k").select("value")
     .write.mode("errorifexists").text(path))


def case_vote_text(spark: SparkSession, sf_dir: str) -> str:
    """The folder of ``write_case_votes``, made once per session."""
    def build() -> str:
        path = scratch_path(spark, "case-votes")
        write_case_votes(spark, sf_dir, path)
        return path
    return _cached(spark, ("casevote", sf_dir), build)


# ------------------------------------------------------------ hourly table

def hourly_table(spark: SparkSession, sf_dir: str) -> str:
    """The event log imported once into the hourly table (K4 layout);
    queries on partition keys read it from here."""
    from loomlog import schemas as S
    from loomlog.sinks.tables import upsert_hourly

    def build() -> str:
        path = scratch_path(spark, "event-log" + S.HOURLY_SUFFIX)
        upsert_hourly(spark, event_log(spark, sf_dir), path)
        return path
    return _cached(spark, ("hourly", sf_dir), build)


# ------------------------------------------------------------ ; table, text

DELIMITED_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", "l_linenumber"]
DELIMITED_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                    "l_extendedprice double, l_discount double, l_tax double, l_linenumber int")


def delimited_table(spark: SparkSession, sf_dir: str) -> str:
    """``;``-separated: every numeric lineitem column, a header line in every
    file; the last column (l_linenumber) plays the label.  Items of orders
    divisible by 10 stand twice (repeated rows)."""
    def build() -> str:
        path = scratch_path(spark, "delimited")
        items = table(spark, sf_dir, "lineitem").select(*DELIMITED_COLUMNS)
        (items.unionByName(items.where("l_orderkey % 10 = 0"))
         .write.mode("errorifexists").csv(path, sep=";", header=True))
        return path
    return _cached(spark, ("delimited", sf_dir), build)


def document_text(spark: SparkSession, sf_dir: str) -> str:
    """documents.text written as text files: one line per line of text."""
    def build() -> str:
        path = scratch_path(spark, "documents-text")
        (table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value"))
         .write.mode("errorifexists").text(path))
        return path
    return _cached(spark, ("doctext", sf_dir), build)
